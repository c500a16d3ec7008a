"""The two base layers with the column names and plain types of the source file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmill.schema import FILE_COLUMNS
from basketmill.sources.lines import LineSource


def published(lines: DataFrame) -> DataFrame:
    """Lines under the header names of the source file; dates as text, prices as doubles."""
    columns = []
    for header, name in FILE_COLUMNS.items():
        value = F.col(name)
        if name == "invoice_date":
            value = value.cast("string")
        elif name == "unit_price":
            value = value.cast("double")
        columns.append(value.alias(header))
    if "line_amount" in lines.columns:
        columns.append(F.col("line_amount").cast("double").alias("TotalLineItemAmount"))
    return lines.select(columns)


def raw_lines(source: LineSource) -> DataFrame:
    """The raw layer, unchanged rows."""
    return published(source.raw(*FILE_COLUMNS.values()))


def detail_lines(source: LineSource) -> DataFrame:
    """The cleaned layer with the line amount."""
    return published(source.detail(*FILE_COLUMNS.values(), "line_amount"))
