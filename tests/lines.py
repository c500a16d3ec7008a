"""Small hand-written sets of cleaned lines."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketmill.operators.cleaning import DATE_COLUMNS, LINE_AMOUNT
from basketmill.schema import DETAIL_COLUMNS, DETAIL_SCHEMA, RAW_SCHEMA
from basketmill.sources.lines import FrameSource

INPUT = (
    "invoice_no string, customer_id bigint, invoice_ts timestamp_ntz, description string, "
    "quantity int, unit_price decimal(12,4), country string"
)


def line(invoice, customer, day, price="1", product="CUP", quantity=1, country="France", hour=0):
    ts = datetime.fromisoformat(day).replace(hour=hour) if day else None
    return (invoice, customer, ts, product, quantity, Decimal(price), country)


def detail_frame(spark: SparkSession, lines: list[tuple]) -> DataFrame:
    frame = spark.createDataFrame(lines, INPUT)
    derived = {name: F.expr(value) for name, value in DATE_COLUMNS.items()}
    derived |= {"line_amount": F.expr(LINE_AMOUNT), "stock_code": F.lit("1")}
    return frame.withColumns(derived).select(DETAIL_COLUMNS)


def source_of(spark: SparkSession, lines: list[tuple]) -> FrameSource:
    """A source with the given cleaned lines and no raw lines."""
    return FrameSource(spark.createDataFrame([], RAW_SCHEMA), detail_frame(spark, lines))


def empty_source(spark: SparkSession) -> FrameSource:
    return FrameSource(spark.createDataFrame([], RAW_SCHEMA), spark.createDataFrame([], DETAIL_SCHEMA))


def rows(df: DataFrame) -> list[tuple]:
    return [tuple(row) for row in df.collect()]
