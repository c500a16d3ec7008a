"""Data-quality profiles of the raw and cleaned lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketmill.functions.labels import BAD_PRICE, BAD_QUANTITY, KEPT, NO_CUSTOMER, NULL_MEASURE, drop_reason
from basketmill.functions.numeric import money, percent_or_zero
from basketmill.operators.cleaning import LINE_AMOUNT
from basketmill.operators.staging import stage
from basketmill.schema import INVOICE_COLUMNS
from basketmill.sources.lines import Keys, LineSource, Measures

PROFILED_COLUMNS = ["invoice_no", "stock_code", "description", "invoice_date", "customer_id", "country"]


def _reason_counts(source: LineSource, null_measures: bool = False) -> DataFrame:
    """Raw lines by the first reason that drops them: reason, cnt."""
    # The reason a line has of itself, counted per invoice; then whether the invoice has a customer.
    of_line = drop_reason(F.lit(0), F.col("quantity"), F.col("unit_price"), null_measures)
    reasons = [BAD_QUANTITY, BAD_PRICE, NULL_MEASURE, KEPT]
    counts = {reason: (F.sum, (of_line == reason).cast("bigint")) for reason in reasons}
    no_customer = {"no_customer": F.col("customer_id").isNull()}
    counted = source.raw_by(counts, no_customer, "customer_id", "quantity", "unit_price")
    return (
        counted.unpivot("no_customer", [F.col(f"`{reason}`") for reason in reasons], "of_line", "n")
        .filter("n > 0")
        .groupBy(F.when(F.col("no_customer"), NO_CUSTOMER).otherwise(F.col("of_line")).alias("reason"))
        .agg(F.sum("n").alias("cnt"))
    )


def _with_shares(counts: DataFrame) -> DataFrame:
    # One row per reason is left here.
    share = percent_or_zero(F.col("cnt"), F.sum("cnt").over(Window.partitionBy()))
    return counts.withColumn("pct", share).orderBy(F.desc("cnt"), "reason")


def filter_reasons(source: LineSource, null_measures: bool = False) -> DataFrame:
    """Raw lines by the first reason that drops them, with their share of all raw lines."""
    return _with_shares(_reason_counts(source, null_measures))


OF_INVOICE = [name for name in PROFILED_COLUMNS if name in INVOICE_COLUMNS and name != "invoice_no"]
OF_LINE = [name for name in PROFILED_COLUMNS if name not in OF_INVOICE]


def _missing_measures() -> tuple[Measures, Keys]:
    measures = {"lines": (F.sum, F.lit(1).cast("bigint"))}
    measures |= {name: (F.sum, F.col(name).isNull().cast("bigint")) for name in OF_LINE}
    return measures, {name: F.col(name).isNull() for name in OF_INVOICE}


def _missing_report(parts: DataFrame) -> DataFrame:
    missing = {name: F.when(F.col(name), F.col("lines")).otherwise(0) if name in OF_INVOICE else F.col(name) for name in PROFILED_COLUMNS}
    counts = parts.agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("rows"),
        *[F.coalesce(F.sum(value), F.lit(0)).alias(f"miss_{name}") for name, value in missing.items()],
    )
    missing = [f"miss_{name}" for name in PROFILED_COLUMNS]
    shares = [percent_or_zero(F.col(name), F.col("rows")).alias(f"{name}_pct") for name in missing]
    return counts.select(*missing, *shares)


def missing_profile(source: LineSource) -> DataFrame:
    """Number and share of cleaned lines with a NULL, for each key column, in one pass."""
    # At most one row for each combination of what invoices lack.
    return _missing_report(source.detail_by(*_missing_measures(), *PROFILED_COLUMNS))


RANGE_COLUMNS = ["invoice_date", "quantity", "unit_price"]


def _range_measures() -> tuple[Measures, Keys]:
    measures = {
        "min_quantity": (F.min, F.col("quantity")),
        "max_quantity": (F.max, F.col("quantity")),
        "min_unit_price": (F.min, F.col("unit_price")),
        "max_unit_price": (F.max, F.col("unit_price")),
        "spend": (F.sum, F.expr(LINE_AMOUNT)),
    }
    return measures, {"day": F.col("invoice_date")}


def _range_report(by_day: DataFrame) -> DataFrame:
    return by_day.agg(
        F.min("day").cast("string").alias("min_invoice_date"),
        F.max("day").cast("string").alias("max_invoice_date"),
        F.min("min_quantity").alias("min_quantity"),
        F.max("max_quantity").alias("max_quantity"),
        F.min("min_unit_price").cast("double").alias("min_unit_price"),
        F.max("max_unit_price").cast("double").alias("max_unit_price"),
        money(F.sum("spend")).alias("gmv"),
    )


def value_ranges(source: LineSource) -> DataFrame:
    """Smallest and largest date, quantity and price of the cleaned lines, and their revenue."""
    return _range_report(source.detail_by(*_range_measures(), *RANGE_COLUMNS))


def quality_reports(source: LineSource) -> dict[str, DataFrame]:
    """The reports of `kept_ratio`, `filter_reasons`, `missing_profile` and `value_ranges`; each layer's lines are read once.

    What the reports are made of is staged: a row for each reason, and one for each day and combination of what invoices lack.
    """
    reasons = stage(_reason_counts(source), "reasons")
    measures, keys = (one | other for one, other in zip(_missing_measures(), _range_measures(), strict=True))
    profile = stage(source.detail_by(measures, keys, *dict.fromkeys([*PROFILED_COLUMNS, *RANGE_COLUMNS])), "profile")
    counts = reasons.select(F.col("cnt").alias("ods"), F.lit(0).alias("dwd"))
    counts = counts.unionByName(profile.select(F.lit(0).alias("ods"), F.col("lines").alias("dwd")))
    rows = counts.agg(*[F.coalesce(F.sum(layer), F.lit(0)).alias(f"{layer}_rows") for layer in ("ods", "dwd")])
    return {
        "kept_ratio": _with_kept_ratio(rows),
        "ods_filter_reasons": _with_shares(reasons),
        "dwd_missing_profile": _missing_report(profile),
        "dwd_value_ranges": _range_report(profile),
    }


def quality_figures(source: LineSource) -> DataFrame:
    """All figures of `quality_reports` in one frame: report, figure, value; dates as days since 1970."""
    found = []
    for report, rows in quality_reports(source).items():
        if report == "ods_filter_reasons":
            figures = rows.select(F.col("reason").alias("figure"), F.col("cnt").cast("double").alias("value"))
        else:
            numbers = [
                (F.unix_date(F.col(name).cast("date")) if name.endswith("date") and kind == "string" else F.col(name)).cast("double").alias(name)
                for name, kind in rows.dtypes
            ]
            figures = rows.select(numbers).unpivot([], rows.columns, "figure", "value")
        found.append(figures.select(F.lit(report).alias("report"), "figure", "value"))
    return reduce(DataFrame.unionByName, found)


def layer_row_counts(source: LineSource) -> DataFrame:
    """Rows of the raw and the cleaned layer; the raw count needs no column and no join."""
    raw = source.raw().agg(F.lit("ODS (Raw)").alias("Layer"), F.count("*").alias("Rows"))
    detail = source.spend_by().select(
        F.lit("DWD (Clean)").alias("Layer"), F.coalesce("line_count", F.lit(0)).alias("Rows")
    )
    return raw.unionByName(detail)


def kept_ratio(source: LineSource) -> DataFrame:
    """Raw rows, cleaned rows and the percentage kept."""
    layer, rows = F.col("Layer"), F.col("Rows")
    counts = layer_row_counts(source).agg(
        F.max(F.when(layer.startswith("ODS"), rows)).alias("ods_rows"),
        F.max(F.when(layer.startswith("DWD"), rows)).alias("dwd_rows"),
    )
    return _with_kept_ratio(counts)


def _with_kept_ratio(counts: DataFrame) -> DataFrame:
    return counts.withColumn("kept_pct", percent_or_zero(F.col("dwd_rows"), F.col("ods_rows")))
