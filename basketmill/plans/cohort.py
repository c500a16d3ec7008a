"""Cohort retention."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketmill.functions.calendar import calendar_month_offset, mean_month_offset, month_text
from basketmill.functions.numeric import percent
from basketmill.operators.customers import with_first_month
from basketmill.operators.staging import stage
from basketmill.sources.lines import LineSource


def _retention(source: LineSource, month_offset: Callable[[Column, Column], Column]) -> DataFrame:
    customer_months = with_first_month(source.spend_by("customer_id", "sale_month"))
    counts = (
        customer_months.withColumn("month_offset", month_offset(F.col("first_month"), F.col("sale_month")))
        .filter(F.col("month_offset") >= 0)
        .groupBy("first_month", "month_offset")
        .agg(F.count("*").alias("active_users"))
    )
    # Every cohort has offset 0, the month that defines it.
    starters = F.max(F.when(F.col("month_offset") == 0, F.col("active_users")))
    return (
        counts.withColumn("cohort_size", starters.over(Window.partitionBy("first_month")))
        .withColumn("cohort_month", month_text(F.col("first_month")))
        .withColumn("retention_rate", percent(F.col("active_users"), F.col("cohort_size"), 1))
        .select("cohort_month", "month_offset", "active_users", "cohort_size", "retention_rate")
    )


def cohort_retention(source: LineSource) -> DataFrame:
    """Active customers per cohort and offset, where an offset is a span of mean months.

    Short months fold into their neighbour, which can count a customer twice at one offset;
    `cohort_retention_calendar` does not.
    """
    return _retention(source, mean_month_offset).orderBy("cohort_month", "month_offset")


def cohort_retention_calendar(source: LineSource) -> DataFrame:
    """Active customers per cohort and calendar-month offset."""
    return _retention(source, calendar_month_offset).orderBy("cohort_month", "month_offset")


def cohort_retention_pivot6(source: LineSource) -> DataFrame:
    """Retention of offsets 0 to 5 as columns, one row per cohort."""
    months = range(6)
    rates = (
        cohort_retention(source)
        .groupBy("cohort_month", "cohort_size")
        .pivot("month_offset", list(months))
        .agg(F.max("retention_rate"))
    )
    named = rates.select("cohort_month", "cohort_size", *[F.col(str(n)).alias(f"M{n}_%") for n in months])
    return named.orderBy("cohort_month")


def retention_matrix(retention: DataFrame) -> DataFrame:
    """Grid of cohorts by every offset that occurs; `retention` must be a stored table, as it is read twice."""
    return retention.groupBy("cohort_month").pivot("month_offset").agg(F.first("retention_rate")).orderBy("cohort_month")


def cohort_retention_matrix(source: LineSource) -> DataFrame:
    """`cohort_retention` as a grid."""
    return retention_matrix(stage(_retention(source, mean_month_offset), "retention"))


def retention_cells(matrix: DataFrame) -> DataFrame:
    """The grid as one row per cell, empty ones too."""
    offsets = [F.col(f"`{name}`") for name in matrix.columns if name != "cohort_month"]
    if not offsets:
        return matrix.selectExpr("cohort_month", "CAST(NULL AS INT) AS month_offset", "CAST(NULL AS DOUBLE) AS retention_rate")
    cells = matrix.unpivot("cohort_month", offsets, "month_offset", "retention_rate")
    return cells.withColumn("month_offset", F.col("month_offset").cast("int"))
