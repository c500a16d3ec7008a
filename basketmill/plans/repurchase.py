"""Repurchase rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmill.functions.numeric import percent
from basketmill.operators.customers import customer_totals
from basketmill.sources.lines import LineSource


def repurchase_rate(source: LineSource) -> DataFrame:
    """Share of customers with two or more invoices."""
    counts = customer_totals(source)
    return counts.agg(
        F.count("*").alias("total_customers"), F.count_if(F.col("frequency") >= 2).alias("repurchase_customers")
    ).withColumn("repurchase_rate_pct", percent(F.col("repurchase_customers"), F.col("total_customers"), 1))
