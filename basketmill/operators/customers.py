"""Relations at customer grain."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketmill.sources.lines import LineSource


def with_first_month(customer_months: DataFrame) -> DataFrame:
    """Add each customer's first month to a (customer_id, sale_month, ...) relation.

    A customer has at most one row per month here, so even the busiest customer is a small window.
    """
    by_customer = Window.partitionBy("customer_id")
    return customer_months.withColumn("first_month", F.min("sale_month").over(by_customer))


def customer_totals(source: LineSource) -> DataFrame:
    """Last purchase date, number of invoices (`frequency`) and spend per customer, from stored scores if there are any."""
    stored = source.scored()
    if stored is not None:
        return stored.select("customer_id", "last_date", "frequency", "spend")
    invoices = source.spend_by("customer_id", "invoice_no").groupBy("customer_id")
    return invoices.agg(
        F.max("last_date").alias("last_date"), F.count("invoice_no").alias("frequency"), F.sum("spend").alias("spend")
    )
