"""Product reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketmill.functions.calendar import month_text
from basketmill.functions.numeric import money, percent
from basketmill.sources.lines import LineSource


def _ranked_products(source: LineSource, top: int) -> DataFrame:
    revenue = source.product_lines("sale_month", "line_amount").groupBy("sale_month", "product_key").agg(F.sum("line_amount").alias("revenue"))
    revenue = source.with_product(revenue, "product_name")
    # The rank filter lets Spark cut each partition down to the top rows before the shuffle by month.
    best_first = Window.partitionBy("sale_month").orderBy(F.desc("revenue"), F.asc_nulls_first("product_name"))
    return (
        revenue.withColumn("rank_in_month", F.row_number().over(best_first))
        .filter(F.col("rank_in_month") <= top)
        .select(
            month_text(F.col("sale_month")).alias("sale_month"),
            "rank_in_month",
            "product_name",
            money(F.col("revenue")).alias("monthly_revenue"),
        )
    )


def monthly_top_products(source: LineSource, top: int = 3) -> DataFrame:
    """Products with the highest revenue in each month; equal revenues rank by product text."""
    return _ranked_products(source, top).orderBy("sale_month", "rank_in_month")


def latest_month(ranked: DataFrame) -> DataFrame:
    """The last month of a `monthly_top_products` result, by rank."""
    # A few rows per month: one task is enough, and the result is not computed twice.
    last = F.max("sale_month").over(Window.partitionBy())
    return (
        ranked.withColumn("last_month", last)
        .filter(F.col("sale_month") == F.col("last_month"))
        .drop("last_month")
        .orderBy("rank_in_month")
    )


def latest_month_top3(source: LineSource) -> DataFrame:
    """The top three products of the last month with sales."""
    return latest_month(_ranked_products(source, 3))


def gmv_by_product(source: LineSource) -> DataFrame:
    """Revenue per product over all time."""
    spend = source.product_lines("line_amount").groupBy("product_key").agg(money(F.sum("line_amount")).alias("gmv"))
    return source.with_product(spend, "product_name").select("product_name", "gmv")


def hot_products(source: LineSource, top: int = 20) -> DataFrame:
    """Products on the most invoices."""
    # Every invoice is there once; one without a number isn't counted.
    counts = source.product_invoices().groupBy("product_key").agg(F.count("invoice_no").alias("OrderCount"))
    return (
        source.with_product(counts, "Description")
        .select("Description", "OrderCount")
        .orderBy(F.desc("OrderCount"), F.asc_nulls_first("Description"))
        .limit(top)
    )


def product_repurchase(source: LineSource, min_buyers: int = 50, top: int = 10) -> DataFrame:
    """Products by the share of their buyers who bought them on two or more invoices."""
    # Two or more invoices are a first one and another last one, which needs no distinct count.
    lines = source.product_lines("customer_id", "invoice_no").groupBy("customer_id", "product_key")
    purchases = lines.agg(F.min("invoice_no").alias("first"), F.max("invoice_no").alias("last"))
    # One row per buyer and product, so rows are buyers.
    buyers = purchases.groupBy("product_key").agg(
        F.count("*").alias("total_buyers"), F.count_if(F.col("first") < F.col("last")).alias("repurchase_buyers")
    )
    rate = percent(F.col("repurchase_buyers"), F.col("total_buyers"), 1)
    return (
        source.with_product(buyers.filter(F.col("total_buyers") >= min_buyers), "product")
        .select("product", "total_buyers", "repurchase_buyers", rate.alias("repurchase_rate_pct"))
        .orderBy(F.desc("repurchase_rate_pct"), F.asc_nulls_first("product"))
        .limit(top)
    )
