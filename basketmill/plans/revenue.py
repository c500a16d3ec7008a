"""Revenue over time, by country, by customer and by invoice."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketmill.functions.calendar import hour_text, month_text
from basketmill.functions.labels import customer_type, price_band
from basketmill.functions.numeric import money, ratio, round_half_up
from basketmill.operators.customers import customer_totals, with_first_month
from basketmill.sources.lines import LineSource


def month_over_month(monthly: DataFrame) -> DataFrame:
    """Growth of (sale_month, gmv) rows against the previous month that has a row."""
    gmv, previous = F.col("gmv"), F.col("prev")
    # One row per month, so the unpartitioned window is small whatever the data size.
    by_month = Window.orderBy("sale_month")
    change = F.try_divide(
        (gmv.cast("double") - previous.cast("double")) * F.lit(100.0), previous.cast("double")
    )
    return (
        monthly.withColumn("prev", F.lag("gmv").over(by_month))
        .select(
            month_text(F.col("sale_month")).alias("sale_month"),
            gmv.cast("double").alias("current_gmv"),
            previous.cast("double").alias("prev_month_gmv"),
            round_half_up(change, 2).alias("mom_growth_pct"),
        )
        .orderBy("sale_month")
    )


def monthly_gmv_mom(source: LineSource) -> DataFrame:
    """Revenue per month, the month before, and the growth in percent."""
    monthly = source.spend_by("sale_month").select("sale_month", F.round("spend", 2).alias("gmv"))
    return month_over_month(monthly)


def monthly_revenue(source: LineSource) -> DataFrame:
    """Unrounded revenue per month."""
    return (
        source.spend_by("sale_month")
        .select(month_text(F.col("sale_month")).alias("Month"), F.col("spend").cast("double").alias("MonthlyRevenue"))
        .orderBy("Month")
    )


def customer_running_spend(source: LineSource, ordered: bool = False) -> DataFrame:
    """Monthly and cumulative spend of each customer.

    The result is as large as the customer-month relation, so it is globally sorted only on request.
    """
    to_date = (
        Window.partitionBy("customer_id").orderBy("sale_month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    monthly = source.spend_by("customer_id", "sale_month").withColumn("spend", F.round("spend", 2))
    running = monthly.withColumn("running", F.sum("spend").over(to_date)).select(
        F.col("customer_id").alias("CustomerID"),
        month_text(F.col("sale_month")).alias("order_month"),
        F.col("spend").cast("double").alias("monthly_spend"),
        money(F.col("running")).alias("cumulative_spend"),
    )
    return running.orderBy("CustomerID", "order_month") if ordered else running


def new_vs_returning_gmv(source: LineSource) -> DataFrame:
    """Revenue and customers per month, split by whether it is the customer's first month."""
    customer_months = with_first_month(source.spend_by("customer_id", "sale_month"))
    # One row per customer and month, so rows are customers.
    return (
        customer_months.withColumn("customer_type", customer_type(F.col("sale_month"), F.col("first_month")))
        .groupBy("sale_month", "customer_type")
        .agg(money(F.sum("spend")).alias("gmv"), F.count("*").alias("user_count"))
        .select(month_text(F.col("sale_month")).alias("order_month"), "customer_type", "gmv", "user_count")
        .orderBy("order_month", "customer_type")
    )


def top_countries(source: LineSource, top: int = 10) -> DataFrame:
    """Countries by revenue."""
    return (
        source.spend_by("country")
        .orderBy(F.desc("spend"), F.asc_nulls_first("country"))
        .limit(top)
        .select(F.col("country").alias("Country"), F.col("spend").cast("double").alias("TotalRevenue"))
    )


def top_customers(source: LineSource, top: int = 10) -> DataFrame:
    """Customers by spend, with their number of invoices."""
    return (
        customer_totals(source)
        .orderBy(F.desc("spend"), "customer_id")
        .limit(top)
        .select(
            F.col("customer_id").alias("CustomerID"),
            F.col("frequency").alias("OrderCount"),
            F.col("spend").cast("double").alias("TotalSpent"),
        )
    )


def hourly_order_volume(source: LineSource) -> DataFrame:
    """Invoices per hour of the day."""
    return (
        source.spend_by("sale_hour", "invoice_no")
        .groupBy("sale_hour")
        .agg(F.count("invoice_no").alias("OrderVolume"))
        .select(hour_text(F.col("sale_hour")).alias("Hour"), "OrderVolume")
        .orderBy("Hour")
    )


def invoice_totals(source: LineSource) -> DataFrame:
    return source.spend_by("invoice_no").select("invoice_no", F.round("spend", 2).alias("total"))


def order_value_buckets(source: LineSource) -> DataFrame:
    """Invoices, revenue and mean invoice value per price band, from the lowest band up."""
    return (
        invoice_totals(source)
        .groupBy(price_band(F.col("total")).alias("price_bucket"))
        .agg(F.count("*").alias("order_count"), F.sum("total").alias("gmv"), F.min("total").alias("lowest"))
        .orderBy("lowest")
        .select(
            "price_bucket",
            "order_count",
            money(F.col("gmv")).alias("bucket_gmv"),
            round_half_up(ratio(F.col("gmv"), F.col("order_count")), 2).alias("avg_order_value"),
        )
    )


def average_order_value(source: LineSource) -> DataFrame:
    """Mean invoice total over all invoices."""
    totals = invoice_totals(source).agg(F.count("*").alias("order_count"), F.sum("total").alias("gmv"))
    return totals.select(
        "order_count",
        money(F.col("gmv")).alias("gmv"),
        round_half_up(ratio(F.col("gmv"), F.col("order_count")), 2).alias("avg_order_value"),
    )
