"""Column names, types and table names shared by sources, jobs and the warehouse."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_TABLE = "ods_sales"
DETAIL_TABLE = "dwd_sales"
REJECT_TABLE = "ods_rejects"
INVOICE_TABLE = "dws_invoices"
CUSTOMER_MONTH_TABLE = "dws_customer_months"
CUSTOMER_TABLE = "dws_customers"
RESULT_PREFIX = "ads_"

# Header of the source file, in file order -> column name inside the engine.
FILE_COLUMNS = {
    "InvoiceNo": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "UnitPrice": "unit_price",
    "CustomerID": "customer_id",
    "Country": "country",
}

PRICE_TYPE = T.DecimalType(12, 4)

RAW_SCHEMA = T.StructType(
    [
        T.StructField("invoice_no", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("invoice_date", T.StringType()),
        T.StructField("unit_price", PRICE_TYPE),
        T.StructField("customer_id", T.LongType()),
        T.StructField("country", T.StringType()),
    ]
)

DETAIL_SCHEMA = T.StructType(
    [
        T.StructField("invoice_no", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("invoice_ts", T.TimestampNTZType()),
        T.StructField("invoice_date", T.DateType()),
        T.StructField("sale_month", T.DateType()),
        T.StructField("sale_hour", T.IntegerType()),
        T.StructField("unit_price", PRICE_TYPE),
        T.StructField("customer_id", T.LongType()),
        T.StructField("country", T.StringType()),
        T.StructField("line_amount", T.DecimalType(23, 4)),
    ]
)
DETAIL_COLUMNS = DETAIL_SCHEMA.fieldNames()

# Attributes that belong to the invoice and not to one of its lines.
INVOICE_COLUMNS = ["invoice_no", "customer_id", "invoice_date", "sale_month", "sale_hour", "country"]

# Columns of each stored result table, in order.
RESULT_COLUMNS = {
    "ads_monthly_top3_products": ["sale_month", "rank_in_month", "product_name", "monthly_revenue"],
    "ads_monthly_gmv_mom": ["sale_month", "current_gmv", "prev_month_gmv", "mom_growth_pct"],
    "ads_rfm_segments": [
        "user_segment", "user_count", "user_pct", "segment_gmv", "gmv_pct",
        "avg_monetary", "avg_frequency", "avg_recency_days",
    ],
    "ads_cohort_retention": ["cohort_month", "month_offset", "active_users", "cohort_size", "retention_rate"],
    "ads_top_customers": ["CustomerID", "OrderCount", "TotalSpent"],
    "ads_hourly_sales": ["Hour", "OrderVolume"],
}

# The order in which each result table is read; a minus sign means descending.
RESULT_ORDER = {
    "ads_monthly_top3_products": ["sale_month", "rank_in_month"],
    "ads_monthly_gmv_mom": ["sale_month"],
    "ads_rfm_segments": ["-segment_gmv", "user_segment"],
    "ads_cohort_retention": ["cohort_month", "month_offset"],
    "ads_top_customers": ["-TotalSpent", "CustomerID"],
    "ads_hourly_sales": ["Hour"],
}
