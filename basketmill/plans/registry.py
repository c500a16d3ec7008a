"""Jobs by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from basketmill.plans import cohort, layers, products, quality, repurchase, revenue, rfm
from basketmill.sources.lines import LineSource

Job = Callable[[LineSource], DataFrame]

JOBS: dict[str, Job] = {
    "build_ods": layers.raw_lines,
    "build_dwd": layers.detail_lines,
    "monthly_top3_products": products.monthly_top_products,
    "monthly_gmv_mom": revenue.monthly_gmv_mom,
    "customer_running_spend": revenue.customer_running_spend,
    "rfm_segments": rfm.rfm_segments,
    "rfm_customers": rfm.rfm_customers,
    "rfm_customer_detail": rfm.rfm_customer_detail,
    "rfm_segment_labels": rfm.rfm_segment_labels,
    "cohort_retention": cohort.cohort_retention,
    "cohort_retention_pivot6": cohort.cohort_retention_pivot6,
    "cohort_retention_matrix": cohort.cohort_retention_matrix,
    "cohort_retention_calendar": cohort.cohort_retention_calendar,
    "repurchase_rate": repurchase.repurchase_rate,
    "new_vs_returning_gmv": revenue.new_vs_returning_gmv,
    "product_repurchase_top10": products.product_repurchase,
    "order_value_buckets": revenue.order_value_buckets,
    "average_order_value": revenue.average_order_value,
    "ods_filter_reasons": quality.filter_reasons,
    "dwd_missing_profile": quality.missing_profile,
    "dwd_value_ranges": quality.value_ranges,
    "kept_ratio": quality.kept_ratio,
    "quality_figures": quality.quality_figures,
    "layer_row_counts": quality.layer_row_counts,
    "top_countries": revenue.top_countries,
    "monthly_revenue": revenue.monthly_revenue,
    "hourly_order_volume": revenue.hourly_order_volume,
    "top_customers": revenue.top_customers,
    "hot_products": products.hot_products,
    "latest_month_top3": products.latest_month_top3,
    "gmv_by_product": products.gmv_by_product,
}

#: What is read from a stored result table: the table, and what to make of it.
STORED_RESULTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "latest_month_top3": ("ads_monthly_top3_products", products.latest_month),
    "rfm_segment_labels": ("ads_rfm_segments", rfm.with_english_segment),
    "cohort_retention_matrix": ("ads_cohort_retention", cohort.retention_matrix),
}

# Jobs whose results are kept as tables.
RESULT_TABLES: dict[str, Job] = {
    "ads_monthly_top3_products": JOBS["monthly_top3_products"],
    "ads_monthly_gmv_mom": JOBS["monthly_gmv_mom"],
    "ads_rfm_segments": JOBS["rfm_segments"],
    "ads_cohort_retention": JOBS["cohort_retention"],
    "ads_top_customers": JOBS["top_customers"],
    "ads_hourly_sales": JOBS["hourly_order_volume"],
}
