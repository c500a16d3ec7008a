"""Sources agree with each other, and the jobs with themselves."""

from __future__ import annotations

import pytest
from conftest import SMALL
from lines import rows
from pyspark.sql import functions as F

from basketmill.operators.cleaning import IS_KEPT
from basketmill.plans.registry import JOBS
from basketmill.schema import DETAIL_COLUMNS, INVOICE_COLUMNS
from basketmill.sources.lines import FrameSource, LineSource
from basketmill.sources.star import StarSource
from basketmill.sources.stored import with_staged_invoices

RAW_COLUMNS = ["invoice_no", "stock_code", "description", "quantity", "invoice_date", "unit_price", "customer_id", "country"]


@pytest.fixture(scope="module")
def flat(star):
    """The same lines as one flat raw frame, cleaned like a file."""
    return FrameSource(star.raw(*RAW_COLUMNS))


def same_rows(a, b):
    assert a.columns == b.columns
    assert sorted(rows(a), key=str) == sorted(rows(b), key=str)


def test_star_cleans_like_a_flat_source(star, flat):
    same_rows(star.detail(*DETAIL_COLUMNS), flat.detail(*DETAIL_COLUMNS))


def test_narrow_reads_are_projections_of_the_whole(star):
    for name in DETAIL_COLUMNS:
        same_rows(star.detail(name), star.detail(*DETAIL_COLUMNS).select(name))
    for name in RAW_COLUMNS:
        same_rows(star.raw(name), star.raw(*RAW_COLUMNS).select(name))


@pytest.mark.parametrize(
    "keys",
    [
        (), ("sale_month",), ("country",), ("country", "sale_month"), ("customer_id", "invoice_no"), ("invoice_no", "country"),
        ("sale_hour", "invoice_no"), ("customer_id", "sale_month"), tuple(INVOICE_COLUMNS), ("description", "sale_month"),
    ],
)
def test_sums_do_not_depend_on_where_they_are_made(star, flat, keys):
    # The default implementation adds up lines; the star source and stored invoices start elsewhere.
    plain = LineSource.spend_by(flat, *keys).withColumn("spend", F.col("spend").cast("decimal(38,4)"))
    for source in (star, with_staged_invoices(flat)):
        other = source.spend_by(*keys)
        same_rows(plain, other.withColumn("spend", F.col("spend").cast("decimal(38,4)")).select(plain.columns))


@pytest.mark.parametrize("name", [name for name in JOBS if name not in ("build_ods", "build_dwd")])
def test_jobs_do_not_depend_on_the_source(star, flat, name):
    same_rows(JOBS[name](star), JOBS[name](flat))


def test_invariants(spark, star):
    kept = star.detail("customer_id").count()
    assert star.raw("customer_id", "quantity", "unit_price").filter(IS_KEPT).count() == kept
    reasons = JOBS["ods_filter_reasons"](star).collect()
    assert sum(row["cnt"] for row in reasons) == star.table("lineitem").count()
    assert abs(sum(row["pct"] for row in reasons) - 100) < 0.05

    monthly = dict(rows(JOBS["monthly_revenue"](star)))
    split = JOBS["new_vs_returning_gmv"](star).groupBy("order_month").agg(F.sum("gmv"))
    assert dict(rows(split)) == pytest.approx(monthly, abs=0.011)

    segments = JOBS["rfm_segments"](star).collect()
    customers = JOBS["repurchase_rate"](star).collect()[0]["total_customers"]
    assert sum(row["user_count"] for row in segments) == customers
    assert abs(sum(row["user_pct"] for row in segments) - 100) < 0.5
    # Spend is rounded per customer before it is added up.
    assert sum(row["segment_gmv"] for row in segments) == pytest.approx(sum(monthly.values()), abs=0.005 * customers)

    running = JOBS["customer_running_spend"](star)
    last = running.groupBy("CustomerID").agg(
        F.round(F.max("cumulative_spend"), 2).alias("total"), F.round(F.sum("monthly_spend"), 2).alias("spend")
    )
    assert last.filter(F.abs(F.col("total") - F.col("spend")) > 0.001).count() == 0

    for name in ("cohort_retention", "cohort_retention_calendar"):
        starts = JOBS[name](star).filter("month_offset = 0")
        assert starts.filter("retention_rate != 100 OR active_users != cohort_size").count() == 0


def test_folder_with_a_trailing_slash(spark, star):
    assert StarSource(spark, SMALL + "/").table("nation").count() == star.table("nation").count()
