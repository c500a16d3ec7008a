"""Edge cases of the jobs on hand-written lines."""

from __future__ import annotations

from datetime import date

import pytest
from lines import detail_frame, empty_source, line, rows, source_of
from pyspark.sql import functions as F

from basketmill.functions.calendar import calendar_month_offset, mean_month_offset
from basketmill.functions.labels import drop_reason, price_band, segment
from basketmill.functions.numeric import percent, percent_or_zero, round_half_up
from basketmill.plans import cohort, products, quality, repurchase, revenue, rfm
from basketmill.plans.registry import JOBS
from basketmill.schema import RAW_SCHEMA
from basketmill.sources.lines import FrameSource

ONE_ROW_WHEN_EMPTY = {
    "repurchase_rate", "average_order_value", "dwd_missing_profile", "dwd_value_ranges", "kept_ratio",
}


@pytest.mark.parametrize("name", JOBS)
def test_empty_input(spark, name):
    expected = {"layer_row_counts": 2, "quality_figures": 22} | dict.fromkeys(ONE_ROW_WHEN_EMPTY, 1)
    assert JOBS[name](empty_source(spark)).count() == expected.get(name, 0)


@pytest.mark.parametrize(
    ("cohort_month", "activity_month", "mean", "calendar"),
    [
        ("2011-02-01", "2011-03-01", 0, 1),
        ("2011-04-01", "2011-05-01", 0, 1),
        ("2010-12-01", "2011-03-01", 2, 3),
        ("2011-05-01", "2011-06-01", 1, 1),
        ("2010-12-01", "2011-12-01", 11, 12),
        ("2011-01-01", "2011-01-01", 0, 0),
    ],
)
def test_month_offsets(spark, cohort_month, activity_month, mean, calendar):
    df = spark.createDataFrame([(date.fromisoformat(cohort_month), date.fromisoformat(activity_month))], "c date, a date")
    found = df.select(mean_month_offset(F.col("c"), F.col("a")), calendar_month_offset(F.col("c"), F.col("a")))
    assert rows(found) == [(mean, calendar)]


def test_cohort_folds_short_months(spark):
    # One customer buys in February and March 2011, another only in February.
    source = source_of(
        spark, [line("1", 1, "2011-02-03"), line("2", 1, "2011-03-03"), line("3", 2, "2011-02-20"), line("4", 2, "2011-02-21")]
    )
    assert rows(cohort.cohort_retention(source)) == [("2011-02", 0, 3, 3, 100.0)]
    assert rows(cohort.cohort_retention_calendar(source)) == [("2011-02", 0, 2, 2, 100.0), ("2011-02", 1, 1, 2, 50.0)]


def test_cohort_grids(spark):
    source = source_of(
        spark,
        [line("1", 1, "2011-01-03"), line("2", 1, "2011-03-03"), line("3", 2, "2011-05-20"), line("4", 2, "2012-05-21")],
    )
    pivot = cohort.cohort_retention_pivot6(source)
    assert pivot.columns == ["cohort_month", "cohort_size", "M0_%", "M1_%", "M2_%", "M3_%", "M4_%", "M5_%"]
    assert rows(pivot) == [
        ("2011-01", 1, 100.0, 100.0, None, None, None, None),
        ("2011-05", 1, 100.0, None, None, None, None, None),
    ]
    matrix = cohort.cohort_retention_matrix(source)
    assert matrix.columns == ["cohort_month", "0", "1", "12"]
    assert rows(matrix) == [("2011-01", 100.0, 100.0, None), ("2011-05", 100.0, None, 100.0)]


def test_growth_against_previous_month_with_sales(spark):
    monthly = spark.createDataFrame(
        [(date(2011, 1, 1), "100.00"), (date(2011, 2, 1), "150.00"), (date(2011, 5, 1), "0.00"), (date(2011, 6, 1), "9.00")],
        "sale_month date, gmv string",
    ).withColumn("gmv", F.col("gmv").cast("decimal(18,2)"))
    assert rows(revenue.month_over_month(monthly)) == [
        ("2011-01", 100.0, None, None),
        ("2011-02", 150.0, 100.0, 50.0),
        ("2011-05", 0.0, 150.0, -100.0),
        ("2011-06", 9.0, 0.0, None),
    ]


def test_top_products_with_ties_and_missing_product(spark):
    source = source_of(
        spark,
        [
            line("1", 1, "2011-01-03", "5", "B"),
            line("1", 1, "2011-01-03", "5", "A"),
            line("2", 2, "2011-01-04", "5", None),
            line("3", 2, "2011-01-05", "1", "C"),
            line("4", 2, "2011-02-05", "1", "C"),
        ],
    )
    top = products.monthly_top_products(source)
    assert rows(top) == [
        ("2011-01", 1, None, 5.0),
        ("2011-01", 2, "A", 5.0),
        ("2011-01", 3, "B", 5.0),
        ("2011-02", 1, "C", 1.0),
    ]
    assert rows(products.latest_month_top3(source)) == [("2011-02", 1, "C", 1.0)]
    assert sorted(rows(products.gmv_by_product(source)), key=str) == sorted(
        [(None, 5.0), ("A", 5.0), ("B", 5.0), ("C", 2.0)], key=str
    )
    assert rows(products.hot_products(source))[0] == ("C", 2)


def test_product_repurchase_counts_buyers(spark):
    lines = [line(f"{c}", c, "2011-01-03", product="CUP") for c in range(50)]
    lines += [line(f"again-{c}", c, "2011-01-04", product="CUP") for c in range(10)]
    lines += [line("0", 0, "2011-01-03", product="CUP")]  # same invoice, no repurchase
    lines += [line(f"{c}", c, "2011-01-03", product="RARE") for c in range(49)]
    assert rows(products.product_repurchase(source_of(spark, lines))) == [("CUP", 50, 10, 20.0)]


def test_running_spend(spark):
    source = source_of(
        spark,
        [
            line("1", 1, "2011-01-03", "0.005"),
            line("2", 1, "2011-01-04", "1.5", quantity=2),
            line("3", 1, "2011-03-04", "2"),
            line("4", 2, "2011-02-04", "7"),
        ],
    )
    assert rows(revenue.customer_running_spend(source, ordered=True)) == [
        (1, "2011-01", 3.01, 3.01),
        (1, "2011-03", 2.0, 5.01),
        (2, "2011-02", 7.0, 7.0),
    ]


def test_new_and_returning(spark):
    source = source_of(
        spark,
        [line("1", 1, "2011-01-03", "5"), line("2", 1, "2011-02-03", "3"), line("3", 2, "2011-02-04", "4"), line("4", 2, "2011-02-05", "4")],
    )
    assert rows(revenue.new_vs_returning_gmv(source)) == [
        ("2011-01", "新客", 5.0, 1),
        ("2011-02", "新客", 8.0, 1),
        ("2011-02", "老客", 3.0, 1),
    ]


@pytest.mark.parametrize(
    ("total", "band"),
    [
        ("9.99", "< £10"), ("10", "£10 - £50"), ("49.99", "£10 - £50"), ("50", "£50 - £100"), ("99.99", "£50 - £100"),
        ("100", "£100 - £500"), ("499.99", "£100 - £500"), ("500", ">= £500"),
    ],
)
def test_price_bands(spark, total, band):
    df = spark.range(1).select(price_band(F.lit(total).cast("decimal(18,2)")))
    assert rows(df) == [(band,)]


def test_order_values(spark):
    source = source_of(
        spark, [line("1", 1, "2011-01-03", "600"), line("2", 1, "2011-01-03", "4"), line("2", 1, "2011-01-03", "5"), line("3", 2, "2011-01-03", "2")]
    )
    assert rows(revenue.order_value_buckets(source)) == [("< £10", 2, 11.0, 5.5), (">= £500", 1, 600.0, 600.0)]
    assert rows(revenue.average_order_value(source)) == [(3, 611.0, 203.67)]
    assert rows(repurchase.repurchase_rate(source)) == [(2, 1, 50.0)]


def test_hours_countries_and_customers(spark):
    source = source_of(
        spark,
        [
            line("1", 1, "2011-01-03", "2", hour=9), line("1", 1, "2011-01-03", "3", hour=9),
            line("2", 1, "2011-01-04", "5", hour=9), line("3", 2, "2011-01-05", "10", hour=17, country="EIRE"),
            line("4", 3, "2011-01-05", "1", hour=17, country=None),
        ],
    )
    assert rows(revenue.hourly_order_volume(source)) == [("09", 2), ("17", 2)]
    assert rows(revenue.top_countries(source)) == [("EIRE", 10.0), ("France", 10.0), (None, 1.0)]
    assert rows(revenue.top_customers(source, top=2)) == [(1, 2, 10.0), (2, 1, 10.0)]


def test_segments_cover_every_score(spark):
    scores = spark.range(125).selectExpr(
        "CAST(id % 5 + 1 AS INT) r", "CAST(id DIV 5 % 5 + 1 AS INT) f", "CAST(id DIV 25 + 1 AS INT) m"
    )
    for r, f, m, found in rows(scores.select("r", "f", "m", segment(F.col("r"), F.col("f"), F.col("m")))):
        # The segments' thresholds and names.
        if r >= 4 and f >= 4 and m >= 4:
            expected = "高价值用户"
        elif r >= 3 and f >= 3:
            expected = "忠诚用户"
        elif r >= 4 and f <= 2:
            expected = "新客户"
        elif r <= 2 and f >= 3 and m >= 3:
            expected = "流失高价值用户"
        elif r <= 2 and f <= 2:
            expected = "沉睡用户"
        else:
            expected = "潜力用户"
        assert found == expected, (r, f, m)


def test_recency_is_at_least_one_day(spark):
    source = source_of(spark, [line("1", 1, "2011-01-03"), line("2", 2, "2011-01-10"), line("3", 2, "2011-01-08")])
    found = {row["CustomerID"]: row for row in rfm.rfm_customers(source).collect()}
    assert (found[1]["recency_days"], found[2]["recency_days"]) == (8, 1)
    assert (found[1]["frequency"], found[2]["frequency"]) == (1, 2)
    assert (found[1]["r_score"], found[2]["r_score"]) == (1, 2)


def test_customer_without_dates_ranks_most_recent(spark):
    source = source_of(spark, [line("1", 1, None), line("2", 2, "2011-01-10")])
    found = {row["CustomerID"]: row for row in rfm.rfm_customers(source).collect()}
    assert (found[1]["recency_days"], found[1]["r_score"], found[2]["r_score"]) == (None, 2, 1)


def test_drop_reasons_and_null_measures(spark):
    raw = spark.createDataFrame(
        [(None, -1, "1"), (1, 0, "1"), (1, 1, "0"), (1, None, "1"), (1, 1, None), (1, 1, "1")],
        "customer_id bigint, quantity int, price string",
    ).withColumn("unit_price", F.col("price").cast("decimal(12,4)"))
    columns = F.col("customer_id"), F.col("quantity"), F.col("unit_price")
    found = rows(raw.select(drop_reason(*columns), drop_reason(*columns, null_measures=True)))
    kept, null = "keep:DWD", "drop:null_measure"
    assert [row[0] for row in found[3:]] == [kept, kept, kept]
    assert [row[1] for row in found[3:]] == [null, null, kept]


def test_missing_profile_and_ranges(spark):
    source = FrameSource(
        spark.createDataFrame([], RAW_SCHEMA),
        detail_frame(spark, [line("1", 1, None, "0.5", None), line("2", 2, "2011-01-10", "3", quantity=4)]),
    )
    profile = quality.missing_profile(source).collect()[0].asDict()
    assert profile["miss_description"] == 1 and profile["miss_description_pct"] == 50.0
    assert profile["miss_invoice_date"] == 1 and profile["miss_customer_id"] == 0
    assert rows(quality.value_ranges(source)) == [("2011-01-10", "2011-01-10", 1, 4, 0.5, 3.0, 12.5)]


def test_rounding_and_zero_totals(spark):
    df = spark.range(1).select(
        round_half_up(F.lit(1.005), 2),
        round_half_up(F.lit(-2.5), 0),
        percent(F.lit(1), F.lit(0), 1),
        percent_or_zero(F.lit(1), F.lit(0)),
        percent(F.lit(1), F.lit(3), 1),
    )
    assert rows(df) == [(1.01, -3.0, None, 0.0, 33.3)]
