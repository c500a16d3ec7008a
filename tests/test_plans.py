"""Plan shapes that must hold whatever the data size, and results on heavily skewed data."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from conftest import SMALL
from parity import ORACLES, QUERIES, TABLES, differences
from pyspark.sql import functions as F

from basketmill.plans.registry import JOBS
from basketmill.sources.star import StarSource


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("simple")
    return text.getvalue()


@contextlib.contextmanager
def settings(spark, **conf):
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.fixture(scope="module")
def plans(spark, star):
    """Plans for tables of which none is small enough to broadcast."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        return {name: plan(job(star)) for name, job in JOBS.items()}


def columns_read(text: str, table: str) -> list[set[str]]:
    scans = re.findall(rf"FileScan parquet \[([^\]]*)\][^\n]*/{table}\.parquet", text)
    return [{column.split("#")[0] for column in scan.split(",") if column} for scan in scans]


def test_no_python_and_no_cross_joins(plans):
    for name, text in plans.items():
        for operator in ("Python", "Pandas", "CartesianProduct", "NestedLoopJoin", "ntile"):
            assert operator not in text, (name, operator)


def test_only_needed_columns_and_tables_are_read(plans):
    assert columns_read(plans["monthly_gmv_mom"], "lineitem") == [
        {"l_orderkey", "l_partkey", "l_quantity", "l_returnflag"}
    ]
    assert columns_read(plans["monthly_gmv_mom"], "part") == [{"p_partkey", "p_retailprice"}]
    for name in ("monthly_gmv_mom", "cohort_retention", "customer_running_spend", "order_value_buckets"):
        assert columns_read(plans[name], "customer") == columns_read(plans[name], "nation") == [], name
    # The raw row count needs no column at all.
    assert set() in columns_read(plans["layer_row_counts"], "lineitem")


def test_every_table_is_scanned_once(plans):
    for name, text in plans.items():
        scans = len(columns_read(text, "lineitem"))
        # Two layers are counted in two jobs; what scores and figures are made of is stored before.
        staged = "rfm" in name or "matrix" in name or name == "quality_figures"
        expected = 2 if name in ("layer_row_counts", "kept_ratio") else 0 if staged else 1
        assert scans == expected, name


def test_lines_are_added_up_before_the_join_with_their_invoice(plans):
    profiles = ("ods_filter_reasons", "dwd_missing_profile", "dwd_value_ranges")
    for name in (*profiles, "monthly_gmv_mom", "top_countries", "cohort_retention", "repurchase_rate", "hourly_order_volume"):
        join = plans[name].index("SortMergeJoin [order_key")
        assert "HashAggregate(keys=[order_key" in plans[name][join:], name


def test_no_product_text_goes_through_a_shuffle_of_lines(plans):
    for name in ("monthly_top3_products", "product_repurchase_top10", "hot_products", "gmv_by_product"):
        text = plans[name]
        # The headers' side of the join, and what is below it, has no text but in the products' own shuffle.
        below = text[text.index("SortMergeJoin [order_key") :]
        shuffled = [line for line in below.splitlines() if "Exchange hashpartitioning(order_key" in line or "Exchange hashpartitioning(part_key" in line]
        assert shuffled, name
        joined = [line for line in below.splitlines() if "Project [" in line and "order_key" in line]
        assert joined and not any("description" in line or "p_name" in line for line in joined), name


def test_filters_reach_the_files(plans):
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plans["monthly_gmv_mom"])
    text = " ".join(pushed)
    assert "GreaterThan(l_quantity" in text and "Or(IsNull(l_returnflag)" in text and "GreaterThan(p_retailprice" in text


def test_quality_reports_read_each_layer_once(spark, star, monkeypatch):
    from basketmill.plans import quality

    read = []
    monkeypatch.setattr(quality, "stage", lambda frame, label: read.append(plan(frame)) or frame)
    quality.quality_reports(star)
    assert [len(columns_read(text, "lineitem")) for text in read] == [1, 1]


def test_top_rows_are_cut_before_the_shuffle(plans):
    assert plans["monthly_top3_products"].count("WindowGroupLimit") == 2
    for name in ("top_countries", "top_customers", "hot_products", "product_repurchase_top10", "rfm_customer_detail"):
        assert "TakeOrderedAndProject" in plans[name], name


def test_single_task_steps_see_few_rows(plans):
    for name, text in plans.items():
        operators = [line for line in text.splitlines() if "+- Project" not in line]
        for above, below in zip(operators, operators[1:]):
            if "SinglePartition" in above:
                # Grouped rows, or the top rows of each month.
                assert "HashAggregate" in below or "rank_in_month" in below, (name, below)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The small tables with a third of the lines on one order, a third on one part, a third of the orders on one customer."""
    folder = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        table = spark.read.parquet(f"{SMALL}/{name}.parquet")
        if name == "lineitem":
            number = F.col("l_orderkey") * 7 + F.col("l_linenumber")
            table = table.withColumns(
                {
                    "l_orderkey": F.when(number % 3 == 0, 8).otherwise(F.col("l_orderkey")).cast("bigint"),
                    "l_partkey": F.when(number % 3 == 1, 9).otherwise(F.col("l_partkey")).cast("bigint"),
                }
            ).repartition(8)
        if name == "orders":
            table = table.withColumn(
                "o_custkey", F.when(F.col("o_orderkey") % 3 == 2, 5).otherwise(F.col("o_custkey")).cast("bigint")
            ).repartition(4)
        table.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "2k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "2k",
}


@pytest.mark.parametrize("name", QUERIES)
def test_same_result_on_skewed_data(spark, skewed, name):
    with settings(spark, **SKEW):
        assert differences(QUERIES[name](spark, skewed), ORACLES[name], skewed) == []


def test_hot_keys_are_split(spark, skewed):
    with settings(spark, **SKEW):
        top = JOBS["monthly_top3_products"](StarSource(spark, skewed))
        top.collect()
        assert "skew=true" in plan(top)
