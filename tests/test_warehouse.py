"""The stored layers, from a file to the result tables."""

from __future__ import annotations

import pytest
from lines import rows
from pyspark.sql import functions as F

from basketmill.plans.registry import JOBS, RESULT_TABLES
from basketmill.schema import RESULT_COLUMNS
from basketmill.session import sized_for
from basketmill.warehouse import Warehouse

FILE_COLUMNS = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]


@pytest.fixture(scope="module")
def warehouse(spark, star, tmp_path_factory):
    """A warehouse built from a CSV export of the star-schema lines."""
    folder = tmp_path_factory.mktemp("files")
    lines = JOBS["build_ods"](star).withColumn(
        "InvoiceDate", F.date_format(F.to_timestamp("InvoiceDate"), "M/d/yyyy H:mm")
    )
    lines.select(FILE_COLUMNS).repartition(3).write.option("header", True).option("encoding", "ISO-8859-1").option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/csv")
    spark.sql("CREATE DATABASE shop")
    built = Warehouse(spark, "shop", location=str(tmp_path_factory.mktemp("tables")))
    assert built.build_ods(f"{folder}/csv") == 6000
    assert built.build_dwd() == 3417
    return built


def test_missing_table_is_named(spark):
    with pytest.raises(LookupError, match="default.ods_sales does not exist"):
        Warehouse(spark).build_ads()


def test_jobs_on_stored_tables(warehouse, star):
    source = warehouse.source()
    for name in ("dwd_missing_profile", "kept_ratio", "rfm_segments", "monthly_top3_products", "cohort_retention"):
        assert rows(JOBS[name](source)) == rows(JOBS[name](star)), name


def test_result_tables_are_replaced(warehouse, star):
    first = warehouse.build_ads()
    stored = {name: sorted(rows(warehouse.table(name)), key=str) for name in first}
    assert warehouse.build_ads() == first
    for name, columns in RESULT_COLUMNS.items():
        table = warehouse.table(name)
        assert table.columns == columns
        assert sorted(rows(table), key=str) == stored[name]
        assert table.count() == first[name]
    assert [row["name"] for row in warehouse.result_tables().collect()] == sorted(RESULT_COLUMNS)
    assert [row["name"] for row in warehouse.tables().collect()] == sorted(
        [*RESULT_COLUMNS, "ods_sales", "dwd_sales", "dws_customer_months", "dws_customers", "dws_invoices"]
    )


def test_a_failed_rebuild_keeps_the_table(spark, tmp_path):
    spark.sql("CREATE DATABASE safe")
    for place in (None, str(tmp_path)):
        here = Warehouse(spark, "safe", place)
        assert here.write(spark.range(5), "numbers") == 5
        with pytest.raises(Exception, match="no more"):
            here.write(spark.range(9).selectExpr("id", "IF(id = 7, raise_error('no more'), 1) AS one"), "numbers")
        assert sorted(rows(here.table("numbers"))) == [(n,) for n in range(5)]
        assert Warehouse(spark, "safe", place).table("numbers").count() == 5
        for size in (6, 7, 8):  # a table may be replaced by what is read from it, and by other columns
            grown = here.table("numbers").unionByName(spark.range(size - 1, size))
            assert here.write(grown, "numbers") == size
        assert here.write(spark.range(3).selectExpr("id", "id % 2 AS odd"), "numbers", partition_by="odd") == 3
        assert sorted(rows(here.table("numbers"))) == [(0, 0), (1, 1), (2, 0)]
        spark.sql("DROP TABLE safe.numbers")


def test_detail_table_by_month(warehouse, star):
    assert warehouse.build_dwd(by_month=True) == 3417
    month = warehouse.source().detail("sale_month", "line_amount").filter("sale_month = DATE'1998-10-01'")
    assert "PartitionFilters: [isnotnull(sale_month" in month._jdf.queryExecution().toString()
    assert rows(JOBS["monthly_revenue"](warehouse.source())) == rows(JOBS["monthly_revenue"](star))


def test_views_with_the_names_of_the_source_file(spark, warehouse, star):
    warehouse.register_views("raw_file", "clean_file")
    assert spark.table("raw_file").columns == FILE_COLUMNS
    revenue = spark.sql("SELECT Country, SUM(TotalLineItemAmount) AS r FROM clean_file GROUP BY Country ORDER BY r DESC LIMIT 10")
    assert [row["Country"] for row in revenue.collect()] == [row["Country"] for row in JOBS["top_countries"](star).collect()]


def test_a_later_session_attaches_the_tables(spark, warehouse):
    spark.sql("CREATE DATABASE again")
    later = Warehouse(spark, "again", location=warehouse.location)
    assert rows(JOBS["kept_ratio"](later.source())) == [(6000, 3417, 56.95)]
    warehouse.build_dwd(by_month=True)
    spark.sql("CREATE DATABASE by_month")
    later = Warehouse(spark, "by_month", location=warehouse.location)
    assert dict(later.table("dwd_sales").dtypes) == dict(warehouse.table("dwd_sales").dtypes)
    assert rows(JOBS["dwd_value_ranges"](later.source())) == rows(JOBS["dwd_value_ranges"](warehouse.source()))
    with pytest.raises(LookupError, match="by_month.nothing does not exist"):
        later.table("nothing")


def test_old_versions_are_removed(spark, tmp_path):
    spark.sql("CREATE DATABASE versions")
    here = Warehouse(spark, "versions", str(tmp_path))
    for size in range(4):
        assert here.write(spark.range(size), "numbers") == size  # an empty table too
        assert here.table("numbers").count() == size
    assert len(list((tmp_path / "numbers").iterdir())) == 2


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    """The number comes from the write itself: a table that is written anew at each reading would tell."""
    spark.sql("CREATE DATABASE counted")
    here = Warehouse(spark, "counted", str(tmp_path))
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    assert here.write(spark.range(100).mapInArrow(seen, "id long"), "numbers") == 100
    assert reads.value == 100


def test_jobs_start_from_the_smallest_stored_sums(warehouse, star):
    source = warehouse.source()
    for name, table in (
        ("cohort_retention", "dws_customer_months"), ("customer_running_spend", "dws_customer_months"),
        ("new_vs_returning_gmv", "dws_customer_months"), ("monthly_gmv_mom", "dws_customer_months"),
        ("rfm_segments", "dws_customers"), ("rfm_customers", "dws_customers"), ("rfm_customer_detail", "dws_customers"),
        ("rfm_segment_labels", "dws_customers"), ("top_customers", "dws_customers"), ("repurchase_rate", "dws_customers"),
        ("hourly_order_volume", "dws_invoices"),
    ):
        job = JOBS[name](source)
        plan = job._jdf.queryExecution().toString()
        read = {word for word in ("dws_invoices", "dwd_sales", "ods_sales", "dws_customers", "dws_customer_months") if f"{word}/" in plan}
        assert read == {table}, name
        if name.startswith("rfm"):
            assert "rangepartitioning(ranking" not in plan, name
        assert sorted(rows(job), key=str) == sorted(rows(JOBS[name](star)), key=str), name


def test_customer_months_need_no_shuffle_by_customer(spark, warehouse):
    text = JOBS["customer_running_spend"](warehouse.source())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Window" in text
    # A later session knows the buckets too.
    spark.sql("CREATE DATABASE buckets")
    later = Warehouse(spark, "buckets", location=warehouse.location)
    text = JOBS["customer_running_spend"](later.source())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text


def test_refused_lines_are_stored(spark, tmp_path):
    (tmp_path / "lines.csv").write_text(
        ",".join(FILE_COLUMNS) + "\n" + '1,S,"a\nb",6,1/2/2011 8:26:30 PM,2.5,17850,UK\n' + '2,S,12" A,6,1/2/2011 8:26:30 PM,2.5,1,UK 5",LOST\n'
        "3,S,c,6.00000000004,1/2/2011 8:26:30 PM,2.5,1,UK\n4,S,c,6\n"
    )
    spark.sql("CREATE DATABASE refused")
    here = Warehouse(spark, "refused", str(tmp_path / "tables"))
    assert here.build_ods(str(tmp_path / "lines.csv"), on_extra_fields="reject", on_bad_number="reject") == 2
    assert sorted(row["problem"] for row in here.table("ods_rejects").collect()) == ["not a whole number in Quantity", "too many fields"]
    assert here.build_dwd() == 1
    row = here.source().detail("invoice_ts", "description").first()
    assert (str(row["invoice_ts"]), row["description"]) == ("2011-01-02 20:26:30", "A\nB")


def test_command_line(spark, warehouse, capsys):
    from basketmill.__main__ import main

    here = ["--database", "shop", "--location", warehouse.location]
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        main(["quality", *here])
        # The session is sized by what lies at the location.
        assert spark.conf.get("spark.sql.shuffle.partitions") == sized_for(0)["spark__sql__shuffle__partitions"]
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        main(["show", "repurchase_rate", *here])
        main(["results", *here])
        main(["stored", "rfm_segment_labels", *here])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    with pytest.raises(SystemExit):
        main(["quality", "--database", "shop"])
    with pytest.raises(SystemExit, match="nothing_there.ods_sales does not exist"):
        spark.sql("CREATE DATABASE nothing_there")
        main(["show", "top_countries", "--database", "nothing_there", "--location", f"{warehouse.location}/none"])
    output = capsys.readouterr().out
    assert "drop:CustomerID_is_null" in output and "repurchase_rate_pct" in output and "ads_rfm_segments 6" in output
    assert "Champions" in output


def test_stored_results_need_no_line(warehouse, star):
    warehouse.build_ads()
    for name in ("latest_month_top3", "rfm_segment_labels", "cohort_retention_matrix"):
        stored = warehouse.result(name)
        assert "sales" not in stored._jdf.queryExecution().toString().lower()
        assert sorted(rows(stored), key=str) == sorted(rows(JOBS[name](star)), key=str)
    for name, job in RESULT_TABLES.items():
        assert rows(warehouse.result(name)) == rows(job(star)), name
