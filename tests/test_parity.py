"""Every registered query against its SQL twin, and against known facts of the data."""

from __future__ import annotations

import pytest
from conftest import SMALL
from parity import ORACLES, QUERIES, differences

import __spark_entry__


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_same_result_as_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), ORACLES[name], SMALL) == []


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 687


def test_known_counts(star):
    from basketmill.plans.registry import JOBS

    reasons = {row["reason"]: row["cnt"] for row in JOBS["ods_filter_reasons"](star).collect()}
    assert reasons == {
        "drop:CustomerID_is_null": 825,
        "drop:Quantity_non_positive": 1700,
        "drop:UnitPrice_non_positive": 58,
        "keep:DWD": 3417,
    }
    bands = [(row["price_bucket"], row["order_count"]) for row in JOBS["order_value_buckets"](star).collect()]
    assert bands == [("< £10", 8), ("£10 - £50", 27), ("£50 - £100", 28), ("£100 - £500", 421), (">= £500", 702)]
    segments = {row["user_segment_label"]: row["user_count"] for row in JOBS["rfm_segment_labels"](star).collect()}
    assert segments == {
        "Champions": 27, "Loyal": 36, "New": 13, "At Risk": 22, "Hibernating": 33, "Promising": 19,
    }
    assert JOBS["cohort_retention_calendar"](star).count() == 725
    assert JOBS["repurchase_rate"](star).collect()[0][:2] == (150, 149)
