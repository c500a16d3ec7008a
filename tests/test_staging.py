"""Staged tables are gone once the job that needed them ends."""

from __future__ import annotations

import os

import pytest
from conftest import SMALL
from parity import ORACLES, QUERIES, differences

from basketmill.operators.staging import stage, staging_folder, staging_job, unstage

#: The queries that stage something, by any of the ways there are.
STAGING = (
    "rfm_segments", "cohort_retention_matrix", "quality_figures", "build_ads", "stored_detail", "stored_rfm_customers", "sql_on_layers",
)


def left(spark):
    return set(os.listdir(staging_folder(spark).removeprefix("file:")))


@pytest.mark.parametrize("name", STAGING)
def test_nothing_is_left_behind(spark, name):
    before = left(spark)
    with staging_job(spark):
        assert differences(QUERIES[name](spark, SMALL), ORACLES[name], SMALL) == []
        assert left(spark) - before
    assert left(spark) == before


def test_jobs_within_jobs(spark):
    before = left(spark)
    with staging_job(spark):
        with staging_job(spark) as inner:
            kept, dropped = inner.keep(stage(spark.range(3), "kept")), stage(spark.range(4), "dropped")
            assert len(left(spark) - before) == 2
        assert kept.count() == 3 and len(left(spark) - before) == 1
        with pytest.raises(Exception, match="exist"):
            dropped.count()
        grown = stage(kept.unionByName(kept), "grown", kept)
        assert grown.count() == 6 and len(left(spark) - before) == 1
        unstage(grown)
        unstage(spark.range(1))
        assert left(spark) == before
    with pytest.raises(RuntimeError, match="no more"):
        with staging_job(spark):
            stage(spark.range(2), "failed")
            raise RuntimeError("no more")
    assert left(spark) == before
