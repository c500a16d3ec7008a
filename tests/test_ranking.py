"""Distributed n-tiles against the built-in window function."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketmill.operators.ranking import tile_starts, with_tiles
from basketmill.operators.staging import stage


def mismatches(df, rankings, tiles):
    stored = stage(df, "input")
    scored = with_tiles(stored, "id", {name: F.col(value) for name, value in rankings.items()}, tiles)
    expected = scored
    for name, value in rankings.items():
        expected = expected.withColumn(f"{name}_window", F.ntile(tiles).over(Window.orderBy(value, "id")))
    wrong = " OR ".join(f"{name} != {name}_window" for name in rankings)
    return expected.filter(wrong).count()


@pytest.mark.parametrize("rows", [0, 1, 3, 4, 5, 7, 101, 5003, 20000])
def test_ties_and_small_inputs(spark, rows):
    # A third of the rows share one value of `a`; `b` has 19 values; `c` has none twice.
    df = spark.range(rows).selectExpr(
        "id * 7919 % 1000003 AS id",
        "if(id % 3 = 0, 5, id % 100) AS a",
        "id % 19 AS b",
        "-id AS c",
    )
    assert mismatches(df, {"r": "a", "f": "b", "m": "c"}, 5) == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-3, 3), max_size=40), tiles=st.integers(1, 7))
def test_random_values(spark, values, tiles):
    df = spark.createDataFrame(list(enumerate(values)), "id bigint, v bigint")
    assert mismatches(df, {"t": "v"}, tiles) == 0


@given(rows=st.integers(0, 200), tiles=st.integers(1, 9))
def test_tile_starts(rows, tiles):
    starts = [0, *tile_starts(rows, tiles), rows]
    sizes = [b - a for a, b in zip(starts, starts[1:])]
    expected = [rows // tiles + (1 if tile < rows % tiles else 0) for tile in range(tiles)]
    assert sizes == [size for size in expected if size] or rows == 0
