"""Exact n-tiles over a whole table, without a window that runs as one task."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmill.operators.staging import stage

Cuts = dict[str, list[tuple[int, int]]]


def tile_starts(rows: int, tiles: int) -> list[int]:
    """Zero-based ranks at which the second to last tiles start; the first `rows % tiles` tiles hold one row more."""
    size, larger = divmod(rows, tiles)
    starts = [tile * size + min(tile, larger) for tile in range(1, tiles)]
    return [rank for rank in starts if rank < rows]


def tile_cuts(df: DataFrame, key: str, rankings: dict[str, Column], tiles: int) -> Cuts:
    """For each ranking, the (value, key) pairs at which its second to last tiles start.

    All rankings are stacked and range-partitioned by (ranking, value, key) in one shuffle. The
    key breaks ties, so a value shared by a third of the rows spreads over partitions like any
    other. The sorted rows are written with their position. Row counts per partition then tell
    where each tile starts, and only those rows, fewer than `tiles` per ranking, are fetched.
    """
    entries = [F.struct(F.lit(name).alias("ranking"), value.alias("value")) for name, value in rankings.items()]
    order = ["ranking", "value", key]
    placed = stage(
        df.select(F.inline(F.array(*entries)), key)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("position", F.expr("monotonically_increasing_id()")),
        "ranked",
    )
    # The upper bits of a position are its partition, so there is one run per ranking and partition.
    runs = (
        placed.groupBy("ranking", F.expr("shiftright(position, 33) AS part"))
        .agg(F.expr("min(position) AS first"), F.expr("count(*) AS rows"))
        .collect()
    )
    runs.sort(key=lambda run: run["first"])
    wanted = []
    for ranking in rankings:
        own = [run for run in runs if run["ranking"] == ranking]
        starts = tile_starts(sum(run["rows"] for run in own), tiles)
        before = 0
        for run in own:
            wanted += [run["first"] + rank - before for rank in starts if before <= rank < before + run["rows"]]
            before += run["rows"]
    cuts: Cuts = {ranking: [] for ranking in rankings}
    for ranking, value, key_value in placed.filter(F.col("position").isin(wanted)).select(order).collect():
        cuts[ranking].append((value, key_value))
    return cuts


def with_tiles(df: DataFrame, key: str, rankings: dict[str, Column], tiles: int) -> DataFrame:
    """Add an n-tile column per ranking, equal to `ntile(tiles) over (order by value, key)`.

    `df` must be a stored table, as it is read more than once; `key` is a unique bigint and the
    ranking values are non-null bigints. Once the cuts are known, scoring needs no shuffle: the
    tile of a row is one more than the number of cuts at or before it.
    """
    cuts = tile_cuts(df, key, rankings, tiles)

    def tile(value: Column, ranking: str) -> Column:
        reached = [
            ((value > cut) | ((value == cut) & (F.col(key) >= cut_key))).cast("int") for cut, cut_key in cuts[ranking]
        ]
        return reduce(add, reached, F.lit(1))

    return df.withColumns({ranking: tile(value, ranking) for ranking, value in rankings.items()})
