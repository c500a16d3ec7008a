"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Trees are fitted on a bounded sample: a node splits its sample at the median of a projection on the line through two of its
vectors. Every vector is then sent down every tree. A query gives every leaf a priority, the sum
of the squared distances to the hyperplanes on the way that it lies on the wrong side of, and takes leaves of all
trees in one order of priority, as from a shared priority queue, until they hold a share of all rows. Candidates
are ranked by their exact inner products.

Leaves that lie together make pages of bounded size, and a leaf with more rows is spread over several. In a task a page's
vectors are held and the queries that visit it stream past. What a query finds in a page goes on only if it reaches the
query's `k`-th best score among the sample's vectors in the leaves it takes, all of which it finds again in the pages.

For vectors of different lengths one dimension is added that makes them equally long; nearest by angle is then largest by product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketmill.llm.common import draw, ship_code

#: Vectors that the trees are fitted on, at most.
SAMPLE = 16_384
#: Sample vectors in a leaf, about, and the deepest tree.
LEAF_SAMPLE = 32
DEEPEST = 9
TREES = 3
#: Candidates that a query takes from the queue, as a share of the rows.
SEARCH_SHARE = 1.4
PAGE_ROWS = 4096
AT_ONCE = 256


def _lengthened(vectors: np.ndarray, longest: float) -> np.ndarray:
    """With the dimension that makes all vectors as long as the longest one."""
    rest = np.sqrt(np.maximum(0.0, longest**2 - np.einsum("ij,ij->i", vectors, vectors)))
    return np.column_stack([vectors, rest])


def _as_queries(vectors: np.ndarray, longest: float) -> np.ndarray:
    lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    return np.column_stack([vectors * (longest / lengths)[:, None], np.zeros(len(vectors))])


@dataclass
class Tree:
    """A complete binary tree; node n has the children 2n+1 and 2n+2, leaves are counted from left to right."""

    depth: int
    lines: np.ndarray
    cuts: np.ndarray

    def leaves(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(self.depth):
            side = np.einsum("ij,ij->i", points, self.lines[node]) > self.cuts[node]
            node = 2 * node + 1 + side
        return node - (2**self.depth - 1)

    def priorities(self, queries: np.ndarray) -> np.ndarray:
        """(query, leaf): squared distances to the cuts that the leaf is behind, added up."""
        level = np.zeros((len(queries), 1))
        for depth in range(self.depth):
            nodes = slice(2**depth - 1, 2 ** (depth + 1) - 1)
            margin = queries @ self.lines[nodes].T - self.cuts[nodes]
            both = [level + np.maximum(margin, 0) ** 2, level + np.maximum(-margin, 0) ** 2]
            level = np.stack(both, axis=2).reshape(len(queries), -1)
        return level


def fit_tree(sample: np.ndarray, depth: int, seed: int) -> Tree:
    rng = np.random.default_rng(seed)
    lines, cuts = np.zeros((2**depth - 1, sample.shape[1])), np.zeros(2**depth - 1)
    groups = [np.arange(len(sample))]
    for node in range(2**depth - 1):
        group = groups[node]
        line = np.zeros(sample.shape[1])
        if len(group) > 1:
            one, other = rng.choice(group, 2, replace=False)
            line = sample[one] - sample[other]
        if not line.any():  # equal vectors, or none
            line = rng.normal(size=sample.shape[1])
        line /= np.linalg.norm(line)
        along = sample[group] @ line
        cut = float(np.median(along)) if len(group) else 0.0
        lines[node], cuts[node] = line, cut
        groups += [group[along <= cut], group[along > cut]]
    return Tree(depth, lines, cuts)


@dataclass
class Pages:
    """Where each leaf's rows lie: its first page and over how many pages they are spread."""

    first: np.ndarray
    spread: np.ndarray
    rows: np.ndarray


def lay_out(rows: np.ndarray) -> Pages:
    """Pages for leaves with so many rows, leaf after leaf."""
    first, spread = np.zeros(len(rows), dtype=np.int64), np.ones(len(rows), dtype=np.int64)
    page, filled = 0, 0
    for leaf, count in enumerate(rows):
        if filled and filled + count > PAGE_ROWS:
            page, filled = page + 1, 0
        first[leaf] = page
        spread[leaf] = max(1, -(-count // PAGE_ROWS))
        if spread[leaf] > 1:
            page, filled = page + int(spread[leaf]), 0
        else:
            filled += int(count)
    return Pages(first, spread, rows)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def usable(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector as doubles) of the rows that take part.

    Not those without an id, nor those whose vector is null, zero, of another size than most, or has a null or non-finite part.
    """
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ) & F.exists("vector", lambda x: x != 0)
    rows = rows.filter("vec_id IS NOT NULL AND vector IS NOT NULL").filter(finite)
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.filter(F.size("vector") == (sizes["size"] if sizes else 0))


def nearest(
    table: DataFrame,
    k: int = 20,
    every: int = 20,
    trees: int = TREES,
    share: float = SEARCH_SHARE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Per query and rank: query_id, rank, vec_id, score; the `k` nearest found, ties to the smaller vec_id.

    Queries are the rows whose id is divisible by `every`, candidates all rows with another id. Rows that `usable` leaves out
    take no part. If an id is repeated, its rows are candidates of their own, the best one standing for the id, and the
    id is queried with the vector that comes first in order. Other columns are ignored. No rows give none.
    """
    spark = table.sparkSession
    ship_code(spark)
    rows = usable(table, vec_id, vector)
    squared = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    totals = rows.agg(F.count("*").alias("n"), F.sqrt(F.max(squared)).alias("longest")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not totals["n"]:
        return spark.createDataFrame([], schema)
    longest = totals["longest"]
    chosen = draw(rows, SAMPLE, "vec_id", "vector")
    sample_ids = np.array([row["vec_id"] for row in chosen])
    sample = np.array([row["vector"] for row in chosen])
    depth = max(0, min(DEEPEST, int(np.log2(max(1, len(sample) / LEAF_SAMPLE)))))
    forest = [fit_tree(_lengthened(sample, longest), depth, seed) for seed in range(trees)]
    per_tree = 2**depth
    shared_forest = spark.sparkContext.broadcast(forest)

    @F.pandas_udf("array<long>")
    def leaves_of(vectors: pd.Series) -> pd.Series:
        points = _lengthened(_matrix(vectors), longest)
        found = [tree.leaves(points) + number * per_tree for number, tree in enumerate(shared_forest.value)]
        return pd.Series(list(np.stack(found, axis=1)))

    indexed = rows.withColumn("leaf", F.explode(leaves_of("vector")))
    sizes = np.zeros(trees * per_tree, dtype=np.int64)
    for row in indexed.groupBy("leaf").count().collect():  # at most a row for each leaf
        sizes[row["leaf"]] = row["count"]
    pages = lay_out(sizes)
    # The sample is bounded, and so are the forest and the leaves' table.
    sample_leaves = [tree.leaves(_lengthened(sample, longest)) + at * per_tree for at, tree in enumerate(forest)]
    shared = spark.sparkContext.broadcast((pages, sample_ids, sample, sample_leaves))
    budget = max(k, int(share * totals["n"]))

    @F.pandas_udf("long")
    def page_of(leaves: pd.Series, ids: pd.Series) -> pd.Series:
        pages = shared.value[0]
        leaf = leaves.to_numpy(np.int64)
        return pd.Series(pages.first[leaf] + (ids.to_numpy(np.int64) * 2654435761 & 0xFFFFFFFF) % pages.spread[leaf])

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pages, ids, vectors, leaves_of_sample = shared.value
        for batch in batches:
            for start in range(0, len(batch), AT_ONCE):
                part = batch.iloc[start : start + AT_ONCE]
                raw, own = _matrix(part["vector"]), part["vec_id"].to_numpy(np.int64)
                queries = _as_queries(raw, longest)
                priority = np.concatenate([tree.priorities(queries) for tree in shared_forest.value], axis=1)
                order = np.argsort(priority, axis=1, kind="stable")
                before = np.cumsum(pages.rows[order], axis=1) - pages.rows[order]
                taken = np.zeros(order.shape, dtype=bool)
                np.put_along_axis(taken, order, (before < budget) & (pages.rows[order] > 0), axis=1)
                seen = np.logical_or.reduce([taken[:, leaves] for leaves in leaves_of_sample])
                floor = least_scores(raw, own, ids, vectors, seen, k)
                out = []
                for at in range(len(part)):
                    by_page: dict[int, list[int]] = {}
                    for leaf in np.flatnonzero(taken[at]):
                        for page in range(pages.first[leaf], pages.first[leaf] + pages.spread[leaf]):
                            by_page.setdefault(page, []).append(int(leaf))
                    out += [(page, own[at], leaves, floor[at], raw[at]) for page, leaves in by_page.items()]
                yield pd.DataFrame(out, columns=["page", "id", "leaves", "floor", "vector"])

    kept = "page long, id long, leaves array<int>, floor double, vector array<double>"
    queries = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    probes = queries.mapInPandas(visits, kept).withColumn("probe", F.lit(True))
    held = indexed.select(
        page_of("leaf", "vec_id").alias("page"),
        F.col("vec_id").alias("id"),
        F.array(F.col("leaf").cast("int")).alias("leaves"),
        F.lit(0.0).alias("floor"),
        "vector",
        F.lit(False).alias("probe"),
    )
    dealt = held.unionByName(probes).repartition("page").sortWithinPartitions("page", "probe")
    found = dealt.mapInPandas(lambda batches: ranked(batches, k), "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    # The limit is applied before the shuffle too, so that no task holds more of a query than it returns.
    nearest_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    top = best.withColumn("rank", F.row_number().over(nearest_first)).filter(F.col("rank") <= k)
    return top.select("query_id", "rank", "vec_id", "score")


def least_scores(
    queries: np.ndarray, own: np.ndarray, ids: np.ndarray, vectors: np.ndarray, seen: np.ndarray, k: int
) -> np.ndarray:
    """The `k`-th best score of distinct other ids of the sample that are seen, less rounding; -inf if there are fewer."""
    if len(ids) < k:
        return np.full(len(queries), -np.inf)
    scores = queries @ vectors.T
    scores[~seen | (own[:, None] == ids)] = -np.inf
    if len(first := np.unique(ids, return_index=True)[1]) < len(ids):
        scores[:, np.setdiff1d(np.arange(len(ids)), first)] = -np.inf
    floor = np.partition(scores, -k, axis=1)[:, -k]
    return floor - 1e-9 * np.where(np.isfinite(floor), 1 + np.abs(floor), 0)


def ranked(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """Rows (page, probe, id, leaves, floor, vector), each page's vectors before its probes."""
    page, parts, built = None, [], None
    for batch in batches:
        for number, group in batch.groupby("page", sort=True):
            if number != page:
                page, parts, built = number, [], None
            is_probe = group["probe"].to_numpy(bool)
            if not is_probe.all():
                parts.append(group[~is_probe])
            probes = group[is_probe]
            if not len(probes) or not parts:
                continue
            if built is None:
                all_rows = pd.concat(parts)
                leaf = np.array([one[0] for one in all_rows["leaves"]], dtype=np.int64)
                built = (all_rows["id"].to_numpy(np.int64), leaf, _matrix(all_rows["vector"]))
            for start in range(0, len(probes), AT_ONCE):
                yield _best_of(probes.iloc[start : start + AT_ONCE], *built, k)


def _best_of(probes: pd.DataFrame, ids: np.ndarray, leaf: np.ndarray, vectors: np.ndarray, k: int) -> pd.DataFrame:
    own, queries = probes["id"].to_numpy(np.int64), _matrix(probes["vector"])
    known, column = np.unique(leaf, return_inverse=True)
    visited = np.zeros((len(probes), len(known)), dtype=bool)
    for at, leaves in enumerate(probes["leaves"]):
        visited[at] = np.isin(known, leaves)
    scores = queries @ vectors.T
    keep = visited[:, column] & (scores >= probes["floor"].to_numpy(np.float64)[:, None]) & (own[:, None] != ids)
    row, at = np.nonzero(keep)
    # Once more, pair by pair: equal vectors must have equal scores.
    exact = np.einsum("ij,ij->i", queries[row], vectors[at])
    order = np.lexsort((ids[at], -exact, row))
    row, at, exact = row[order], at[order], exact[order]
    found = pd.DataFrame({"query_id": own[row], "vec_id": ids[at], "score": exact})
    found = found.drop_duplicates(["query_id", "vec_id"])
    return found[found.groupby("query_id", sort=False).cumcount() < k]
