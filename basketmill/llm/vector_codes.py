"""Vector codes: a codebook for each part of the vectors, trained in whole numbers and searched by Orchard's method.

The method keeps, for every entry of a codebook, the other entries in order of their distance from it. A search holds the
nearest entry found so far and walks that entry's list. Where it meets a nearer entry it goes over to that one's list; entries it
has met before are marked and passed over. It ends where the list's next entry is more than twice as far from the
entry held as the point is, as by the triangle inequality no later one can be as near. All is
exact: distances are squared whole numbers, and of equally near entries the one with the lower index is found.

Each round is one pass over the vectors. Tasks add up their own parts per entry, so that a shuffle carries at most one row per
task, entry and position; the codebooks alone, of a fixed size, reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmill.llm.common import ship_code
from basketmill.llm.vectors import finite_rows, is_finite, joined, scaled_floor
from basketmill.operators.staging import stage

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Whole components stay below this, so that the squared distance of two vectors of 64 components fits a long.
LIMIT = 2**27
#: Below this, squared distances of parts of up to 8 components are whole doubles, which are faster.
DOUBLES = 2**23
#: A label with more than this share of the rows is joined by broadcast: there are fewer of them than 1 / share.
HEAVY = 1 / 200


class Orchard:
    """A codebook, and for every entry the other ones in order of distance, then index."""

    def __init__(self, entries: np.ndarray):
        small = entries.shape[1] <= 8 and np.abs(entries).max() < DOUBLES
        self.entries, self.doubles = entries, entries.astype(np.float64) if small else None
        apart = ((entries[:, None] - entries) ** 2).sum(axis=2)
        order = np.argsort(apart, axis=1, kind="stable")
        self.lists = [
            [(int(other), int(apart[entry, other])) for other in row if other != entry] for entry, row in enumerate(order)
        ]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each point's nearest entry, and the squared distance.

        Points that hold the same entry walk its list together.
        """
        if self.doubles is not None and len(points) and np.abs(points).max() < DOUBLES:
            points = points.astype(np.float64)
        held = np.zeros(len(points), dtype=np.int64)
        best = self._distance(points, 0)
        met = np.ones(len(points), dtype=np.int64)  # a bit for each entry
        waiting: list[list[np.ndarray]] = [[] for _ in self.entries]
        waiting[0].append(np.arange(len(points)))
        while any(waiting):
            # The entry that most points wait at: they are fewer walks in all.
            entry = max(range(len(waiting)), key=lambda one: sum(map(len, waiting[one])))
            rows, waiting[entry] = np.concatenate(waiting[entry]), []
            self._walk(entry, rows, points, held, best, met, waiting)
        return held, best.astype(np.int64)

    def _walk(
        self,
        entry: int,
        rows: np.ndarray,
        points: np.ndarray,
        held: np.ndarray,
        best: np.ndarray,
        met: np.ndarray,
        waiting: list[list[np.ndarray]],
    ) -> None:
        own, nearest, seen = points[rows], best[rows], met[rows]
        walking = np.ones(len(rows), dtype=bool)
        for other, gap in self.lists[entry]:
            walking &= gap <= 4 * nearest  # of squares: at most twice the distance
            count = np.count_nonzero(walking)
            if not count:
                return
            if count < 0.7 * len(rows):
                rows, own, nearest, seen = rows[walking], own[walking], nearest[walking], seen[walking]
                walking = np.ones(count, dtype=bool)
            at = np.flatnonzero(walking & (seen & 1 << other == 0))
            if not len(at):
                continue
            seen |= 1 << other
            # Gathering points costs more than their distances, so those that need none may be taken along.
            few = len(at) < 0.4 * len(rows)
            distance = self._distance(own[at], other) if few else self._distance(own, other)[at]
            nearer = distance <= nearest[at] if other < entry else distance < nearest[at]
            gone = at[nearer]
            if len(gone):
                moved = rows[gone]
                best[moved], held[moved], met[moved] = distance[nearer], other, seen[gone]
                waiting[other].append(moved)
                walking[gone] = False

    def _distance(self, points: np.ndarray, entry: int) -> np.ndarray:
        apart = points - (self.entries if points.dtype == np.int64 else self.doubles)[entry]
        return np.einsum("ij,ij->i", apart, apart)


def encode(whole: np.ndarray, books: list[Orchard]) -> tuple[np.ndarray, np.ndarray]:
    """(row, part): index of the nearest entry, and each row's squared distances added up."""
    width = whole.shape[1] // len(books)
    codes = np.zeros((len(whole), len(books)), dtype=np.uint8)
    error = np.zeros(len(whole), dtype=np.int64)
    for part, book in enumerate(books):
        found, distance = book.nearest(np.ascontiguousarray(whole[:, part * width : (part + 1) * width]))
        codes[:, part] = found
        error += distance
    return codes, error


def entry_totals(whole: np.ndarray, codes: np.ndarray, entries: int) -> np.ndarray:
    """(part, entry, 1 + position): number of the parts that have this entry, and their components added up."""
    parts = codes.shape[1]
    cut = np.column_stack([np.ones(len(whole), dtype=np.int64), whole]).astype(np.float64)
    width = whole.shape[1] // parts
    totals = np.zeros((parts, entries, 1 + width), dtype=np.int64)
    for part in range(parts):
        chosen = (np.arange(entries)[:, None] == codes[:, part]).astype(np.float64)
        own = cut[:, [0, *range(1 + part * width, 1 + (part + 1) * width)]]
        totals[part] = chosen @ own  # of whole numbers far below 2**53, so exact
    return totals


def train(rows: DataFrame, seeds: np.ndarray, parts: int, rounds: int, vector: str) -> np.ndarray:
    """(part, entry, position): the codebooks after all rounds, the seeds' parts being the first ones."""
    size, width = seeds.shape[1], seeds.shape[1] // parts
    books = np.stack([seeds[:, part * width : (part + 1) * width] for part in range(parts)])

    for _ in range(rounds):

        def sums(batches: Iterator[pa.RecordBatch], books: np.ndarray = books) -> Iterator[pa.RecordBatch]:
            searches = [Orchard(book) for book in books]
            totals = np.zeros((parts, len(seeds), 1 + width), dtype=np.int64)
            for batch in joined(batches):
                whole = scaled_floor(finite_rows(batch.column(0), size)[1], SCALE, LIMIT)
                totals += entry_totals(whole, encode(whole, searches)[0], len(seeds))
            at = np.argwhere(totals)
            yield pa.record_batch([*at.T, totals[tuple(at.T)]], names=["part", "entry", "position", "total"])

        found = rows.select(vector).mapInArrow(sums, "part long, entry long, position long, total long")
        found = found.groupBy("part", "entry", "position").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        totals = np.zeros((parts, len(seeds), 1 + width), dtype=object)
        for row in found.collect():  # as many as the codebooks have numbers
            totals[row["part"], row["entry"], row["position"]] = int(row["total"])
        used = totals[:, :, 0] > 0
        books = books.copy()
        books[used] = (totals[used][:, 1:] // totals[used][:, :1]).astype(np.int64)
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    table: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Per vector: vec_id, code, error, label_error, codebooks_sha256.

    Components count as floor(4096 x). The first codebooks are the parts of the `entries` vectors with the smallest ids, of
    equal ids by the vectors' order; null ids come last. Fewer vectors give fewer entries.
    label_error adds up the errors of all rows with the same label, null labels together. The table is read once in each round and
    should be a stored one.

    Rows whose vector is null, empty, or has a null or non-finite component are left out. All others must be of one size that is a
    multiple of `parts`, with components below 2**15 in size, or the job fails. Repeated rows are coded each, null ids stay null,
    other columns are ignored, and no rows give none.
    """
    spark = table.sparkSession
    ship_code(spark)
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    first = rows.filter(is_finite("vector")).orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries)
    seeds = [row["vector"] for row in first.collect()]
    schema = f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, code string, error long"
    if not seeds:
        empty = spark.createDataFrame([], schema)
        return empty.select("vec_id", "code", "error", F.col("error").alias("label_error"), F.col("code").alias("codebooks_sha256"))
    size = len(seeds[0])
    if size % parts or any(len(seed) != size for seed in seeds):
        raise ValueError(f"vectors of {sorted({len(seed) for seed in seeds})} components can't be cut into {parts} equal parts")
    books = train(rows, scaled_floor(np.array(seeds, dtype=np.float64), SCALE, LIMIT), parts, rounds, "vector")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Orchard(book) for book in books]
        for batch in joined(batches):
            kept, matrix = finite_rows(batch.column("vector"), size)
            codes, error = encode(scaled_floor(matrix, SCALE, LIMIT), searches)
            digits, length = codes.tobytes().hex(), 2 * parts
            code = [digits[start : start + length] for start in range(0, len(digits), length)]
            own = batch.select(["vec_id", "label"]).take(pa.array(kept))
            yield pa.record_batch([*own.columns, pa.array(code, pa.string()), error], names=["vec_id", "label", "code", "error"])

    done = stage(rows.mapInArrow(coded, schema), "vector-codes")
    sums = done.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    sums = stage(sums.withColumnRenamed("label", "of"), "vector-labels")
    least = HEAVY * done.count()
    # Fewer than 1 / HEAVY rows. The rest shuffles by labels none of which is frequent.
    heavy = F.broadcast(sums.filter(F.col("n") > least).drop("n"))
    light = sums.filter(F.col("n") <= least).drop("n")
    same = F.col("label").eqNullSafe(F.col("of"))
    others = done.join(heavy, same, "left_anti").join(light, same)
    both = done.join(heavy, same).unionByName(others)
    return both.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
