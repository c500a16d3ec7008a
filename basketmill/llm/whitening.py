"""Whitening: the leading principal components of centred vectors, by a block Jacobi-Davidson method.

The covariance is never formed. What the method needs of it are products with a few vectors at a time, each of which is one pass
over the stored distinct vectors: tasks centre their vectors in whole numbers, multiply, and add up.

A search space is kept with its image under the covariance. Rayleigh-Ritz in it gives the leading Ritz pairs and their
residuals r. Pairs whose residual is at the level of rounding are locked. For each other pair (u, t) a few steps of MINRES
solve the correction equation (I - UU')(V - t)(I - UU') z = -r, U being all locked and current Ritz vectors; the equations of
all pairs run in step, so that one pass serves all. The corrections widen the space, and a space that is full is started again
from its best Ritz vectors. Only blocks of a few columns, as long as a vector, reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmill.llm.common import ship_code
from basketmill.llm.vectors import finite_rows, is_finite, joined, scaled_floor
from basketmill.operators.staging import stage

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
#: Scaled components stay below this.
LIMIT = 2**40
#: MINRES steps in each round, and columns of a search space in multiples of the number of components.
INNER = 3
WIDEST = 5
#: A residual of so many roundings of the largest eigenvalue is at the level of double precision.
ROUNDINGS = 32
MOST_ROUNDS = 200
LONG = 2**63

Product = Callable[[np.ndarray], np.ndarray]


def _orthonormal(block: np.ndarray, against: np.ndarray, least: float = 1e-10) -> np.ndarray:
    """An orthonormal base of what the columns add to an orthonormal base; columns that add nothing are left out."""
    kept = against
    for column in block.T:
        length = np.linalg.norm(column)
        if not length:
            continue
        column = column / length
        for _ in range(3):
            column = column - kept @ (kept.T @ column)
        size = np.linalg.norm(column)
        if size > least:
            column /= size
            column -= kept @ (kept.T @ column)
            kept = np.column_stack([kept, column / np.linalg.norm(column)])
    return kept[:, against.shape[1] :]


def minres(product: Product, shifts: np.ndarray, base: np.ndarray, right: np.ndarray, steps: int) -> np.ndarray:
    """Columns z orthogonal to `base` that make the projected (V - shift) z nearest to the column of `right`, over Krylov spaces.

    One step is one product for all columns. Each column has its own Lanczos vectors and its small least-squares problem.
    """

    def project(block: np.ndarray) -> np.ndarray:
        for _ in range(2):
            block = block - base @ (base.T @ block)
        return block

    right = project(right)
    lengths = np.linalg.norm(right, axis=0)
    width = right.shape[1]
    lanczos = [np.divide(right, lengths, out=np.zeros_like(right), where=lengths > 0)]
    tri = np.zeros((width, steps + 1, steps))
    done = 0
    for step in range(steps):
        image = project(product(lanczos[step]) - shifts * lanczos[step])
        for before in range(step + 1):  # few steps, so all of them are made orthogonal, for rounding
            along = np.einsum("ij,ij->j", lanczos[before], image)
            tri[:, before, step] = along
            image = image - lanczos[before] * along
        size = np.linalg.norm(image, axis=0)
        tri[:, step + 1, step] = size
        done = step + 1
        live = size > 1e-13 * np.abs(tri).max(axis=(1, 2))
        lanczos.append(np.where(live, np.divide(image, size, out=np.zeros_like(image), where=size > 0), 0.0))
        if not live.any():
            break
    out = np.zeros_like(right)
    for column in range(width):
        goal = np.zeros(done + 1)
        goal[0] = lengths[column]
        weights = np.linalg.lstsq(tri[column, : done + 1, :done], goal, rcond=None)[0]
        out[:, column] = sum(weight * basis[:, column] for weight, basis in zip(weights, lanczos, strict=False))
    return out


def leading_pairs(product: Product, size: int, count: int, inner: int = INNER, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The `count` largest eigenvalues of a positive semidefinite matrix, falling, and unit eigenvectors as columns.

    `product` multiplies the matrix with a block of columns. A matrix whose residuals don't come down to rounding is an error.
    """
    count = min(count, size)
    widest = min(size, max(WIDEST * count, count + 8))
    space = _orthonormal(np.random.default_rng(seed).normal(size=(size, min(size, count + 4))), np.zeros((size, 0)))
    image = product(space)
    for _ in range(MOST_ROUNDS):
        values, turn = np.linalg.eigh((space.T @ image + image.T @ space) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, ritz_image = space @ turn, image @ turn
        top, top_image, found = ritz[:, :count], ritz_image[:, :count], values[:count]
        residual = top_image - top * found
        error = np.linalg.norm(residual, axis=0)
        open_pairs = error > ROUNDINGS * np.finfo(float).eps * max(abs(values[0]), 1e-300)
        if space.shape[1] >= count and not open_pairs.any():
            return found, top
        if space.shape[1] + np.count_nonzero(open_pairs) > widest and space.shape[1] < size and widest < size:
            # Begin again from the best Ritz vectors; locked ones are among them.
            keep = min(space.shape[1], count + (widest - count) // 3)
            space, image = ritz[:, :keep], ritz_image[:, :keep]
        wanted = np.flatnonzero(open_pairs)
        correction = minres(product, found[wanted], top, -residual[:, wanted], inner)
        new = _orthonormal(correction, space)
        if not new.shape[1]:
            new = _orthonormal(residual[:, wanted], space, least=1e-14)
        if not new.shape[1]:
            if space.shape[1] == size or error.max() <= 1e4 * np.finfo(float).eps * abs(values[0]):
                # Nothing is left to add: what remains is the products' own rounding. Once more with fresh images.
                fresh = product(ritz)
                values, turn = np.linalg.eigh((ritz.T @ fresh + fresh.T @ ritz) / 2)
                return values[::-1][:count], (ritz @ turn[:, ::-1])[:, :count]
            new = _orthonormal(np.random.default_rng(seed + 1).normal(size=(size, 1)), space)
        space, image = np.column_stack([space, new]), np.column_stack([image, product(new)])
    raise ArithmeticError(f"residuals of {error.max()} after {MOST_ROUNDS} rounds")


@dataclass(frozen=True)
class Centre:
    """Number and sums of the distinct vectors; whole numbers of any size."""

    count: int
    sums: list[int]

    def times(self, whole: np.ndarray) -> np.ndarray:
        """count * x - sums, exactly; as doubles or longs where they fit, as Python's numbers else."""
        # The same with both moved by the whole mean, so that the numbers stay small.
        mean = np.array([one // self.count for one in self.sums], dtype=np.int64)
        rest = [one - self.count * int(shift) for one, shift in zip(self.sums, mean, strict=True)]
        moved = whole - mean
        largest = int(np.abs(moved).max(initial=0)) * self.count + max(map(abs, rest), default=0)
        kind = np.int64 if largest < LONG else object
        return self.count * moved.astype(kind) - np.array(rest, dtype=kind)

    def centred(self, whole: np.ndarray) -> np.ndarray:
        """x minus the mean, rounded once."""
        return (self.times(whole) / self.count).astype(np.float64)

    def deviations(self, whole: np.ndarray) -> list[int | None]:
        """Sum over the components of (count * x - sums)**2, exactly; None where it doesn't fit a long."""
        times = self.times(whole)
        if len(times) and int(np.abs(times).max()) ** 2 * times.shape[1] >= LONG:
            found = (times.astype(object) ** 2).sum(axis=1)
            return [one if one < LONG else None for one in found]
        return (times.astype(np.int64) ** 2).sum(axis=1).tolist()


def _blocks(rows: DataFrame, size: int, rows_in_block: int = 1 << 14) -> DataFrame:
    """Vectors, which are numbers x of the contract, as blocks of bytes that a task reads without parting them."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in joined(batches, rows_in_block):
            whole = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype("<i8").reshape(-1, size)
            yield pa.record_batch([pa.array([whole.tobytes()], pa.binary())], names=["block"])

    return rows.mapInArrow(packed, "block binary")


def _added(blocks: DataFrame, size: int, measure: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """What `measure` gives for each block, a matrix of the same shape for all, added up."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for block in batch.column(0):
                found = measure(np.frombuffer(block.as_buffer(), dtype="<i8").reshape(-1, size))
                total = found if total is None else total + found
        if total is not None:
            yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["row", "sums"])

    found = blocks.mapInArrow(parts, "row int, sums array<double>")
    sums = found.select("row", F.posexplode("sums").alias("column", "value")).groupBy("row", "column").agg(F.sum("value").alias("value"))
    rows = sums.collect()  # as many as the block of columns has numbers
    out = np.zeros((max(row["row"] for row in rows) + 1, max(row["column"] for row in rows) + 1))
    for row in rows:
        out[row["row"], row["column"]] = row["value"]
    return out


def whiten(
    table: DataFrame, components: int = COMPONENTS, inner: int = INNER, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors count as x = floor(64 c) + 1000000. Everything is fitted on the distinct x: n of them, with sums S.
    A component's eigenvalue e is of the covariance of these (divisor n); whitened is (x - S/n) on the unit eigenvector, over the root of e.
    deviation, the sum of (n x - S)**2, is exact and null where it doesn't fit a long. explained is e over the trace;
    identity_error is the largest entry, in size, of the covariance of whitened less the identity.
    Components whose e is zero but for rounding don't exist, so that equal or few vectors have fewer, a single one none.

    Rows whose vector is null, empty, or has a null or non-finite component are left out; all others must be of one size, with
    components below 2**34 in size, or the job fails. Repeated rows are returned each, null ids stay null, other
    columns are ignored, and no rows give none.
    """
    spark = table.sparkSession
    ship_code(spark)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    any_row = rows.filter(is_finite("vector")).select(F.size("vector").alias("size")).first()
    if any_row is None:
        return spark.createDataFrame([], schema)
    size = any_row["size"]

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = scaled_floor(finite_rows(batch.column(0), size)[1], SCALE, LIMIT) + SHIFT
            ends = pa.array(np.arange(0, whole.size + 1, size, dtype=np.int32))
            yield pa.record_batch([pa.ListArray.from_arrays(ends, pa.array(whole.ravel()))], names=["x"])

    distinct = rows.select("vector").mapInArrow(numbers, "x array<long>").distinct()
    blocks = stage(_blocks(distinct, size), "whitening-vectors")

    def sums(whole: np.ndarray) -> np.ndarray:
        # In two halves, so that doubles hold them exactly.
        total = whole.sum(axis=0)
        return np.array([[len(whole), 0], *([one >> 26, one & (1 << 26) - 1] for one in total.tolist())], dtype=np.float64)

    halves = _added(blocks, size, sums)
    centre = Centre(int(halves[0, 0]), [(int(high) << 26) + int(low) for high, low in halves[1:]])

    def product(columns: np.ndarray) -> np.ndarray:
        def measure(whole: np.ndarray) -> np.ndarray:
            centred = centre.centred(whole)
            return centred.T @ (centred @ columns)

        return _added(blocks, size, measure) / centre.count

    values, vectors = leading_pairs(product, size, components, inner)
    kept = values > size * np.finfo(float).eps * max(values[0], 0)
    values, vectors = values[kept], vectors[:, kept]
    if not len(values):
        return spark.createDataFrame([], schema)
    onto = vectors / np.sqrt(values)

    def second_moments(whole: np.ndarray) -> np.ndarray:
        centred = centre.centred(whole)
        whitened = centred @ onto
        squares = np.zeros((1, len(values)))
        squares[0, 0] = np.einsum("ij,ij->", centred, centred)
        return np.concatenate([whitened.T @ whitened, squares])

    moments = _added(blocks, size, second_moments) / centre.count
    identity_error = float(np.abs(moments[:-1] - np.eye(len(values))).max())
    explained = values / moments[-1, 0]

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = len(values)
        for batch in batches:
            kept, matrix = finite_rows(batch.column("vector"), size)
            whole = scaled_floor(matrix, SCALE, LIMIT) + SHIFT
            whitened, each = centre.centred(whole) @ onto, np.repeat(np.arange(len(kept)), many)
            yield pa.record_batch(
                [
                    batch.column("vec_id").take(pa.array(kept[each])),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(kept))),
                    pa.array(np.full(len(each), centre.count, dtype=np.int64)),
                    pa.array(centre.deviations(whole), pa.int64()).take(pa.array(each)),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, len(kept))),
                    pa.array(np.full(len(each), identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(projected, schema)
