"""Vector codes and whitening against SQL, brute force and exact arithmetic, and on odd rows."""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from conftest import SMALL

from basketmill.llm import queries, vector_codes, vectors, whitening

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, code string, n double"
#: Null ids, vectors and components, non-finite ones, empty vectors, repeated rows and ids, null labels, columns with clashing names.
ODD = [
    (5, [0.5, -0.25, 0.0, 1.0], 1, "x", 0.0),
    (5, [0.5, -0.25, 0.0, 1.0], 1, "x", 0.0),
    (3, [0.0, 0.0, 0.0, 0.0], None, "x", 0.0),
    (None, [-1.0, 0.1, 0.2, 0.3], None, "x", 0.0),
    (2, None, 1, "x", 0.0),
    (4, [1.0, None, 0.0, 0.0], 1, "x", 0.0),
    (6, [1.0, NAN, 0.0, 0.0], 1, "x", 0.0),
    (7, [1.0, 0.0, -INF, 0.0], 1, "x", 0.0),
    (8, [], 2, "x", 0.0),
    (9, [0.7, 0.7, -0.7, 0.7], 2, None, None),
]
KEPT = [(row[0], row[1], row[2]) for row in ODD if row[0] not in (2, 4, 6, 7, 8)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def codes_by_hand(rows, parts, entries, rounds):
    """Every part against every entry, in Python's whole numbers."""
    rows = sorted(rows, key=lambda row: (row[0] is None, row[0] or 0, row[1]))
    whole = [[math.floor(4096 * x) for x in vector] for _, vector, _ in rows]
    width = len(whole[0]) // parts
    cut = [[tuple(one[p * width : (p + 1) * width]) for one in whole] for p in range(parts)]
    books = [[column[at] for at in range(min(entries, len(whole)))] for column in cut]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), at) for at, entry in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            found = [nearest(part, book)[1] for part in cut[p]]
            for at in range(len(book)):
                own = [part for part, one in zip(cut[p], found, strict=True) if one == at]
                if own:
                    book[at] = tuple(sum(column) // len(own) for column in zip(*own, strict=True))
    best = [[nearest(column[at], book) for column, book in zip(cut, books, strict=True)] for at in range(len(whole))]
    errors = [sum(distance for distance, _ in one) for one in best]
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    return [
        (
            row[0],
            "".join(f"{entry:02x}" for _, entry in one),
            error,
            sum(other for other, any_row in zip(errors, rows, strict=True) if any_row[2] == row[2]),
            hashlib.sha256(text.encode()).hexdigest(),
        )
        for row, one, error in zip(rows, best, errors, strict=True)
    ]


def in_order(rows):
    return sorted(map(str, (tuple(row) for row in rows)))


def test_codes_equal_sql_and_brute_force(spark):
    found = in_order(queries.op11_vector_codes(spark, SMALL).collect())
    table = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{SMALL}/embeddings.parquet'").fetchall()
    assert found == in_order(codes_by_hand(table, 8, 16, 6))
    with duckdb.connect() as database:
        database.sql(f"CREATE VIEW embeddings AS FROM '{SMALL}/embeddings.parquet'")
        assert found == in_order(database.sql(queries.ORACLE_SQL["op11_vector_codes"]).fetchall())


@pytest.mark.parametrize(("parts", "entries"), [(2, 16), (2, 2), (1, 3), (4, 16)])
def test_codes_of_odd_rows(spark, odd, parts, entries):
    found = vector_codes.compress(odd, parts=parts, entries=entries)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert in_order(found.collect()) == in_order(codes_by_hand(KEPT, parts, entries, 6))
    for nothing in (odd.limit(0), odd.filter("vec_id IN (2, 4, 6, 7, 8)")):
        empty = vector_codes.compress(nothing, parts=parts, entries=entries)
        assert empty.count() == 0 and empty.dtypes == found.dtypes


def test_codes_refuse_what_has_none(spark):
    two = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0, 4.0])], "vec_id long, embedding array<double>")
    labelled = two.selectExpr("*", "1 AS label")
    with pytest.raises(ValueError, match="components"):
        vector_codes.compress(labelled, parts=2)
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compress(labelled.filter("vec_id = 2"), parts=3)
    with pytest.raises(ValueError, match="in size"):
        vector_codes.compress(spark.createDataFrame([(1, [1e9, 2.0], 1)], "vec_id long, embedding array<double>, label int"), parts=2)


def test_hot_labels_and_many_labels(spark):
    rng = np.random.default_rng(3)
    rows = [(at, rng.normal(size=4).tolist(), at if at % 3 else -1) for at in range(1500)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = vector_codes.compress(table, parts=2, rounds=1)
    assert in_order(found.collect()) == in_order(codes_by_hand(rows, 2, 16, 1))


@pytest.mark.parametrize("spread", [2, 1000, 2**26])
def test_orchard_search_is_exact(spread):
    """Ties too: few different points, equal entries; and components beyond what doubles hold."""
    rng = np.random.default_rng(spread)
    points = rng.integers(-spread, spread + 1, (4000, 3))
    book = np.concatenate([points[:30], points[:5]])
    found, distance = vector_codes.Orchard(book).nearest(points)
    apart = ((points[:, None] - book) ** 2).sum(axis=2)
    assert (found == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def test_finite_rows_match_the_filter(spark, odd):
    batches = odd.select("embedding").toArrow().combine_chunks().column(0)
    kept, matrix = vectors.finite_rows(batches.combine_chunks() if hasattr(batches, "combine_chunks") else batches, 4)
    assert len(kept) == odd.filter(vectors.is_finite("embedding")).count() == len(KEPT)
    assert np.allclose(matrix, [row[1] for row in KEPT])


def whitened_by_hand(rows, components):
    """Exact sums in fractions, then the eigenvectors of the whole covariance."""
    whole = [[math.floor(64 * x) + 1_000_000 for x in vector] for _, vector, _ in rows]
    fit = sorted(set(map(tuple, whole)))
    n, sums = len(fit), [sum(column) for column in zip(*fit, strict=True)]
    centred = np.array([[float(Fraction(n * x - s, n)) for x, s in zip(one, sums, strict=True)] for one in fit])
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1], turn[:, ::-1]
    own = np.array([[float(Fraction(n * x - s, n)) for x, s in zip(one, sums, strict=True)] for one in whole])
    kept = [at for at in range(min(components, len(values))) if values[at] > 1e-9 * values[0]]
    deviations = [sum((n * x - s) ** 2 for x, s in zip(one, sums, strict=True)) for one in whole]
    return n, deviations, own @ turn[:, kept] / np.sqrt(values[kept]), values[kept] / values.sum()


def check_whitened(found, rows, components=16, near=1e-9):
    """`rows` with ids that are different."""
    n, deviations, expected, explained = whitened_by_hand(rows, components)
    many = expected.shape[1]
    assert len(found) == many * len(rows)
    number = {row[0]: at for at, row in enumerate(rows)}
    got = np.full(expected.shape, np.nan)
    for row in found:
        at = number[row["vec_id"]]
        got[at, row["component"] - 1] = row["whitened"]
        assert row["n"] == n and row["deviation"] == deviations[at]
        assert abs(row["explained"] / explained[row["component"] - 1] - 1) < 1e-9 and row["identity_error"] < 1e-9
    signs = np.sign((got * expected).sum(axis=0))
    assert np.abs(got * signs - expected).max() < near


def test_whitening_equals_exact_arithmetic(spark):
    table = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{SMALL}/embeddings.parquet'").fetchall()
    check_whitened(queries.op13_whitening(spark, SMALL).collect(), table)


def test_whitening_counts_equal_vectors_once(spark):
    rng = np.random.default_rng(0)
    rows = [(at, rng.normal(size=6).round(1).tolist(), 0) for at in range(60)]
    rows += [(100 + at, rows[0][1], 0) for at in range(40)]
    rows += [(200, [x + 0.001 for x in rows[1][1]], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    check_whitened(whitening.whiten(table).collect(), rows)
    check_whitened(whitening.whiten(table, components=2, inner=1).collect(), rows, components=2)


def test_whitening_of_odd_rows(spark, odd):
    rows = list({row[0]: row for row in KEPT}.values())
    found = whitening.whiten(odd)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    collected = found.collect()
    assert sum(row["vec_id"] == 5 for row in collected) == 2 * sum(row["vec_id"] == 3 for row in collected)
    once = {(row["vec_id"], row["component"]): row for row in collected}
    check_whitened(list(once.values()), rows)
    # One vector, however often, has no spread and so no component.
    for nothing in (odd.limit(0), odd.filter("vec_id IN (2, 4, 6, 7, 8)"), odd.filter("vec_id = 5")):
        empty = whitening.whiten(nothing)
        assert empty.count() == 0 and empty.dtypes == found.dtypes


@pytest.mark.parametrize(("size", "rank"), [(40, 40), (120, 120), (60, 7), (3, 3)])
def test_pairs_by_few_products(size, rank):
    """Against the whole eigenvalue problem; the matrix is only ever multiplied with blocks of columns."""
    rng = np.random.default_rng(size)
    centred = rng.normal(size=(4 * size, rank)) * np.linspace(3, 0.5, rank) @ np.linalg.qr(rng.normal(size=(size, rank)))[0].T
    matrix = centred.T @ centred
    widths = []

    def product(columns):
        widths.append(columns.shape[1])
        return matrix @ columns

    values, turn = whitening.leading_pairs(product, size, 8)
    expected = np.linalg.eigvalsh(matrix)[::-1][: min(8, size)]
    assert np.abs(values - expected).max() < 1e-13 * expected[0]
    assert np.linalg.norm(matrix @ turn - turn * values, axis=0).max() < 1e-13 * expected[0]
    assert np.abs(turn.T @ turn - np.eye(turn.shape[1])).max() < 1e-13
    assert max(widths) <= 12


def test_minres_solves_the_projected_equation():
    rng = np.random.default_rng(1)
    matrix = rng.normal(size=(12, 12))
    matrix = matrix @ matrix.T
    base = np.linalg.qr(rng.normal(size=(12, 3)))[0]
    right, shifts = rng.normal(size=(12, 2)), np.array([0.3, 40.0])
    found = whitening.minres(lambda block: matrix @ block, shifts, base, right, 9)
    free = np.eye(12) - base @ base.T
    for at in range(2):
        left = free @ (matrix @ found[:, at] - shifts[at] * found[:, at])
        assert np.abs(left - free @ right[:, at]).max() < 1e-8 and np.abs(base.T @ found[:, at]).max() < 1e-12


def test_deviation_is_exact_or_null():
    centre = whitening.Centre(10**7, [10**13 + 3, -(10**12)])
    whole = np.array([[1_000_000, -100_000], [1_000_017, -99_000]])
    expected = [sum((10**7 * x - s) ** 2 for x, s in zip(row, centre.sums, strict=True)) for row in whole.tolist()]
    assert centre.deviations(whole) == [one if one < 2**63 else None for one in expected] and None in centre.deviations(whole)
    assert np.allclose(centre.centred(whole), [[-3e-7, 0], [17 - 3e-7, 1000]], rtol=1e-15, atol=1e-22)
