"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Hashable, Iterable
from functools import cache
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

PACKAGE = Path(__file__).resolve().parent.parent


def read_table(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """The named columns of one of the tables in a folder."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


@cache
def _ship(application: str) -> str:
    folder = tempfile.mkdtemp(prefix="basketmill-code-")
    return shutil.make_archive(f"{folder}/{PACKAGE.name}", "zip", PACKAGE.parent, PACKAGE.name)


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver found it.

    The driver's archive of its own source files goes out by Spark's file server; no data is in it.
    """
    context = spark.sparkContext
    archive = _ship(context.applicationId)
    if archive not in context._python_includes and Path(archive).name not in context._python_includes:
        context.addPyFile(archive)


_made: dict[Hashable, Any] = {}


def once_per_worker(key: Hashable, make: Callable[[], Any]) -> Any:
    """What `make` returns, kept in this Python process until another key of the same kind is asked for.

    A key is a tuple (kind, identity).
    """
    kind, identity = key
    if kind not in _made or _made[kind][0] != identity:
        _made[kind] = (identity, make())
    return _made[kind][1]


def texts(values: Iterable) -> list[str]:
    """The strings of a column; a null is the empty text."""
    return [value if isinstance(value, str) else "" for value in values]


def doc_crc(doc_id: str = "doc_id") -> Column:
    """crc32 of an id written as text, which folds are cut by."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def draw(rows: DataFrame, most: int, *key: str) -> list[Row]:
    """The rows that come first by a hash of their key, `most` of them, or all if there are fewer.

    Their number tells below which hash they lie, about, so that tasks hand on few more than are drawn, however many rows there are.
    """
    hashed = F.xxhash64(*key)
    share = (2 * most + 200) / max(1, rows.count())  # some more than are needed, by far beyond chance
    if share < 0.9:
        found = rows.filter(hashed <= int(-(2**63) + share * 2**64)).orderBy(hashed, *key).limit(most).collect()
        if len(found) == most:
            return found
    # Few rows, or very many equal ones.
    return rows.orderBy(hashed, *key).limit(most).collect()


class Recent(dict):
    """Results of a function of short strings, the more recent ones kept: at most twice `size` of them."""

    def __init__(self, make: Callable[[Any], Any], size: int, longest: int = 64):
        super().__init__()
        self.make, self.size, self.longest = make, size, longest
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value
