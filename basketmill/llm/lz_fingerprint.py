"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed as LZ78 does: each phrase is the shortest one that is not in the dictionary yet, and joins it. Texts that
share passages share phrases, as they would share matches under compression. The set of phrases is hashed and reduced to a
minimum-hash signature of `BINS` numbers: a phrase's hash names its bin, and each bin keeps its least value.
The likeness of two signatures, the share of equal bins among those that either one fills, estimates
how far the sets of phrases overlap.

Each document is also compared with its edited text, whose second half is the beginning of the next document in
descending order of the id. Documents are dealt out by ranges of the id, and each range also gets the
first document of the next one, so a text is shuffled once and neighbours meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmill.llm.common import ship_code, texts

BINS = 128
#: Ranges of ids for each shuffle partition; several, so that they spread evenly.
RANGES = 8
#: An odd number, so that its powers modulo 2**64 have inverses.
BASE = 0x9E3779B97F4A7C15
NONE = 0xFFFF
#: Of a bin that no phrase falls in, before it is folded.
NOTHING = 2**64 - 1
LEAST_ID = -(2**63)


class _Powers:
    """Powers of `BASE` and of its inverse modulo 2**64, as many as a text has needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            count = max(size, 2 * len(self.up), 1 << 15)
            self.up = np.cumprod(np.r_[1, np.full(count - 1, BASE, dtype=np.uint64)].astype(np.uint64))
            inverse = np.uint64(pow(BASE, -1, 2**64))
            self.down = np.cumprod(np.r_[1, np.full(count - 1, inverse, dtype=np.uint64)].astype(np.uint64))
        return self.up[:size], self.down[:size]


_powers = _Powers()


def parse(text: str, known: set[str]) -> tuple[list[str], int]:
    """The new phrases of a text in order, which join the dictionary, and the length of the known phrase that may be left over."""
    phrases = []
    add, keep = known.add, phrases.append
    phrase = ""
    for character in text:
        phrase += character
        if phrase not in known:
            add(phrase)
            keep(phrase)
            phrase = ""
    return phrases, len(phrase)


def phrase_hashes(phrases: list[str]) -> np.ndarray:
    """64-bit hashes that depend on a phrase's characters only: polynomial sums of all at once, then mixed."""
    sizes = np.fromiter(map(len, phrases), dtype=np.int64, count=len(phrases))
    code = np.frombuffer("".join(phrases).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    up, down = _powers.to(len(code) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((code + np.uint64(1)) * up[: len(code)])])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    value = (sums[ends] - sums[starts]) * down[starts]
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        value = (value ^ value >> np.uint64(shift)) * np.uint64(factor)
    return value ^ value >> np.uint64(33)


def minima(phrases: list[str]) -> np.ndarray:
    """Least hash of each bin; `NOTHING` where no phrase falls."""
    least = np.full(BINS, NOTHING, dtype=np.uint64)
    if phrases:
        hashes = phrase_hashes(phrases)
        bins = (hashes >> np.uint64(57)).astype(np.int64)
        np.minimum.at(least, bins, hashes & np.uint64(2**57 - 1))
    return least


def folded(least: np.ndarray) -> np.ndarray:
    """16 bits mixed from each minimum, which are spread evenly however small the minima of long texts are."""
    mixed = (least ^ least >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ mixed >> np.uint64(32)) % np.uint64(NONE)
    return np.where(least == NOTHING, NONE, mixed).astype(np.uint16)


def signature(phrases: list[str]) -> np.ndarray:
    """16 bits of each bin; `NONE` where no phrase falls."""
    return folded(minima(phrases))


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Share of equal bins among those that either fills; 1 for two empty texts."""
    filled = (one != NONE) | (other != NONE)
    return float((one == other)[filled].mean()) if filled.any() else 1.0


def written(signature: np.ndarray) -> str:
    """A signature as text, four hex digits a bin."""
    return signature.astype(">u2").tobytes().hex()


class Parsed:
    """A text's signature, and what is needed to parse another text that begins like it.

    `known` is the dictionary at `border`, the last end of a phrase within the first `kept` characters.
    """

    def __init__(self, text: str):
        self.text, self.kept = text, len(text) - len(text) // 2
        self.known: set[str] = set()
        phrases, left = parse(text[: self.kept], self.known)
        self.border = self.kept - left
        self.first = minima(phrases)
        self.all = folded(np.minimum(self.first, minima(parse(text[self.border :], self.known.copy())[0])))

    def edited(self, following: str) -> tuple[str, np.ndarray]:
        """The text with its second half replaced by the beginning of another one, and its signature; uses up the dictionary."""
        text = self.text[: self.kept] + following[: len(self.text) // 2]
        return text, folded(np.minimum(self.first, minima(parse(text[self.border :], self.known)[0])))


def fingerprint(docs: DataFrame, text: str) -> Column:
    """Column of the fingerprint of a text column, four hex digits a bin; a null is the empty text, which fills no bin."""
    ship_code(docs.sparkSession)

    @F.pandas_udf("string")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([written(signature(parse(text, set())[0])) for text in texts(batch)], dtype=object)

    return hashed(docs[text])


OUTPUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (bucket, again, key, doc_id, text) in order; each row of a bucket is compared with the one after it."""
    bucket, before, identity = None, None, None
    for batch in batches:
        rows = []
        columns = (batch["bucket"], batch["again"], batch["doc_id"], texts(batch["text"]))
        for now, again, doc_id, text in zip(*columns, strict=True):
            if now != bucket:
                bucket, before = now, None
            elif before is None:
                continue  # further rows of the next range's first id
            parsed = Parsed(text)
            if before is not None:
                edited, of_edited = before.edited(text)
                rows.append(
                    (
                        identity,
                        len(before.text),
                        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                        written(before.all),
                        written(of_edited),
                        likeness(before.all, of_edited),
                        likeness(before.all, parsed.all),
                    )
                )
            before, identity = (None, None) if again else (parsed, doc_id)
        names = [field.split()[0] for field in OUTPUT.split(", ")]
        if rows:
            yield pd.DataFrame(rows, columns=names, dtype=object).astype(
                {"doc_id": "Int64", "n_chars": "int64", "near_edited": "float64", "near_next": "float64"}
            )


def compare_with_edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document has the next smaller id; after the last one comes the first. Every input row gives one
    row, other input columns are ignored. Rows with the same id follow each other in the order of a hash of the text; null ids come last.
    A null text is empty. A single row is its own next one. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    ship_code(spark)
    key = F.coalesce("doc_id", F.lit(LEAST_ID))
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ids = docs.select(key.alias("key"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = RANGES * partitions
    bounds = np.unique(ids.approxQuantile("key", [k / ranges for k in range(1, ranges)], 0.25 / ranges))

    falling = -bounds[::-1]  # range 0 has the largest ids

    @F.pandas_udf("long")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(falling, -keys.to_numpy(np.float64), side="left"))

    # The first id of every range, at most as many as there are ranges: the range before needs it too.
    firsts = ids.groupBy(range_of("key").alias("bucket")).agg(F.max("key").alias("key")).orderBy("bucket").collect()
    order = [row["bucket"] for row in firsts]
    needs = np.array([(row["key"], order[at - 1]) for at, row in enumerate(firsts)], dtype=np.int64).reshape(-1, 2)
    needs = needs[np.argsort(needs[:, 0])]

    @F.pandas_udf("long")
    def needed_by(keys: pd.Series) -> pd.Series:
        values = keys.to_numpy(np.int64)
        at = np.minimum(np.searchsorted(needs[:, 0], values), max(0, len(needs) - 1))
        return pd.Series(np.where(needs[at, 0] == values, needs[at, 1], -1) if len(needs) else np.full(len(values), -1))

    placed = docs.withColumn("key", key).withColumn("own", range_of("key")).withColumn("other", needed_by("key"))
    places = F.array(
        F.struct(F.col("own").alias("bucket"), F.lit(False).alias("again")),
        F.struct(F.col("other").alias("bucket"), F.lit(True).alias("again")),
    )
    dealt = placed.select("doc_id", "key", "text", F.explode(F.filter(places, lambda one: one["bucket"] >= 0)).alias("place"))
    dealt = dealt.select("place.*", "key", F.xxhash64("text").alias("tie"), "doc_id", "text")
    dealt = dealt.repartition(partitions, "bucket").sortWithinPartitions("bucket", "again", F.desc("key"), "tie")
    return dealt.select("bucket", "again", "doc_id", "text").mapInPandas(_compared, OUTPUT)
