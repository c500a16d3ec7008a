"""Near-duplicate groups by SimHash fingerprints, searched with anchor points of a covering code.

Fingerprints within `max_distance` bits differ by at most one bit in at least one of
`max_distance // 2 + 1` blocks of the 64 bits. In each block the anchors are the words of a perfect
Hamming code of radius 1 over most of the bits, times all values of the bits left over. A block's home is its
nearest anchor. A fingerprint goes to the anchors within the covering radius plus the threshold
of 1 that a fingerprint one bit away can have as home: 17 of 2**27 in a block of 32 bits. So of two linked
fingerprints one comes to the other's home in some block, and they are compared there on all 64 bits.

Equal fingerprints are one before the search. At an anchor only a spanning forest of the links
found is given out, never all pairs, so a large group of near copies gives as many rows as it has fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmill.llm.common import ship_code, texts
from basketmill.llm.components import connected_components
from basketmill.operators.staging import stage

BITS = 64
SEED = 42
#: Fingerprints at one anchor from which they are dealt out again by sub-anchors before they are compared.
CROWDED = 2048


def shingle_hashes(text: str, words: int) -> list[int]:
    """XXH64 of each shingle of words, A-Z lower-cased; a shorter text is one shingle, one without words has none."""
    found = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not found:
        return []
    if len(found) < words:
        return [xxhash.xxh64_intdigest(b" ".join(found), SEED)]
    rows = zip(*(found[first:] for first in range(words)), strict=False)
    return list(map(xxhash.xxh64_intdigest, map(b" ".join, rows), repeat(SEED)))


def fingerprint(text: str, words: int) -> int:
    """64 bits, each 1 if it is set in over half of the shingles' hashes."""
    hashes = shingle_hashes(text, words)
    if not hashes:
        return 0
    array = np.array(hashes, dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for first in range(0, len(array), 1 << 14):
        part = array[first : first + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(array), bitorder="little").view("<u8")[0])


def simhash(docs: DataFrame, text: str, shingle_words: int) -> Column:
    """Column of the fingerprint of a text column, as a long of the same bits. A null text is the empty one."""
    ship_code(docs.sparkSession)

    @F.pandas_udf("long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            values = [fingerprint(text, shingle_words) for text in texts(batch)]
            yield pd.Series(np.array(values, dtype=np.uint64).view(np.int64))

    return hashed(docs[text])


class Block:
    """Anchors of some bits of a fingerprint: a Hamming code over the lower bits, all values of the others."""

    def __init__(self, low: int, width: int):
        self.low, self.width = low, width
        checks = (width + 1).bit_length() - 1
        self.coded = (1 << checks) - 1
        labels = range(1, self.coded + 1)
        self.masks = [sum(1 << label - 1 for label in labels if label >> check & 1) for check in range(checks)]
        self.flips = np.array([0, *(1 << label - 1 for label in labels)], dtype=np.uint64)

    def cut(self, fingerprints: np.ndarray) -> np.ndarray:
        return fingerprints >> np.uint64(self.low) & np.uint64((1 << self.width) - 1)

    def anchors(self, fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, anchor, whether it is the home) for every fingerprint and every anchor it goes to."""
        values = self.cut(fingerprints)
        syndrome = np.zeros(len(values), dtype=np.int64)
        for check, mask in enumerate(self.masks):
            syndrome |= (np.bitwise_count(values & np.uint64(mask)).astype(np.int64) & 1) << check
        rows = np.arange(len(values))
        home = values ^ self.flips[syndrome]
        found = [(rows, home, True)]
        for label in range(1, self.coded + 1):
            # Flipping this bit gives a value whose home is one flip (of `other`) away; either order gives the same one.
            other = syndrome ^ label
            new = rows[(syndrome != 0) & (label < other)]
            found.append((new, values[new] ^ self.flips[label] ^ self.flips[other[new]], False))
        for bit in range(self.coded, self.width):
            found.append((rows, home ^ np.uint64(1 << bit), False))
        return (
            np.concatenate([row for row, _, _ in found]),
            np.concatenate([anchor for _, anchor, _ in found]),
            np.concatenate([np.full(len(row), is_home) for row, _, is_home in found]),
        )


def blocks(max_distance: int, bits: int = BITS, low: int = 0) -> list[Block]:
    """So many blocks that two words within the distance differ by at most one bit in one of them."""
    count = max_distance // 2 + 1
    cuts = [low + bits * k // count for k in range(count + 1)]
    return [Block(start, end - start) for start, end in zip(cuts, cuts[1:], strict=False)]


def forest(points: np.ndarray, at_home: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """Links that span what is linked between the points at home and all points."""
    parent = list(range(len(points)))

    def root(node: int) -> int:
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    links = []
    for home in np.flatnonzero(at_home):
        near = np.flatnonzero(np.bitwise_count(points ^ points[home]) <= max_distance)
        for other in near:
            if (one := root(int(home))) != (two := root(int(other))):
                parent[two] = one
                links.append((int(points[home]), int(points[other])))
    return links


def crowd_forest(points: np.ndarray, at_home: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """The same for many points: they are dealt out by the anchors of all blocks of their 64 bits, half as wide."""
    links = []
    finer = blocks(2 * max_distance + 1)
    for block in finer:
        row, anchor, _ = block.anchors(points)
        order = np.argsort(anchor, kind="stable")
        row, anchor = row[order], anchor[order]
        cuts = np.flatnonzero(np.diff(anchor)) + 1
        for group in np.split(row, cuts):
            if len(group) > 1 and at_home[group].any():
                links += forest(points[group], at_home[group], max_distance)
    return links


def links_at_anchors(fingerprints: DataFrame, max_distance: int) -> DataFrame:
    """(a, b): links between distinct fingerprints (a column of longs) that connect all that are linked."""
    ship_code(fingerprints.sparkSession)
    (column,) = fingerprints.columns
    parts = blocks(max_distance)

    def replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch[column].to_numpy(np.int64).view(np.uint64)
            for number, block in enumerate(parts):
                row, anchor, home = block.anchors(values)
                yield pd.DataFrame(
                    {"block": number, "anchor": anchor.view(np.int64), "fp": values[row].view(np.int64), "home": home}
                )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = (batch["block"] == batch["block"].iat[-1]) & (batch["anchor"] == batch["anchor"].iat[-1])
            cut = int(np.argmax(last.to_numpy()))
            rest = batch.iloc[cut:]
            yield linked(batch.iloc[:cut])
        if rest is not None:
            yield linked(rest)

    def linked(rows: pd.DataFrame) -> pd.DataFrame:
        key = rows["anchor"].to_numpy(np.int64)
        number = rows["block"].to_numpy()
        points = rows["fp"].to_numpy(np.int64).view(np.uint64)
        home = rows["home"].to_numpy(bool)
        new = np.flatnonzero((np.diff(key) != 0) | (np.diff(number) != 0)) + 1
        starts, ends = np.append(0, new), np.append(new, len(rows))
        found: list[tuple[int, int]] = []
        for start, end in zip(starts, ends, strict=True):
            if end - start > 1 and home[start:end].any():
                search = forest if end - start < CROWDED else crowd_forest
                found += search(points[start:end], home[start:end], max_distance)
        links = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": links.min(axis=1, initial=2**63 - 1), "b": links.max(axis=1, initial=-(2**63))})

    replicas = fingerprints.mapInPandas(replicate, "block int, anchor long, fp long, home boolean")
    by_anchor = replicas.repartition("block", "anchor").sortWithinPartitions("block", "anchor")
    return by_anchor.mapInPandas(compare, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, shingle_words: int = 3, max_distance: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id that links reach).

    Every input row gives one row, repeated ids included; other input columns are ignored. Null and empty texts,
    and those of white space only, have fingerprint zero and are linked by it like any others. A null id
    stays null and is never a component's id, unless no row of the component has one. An empty table gives an empty one.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    hashed = stage(docs.select("doc_id", simhash(docs, "text", shingle_words).alias("fp")), "fingerprints")
    distinct = stage(hashed.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct-fingerprints")
    roots = connected_components(links_at_anchors(distinct.select("fp"), max_distance))
    members = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_doc", F.coalesce("root", "fp").alias("root")
    )
    first = members.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    named = members.join(first, "root").select("fp", "component_id")
    return hashed.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
