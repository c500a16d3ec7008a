"""Packing token sequences by shortest-pack-first over the histogram of lengths.

1. Each document is cut into pieces of the capacity, the last one shorter, in one pass that also tokenises.
2. Pieces are ordered by length over range partitions, and written. The number of pieces of each
   length, at most `capacity` numbers, goes to the driver.
3. There lengths are placed longest first. All packs of equal content are one pattern with a count; the
   pieces of a length go to the pattern with the most free space, and the counts are updated. The
   work depends on the capacity, not on the number of documents.
4. A piece's rank among those of its length tells its pattern, its pack and its place there. The rank
   is the position in the written order, less that of the first piece of the length in the partition,
   plus the number of such pieces in earlier partitions. No length, however frequent, meets in one task.
"""

from __future__ import annotations

import json
import struct
import zlib
from codecs import charmap_decode
from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping
from itertools import pairwise
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmill.llm.common import Recent, once_per_worker, ship_code, texts
from basketmill.llm.token_count import ENDS, LATIN_END, byte_symbols, small_letters
from basketmill.operators.staging import stage

#: Pieces of text whose ids a worker keeps, at most twice as many.
CACHE_SIZE = 400_000
#: Bytes of text whose pieces are looked up together.
GROUP_BYTES = 8_000_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: Positions of `monotonically_increasing_id`: the partition above, the row in it below.
ROW_BITS = 33


class IdEncoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers, by the tokenizers library.

    For a byte-level BPE tokenizer file that drops white space and keeps runs of letters together. No
    token spans ASCII white space, so texts are split there, some MB of them at once, and each piece is looked up
    once for all its places; the ids of the more recent pieces are kept. A run of small letters goes straight to the
    library's merging step, other pieces through all of it.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        spec = json.loads(definition)
        steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        split = [step for step in steps if step["type"] == "Split"]
        if not (split and split[0].get("invert") and split[0]["behavior"] == "Removed"):
            raise ValueError("a tokenizer that drops white space is needed")
        normalizers = spec.get("normalizer") or {}
        self.lower = any(step["type"] == "Lowercase" for step in normalizers.get("normalizers", [normalizers]))
        self.whole = Tokenizer.from_str(definition)
        self.merging = self.whole.model
        self.symbols = "".join(symbol for _, symbol in sorted(byte_symbols().items()))
        #: Each id as it is returned.
        self.packed = [_packed([number]) for number in range(1 + max(spec["model"]["vocab"].values()))]
        self.specials = [token["content"].encode() for token in spec.get("added_tokens", [])]
        self.ends = ENDS.encode()
        self.ids = Recent(self.make, CACHE_SIZE)

    def by_library(self, text: str) -> bytes:
        return _packed(self.whole.encode(text, add_special_tokens=False).ids)

    def letters(self, word: bytes) -> bytes:
        symbols = word.decode() if word.isascii() else charmap_decode(word, "strict", self.symbols)[0]
        packed = self.packed
        return b"".join([packed[token.id] for token in self.merging.tokenize(symbols)])

    def make(self, piece: bytes) -> bytes:
        if piece.isalpha() and piece.islower():  # of bytes: a-z alone
            return self.letters(piece)
        word = piece.rstrip(self.ends)
        if word.isalpha():
            plain, small = True, word.lower()
        else:
            text = word.decode().lower()
            plain, small = text.isalpha() and max(text) < LATIN_END, text.encode()
        if not plain or not (self.lower or small == word):
            return self.by_library(piece.decode())
        if small == piece:
            return self.letters(small)
        return self.ids[small] + (self.ids[piece[len(word) :]] if len(word) < len(piece) else b"")

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Of each text, in order."""
        group: list[bytes] = []
        size = 0
        for text in texts:
            data = small_letters(text, [], "replace") if self.lower else text.encode("utf-8", "replace")
            if any(special in data for special in self.specials):
                yield from self._group(group)
                yield self.by_library(text)
                group, size = [], 0
                continue
            group.append(data)
            size += len(data)
            if size > GROUP_BYTES:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, group: list[bytes]) -> Iterator[bytes]:
        """Ids of UTF-8 texts without special strings."""
        split = pc.ascii_split_whitespace(pa.array(group, pa.binary()).view(pa.string()))
        pieces = split.flatten().dictionary_encode()
        found = list(map(self.ids.__getitem__, pieces.dictionary.view(pa.binary()).to_pylist()))
        ids = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        # For each place of a piece, where its ids begin, and where those of the next place will be.
        place = pieces.indices.to_numpy()
        count = sizes[place]
        ends = np.cumsum(count)
        source = np.repeat((np.cumsum(sizes) - sizes)[place] - ends + count, count)
        source += np.arange(len(source))
        data = ids[source].tobytes()
        borders = 4 * np.concatenate([[0], ends])[split.offsets.to_numpy()]
        for start, end in pairwise(borders.tolist()):
            yield data[start:end]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def token_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of at most `capacity` ids of each document's ids followed by `end_id`."""
    spark = docs.sparkSession
    ship_code(spark)
    definition = spark.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))
    last = np.array([end_id], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = once_per_worker(("ids", tokenizer_path), lambda: IdEncoder(definition.value))
        for batch in batches:
            rows = []
            for identity, ids in zip(batch["doc_id"], encoder.encode(texts(batch["text"])), strict=True):
                ids += last
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    rows.append((identity, start, len(piece) // 4, zlib.crc32(piece), total))
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            yield out.astype({"doc_id": "Int64"})

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInPandas(pieces, PIECES)


def pack_histogram(histogram: Mapping[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in a pack, longest first) with the number of packs of each.

    Longest lengths first; each goes to the packs that hold least so far, if it fits there, else to new ones.
    """
    if histogram and not 1 <= min(histogram) <= max(histogram) <= capacity:
        raise ValueError(f"lengths must be from 1 to {capacity}")
    by_space: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    closed: list[tuple[tuple[int, ...], int]] = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            space = max((s for s, packs in by_space.items() if packs), default=0)
            pattern, count = by_space[space].pop() if space >= length else ((), left)
            used = min(count, left)
            if used < count:
                by_space[space].append((pattern, count - used))
            left -= used
            rest = (space if pattern else capacity) - length
            if rest:
                by_space[rest].append(((*pattern, length), used))
            else:
                closed.append(((*pattern, length), used))
    counts: dict[tuple[int, ...], int] = defaultdict(int)
    for pattern, count in [*closed, *(pack for packs in by_space.values() for pack in packs)]:
        counts[pattern] += count
    return sorted(counts.items(), reverse=True)


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """By length, rows (first rank, pieces of this length in a pack, first pack's number, their offset in it)."""
    rows: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    first_pack = 0
    for pattern, count in patterns:
        offset = 0
        for length in dict.fromkeys(pattern):
            copies = pattern.count(length)
            rows[length].append((taken[length], copies, first_pack, offset))
            taken[length] += copies * count
            offset += copies * length
        first_pack += count
    return {length: np.array(found, dtype=np.int64).T for length, found in rows.items()}


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """The rows of `pieces`, a stable (written) table with a column `length`, with sequence_id and offset.

    Sequences are numbered from 0. Within one, offsets run from 0 without gaps.
    """
    spark = pieces.sparkSession
    ship_code(spark)
    clash = {"_position", "sequence_id", "offset"} & set(pieces.columns)
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)}")
    key = [column for column in ("doc_id", "start") if column in pieces.columns]
    ordered = pieces.repartitionByRange("length", *key).sortWithinPartitions("length", *key)
    ordered = stage(ordered.withColumn("_position", F.monotonically_increasing_id()), "pieces")
    # One row per partition and length that occurs there: at most the partitions plus the capacity, as the order is by length.
    runs = (
        ordered.groupBy("length", F.shiftright("_position", ROW_BITS).alias("part"))
        .agg(F.min("_position").alias("first"), F.count("*").alias("n"))
        .orderBy("length", "part")
        .collect()
    )
    histogram: dict[int, int] = defaultdict(int)
    base: dict[tuple[int, int], int] = {}
    for run in runs:
        base[run["length"], run["part"]] = histogram[run["length"]] - run["first"]
        histogram[run["length"]] += run["n"]
    places = spark.sparkContext.broadcast((base, _places(pack_histogram(histogram, capacity))))

    @F.pandas_udf("sequence_id long, offset long")
    def placed(lengths: pd.Series, positions: pd.Series) -> pd.DataFrame:
        base, by_length = places.value
        length, position = lengths.to_numpy(np.int64), positions.to_numpy(np.int64)
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        run = length << ROW_BITS | position >> ROW_BITS
        for one in np.unique(run):
            here = run == one
            each = int(one >> ROW_BITS)
            rank = position[here] + base[each, int(one & (1 << ROW_BITS) - 1)]
            first, copies, pack_number, start = by_length[each]
            at = np.searchsorted(first, rank, side="right") - 1
            sequence[here] = pack_number[at] + (rank - first[at]) // copies[at]
            offset[here] = start[at] + (rank - first[at]) % copies[at] * each
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    columns = [F.col(column) for column in pieces.columns]
    return ordered.select(*columns, placed("length", "_position").alias("_place")).select(*columns, "_place.*")


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every input row is packed, repeated ids too; other input columns are ignored. A null or empty text is the single
    `end_id`. A null id stays null. An empty table gives an empty one.
    """
    return pack(stage(token_pieces(docs, tokenizer_path, capacity, end_id, doc_id, text), "token-pieces"), capacity)
