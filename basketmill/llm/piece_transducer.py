"""SentencePiece encoding and decoding as a shortest path in a weighted transducer.

A BPE model file is compiled into parts that are composed with each input as it is read:

- the normaliser: a space becomes the mark U+2581, and the text gets one in front;
- the pieces: a trie over characters whose final states give out a piece's id;
- byte fallback: a character that no piece has gives out its UTF-8 bytes' ids;
- an acceptor over ids, whose state is the last piece: the arc from u to v weighs 0 if merging the characters of
  u and v together gives u and v again, and infinity if not.

Byte-pair merging gives the one sequence of pieces whose neighbours all pass that test, so the path of least weight
in the tropical semiring (minimum, plus) is the model's encoding. Each prefix of an input has one path of
finite weight too, so the search keeps one state per position.

No merge crosses a border between two characters that stand side by side in no piece. The parts of a text between such
borders recur, and each Python worker keeps the paths of the more recent ones.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from math import inf
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmill.llm.common import Recent, once_per_worker, ship_code, texts

MARK = "▁"
CACHE_SIZE = 450_000
PAIRS_KEPT = 500_000


class PieceTransducer:
    """The compiled parts of a BPE model, and the search."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        normalizer, kinds = spec.normalizer_spec, spec.SentencePiece
        if spec.trainer_spec.model_type != spec.trainer_spec.BPE or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("a BPE model with marks in front is needed")
        plain = not normalizer.precompiled_charsmap and not normalizer.remove_extra_whitespaces
        if not (plain and normalizer.escape_whitespaces and normalizer.add_dummy_prefix):
            raise ValueError("a model whose normaliser only escapes spaces and adds one is needed")
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.surface: list[bytes] = []
        for number, piece in enumerate(spec.pieces):
            if piece.type == kinds.BYTE:
                value = int(piece.piece[3:5], 16)
                self.byte_ids[value] = number
                self.surface.append(bytes([value]))
            elif piece.type == kinds.NORMAL:
                self.ids[piece.piece], self.scores[piece.piece] = number, piece.score
                self.surface.append(piece.piece.replace(MARK, " ").encode())
            elif piece.type in (kinds.CONTROL, kinds.UNKNOWN):
                self.surface.append(b"" if piece.type == kinds.CONTROL else spec.trainer_spec.unk_surface.encode())
            else:
                raise ValueError(f"pieces of type {piece.type} are not supported")
        if any(re.search(f"[^{MARK}]{MARK}", piece) for piece in self.ids):
            raise ValueError("a piece has a mark after another character")
        self.names = {number: piece for piece, number in self.ids.items()}
        self.longest = max(map(len, self.ids))
        #: Two characters that stand side by side in a piece; no merge crosses a border between any others.
        self.joined = {piece[at : at + 2] for piece in self.ids for at in range(len(piece) - 1)}
        if not {character for piece in self.ids for character in piece} <= self.ids.keys():
            raise ValueError("a character of a piece has no piece of its own")
        # Every prefix of a piece, with the piece's id or -1; a walk of the trie stops at what is not here.
        self.trie = {piece[:size]: -1 for piece in self.ids for size in range(1, len(piece) + 1)} | self.ids
        alone = "" if any("\n" in piece for piece in self.ids) else r"\n"
        self.borders = re.compile(f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" + (f"|{alone}" if alone else ""))
        #: Weights by (id of the last piece + 1, 0 at the start) << 32 | id of the next one.
        self.pairs: dict[int, float] = {}
        self.paths = Recent(self.path, CACHE_SIZE)

    def merged(self, text: str) -> list[str]:
        """The pieces that merging gives: again and again the adjacent two with the best scored join, the first among equals."""
        symbols = list(text)
        score = self.scores.get
        joins = [score(left + right, -inf) for left, right in zip(symbols, symbols[1:], strict=False)]
        while joins and (best := max(joins)) > -inf:
            at = joins.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del joins[at]
            if at:
                joins[at - 1] = score(symbols[at - 1] + symbols[at], -inf)
            if at < len(joins):
                joins[at] = score(symbols[at] + symbols[at + 1], -inf)
        return symbols

    def weight(self, pair: int) -> float:
        """Of the acceptor's arc; from the start, that of a piece that merging its own characters gives is 0."""
        left, right = (pair >> 32) - 1, pair & 0xFFFFFFFF
        pieces = [self.names[one] for one in (left, right) if one >= 0]
        weight = 0.0 if self.merged("".join(pieces)) == pieces else inf
        if len(self.pairs) >= PAIRS_KEPT:
            self.pairs.clear()
        self.pairs[pair] = weight
        return weight

    def shortest_path(self, part: str) -> list[int]:
        """Ids of characters that all have pieces.

        Weights are 0 and infinity only, so a position is reached by a path of weight 0 or not at all; of it the last piece is kept.
        """
        trie, known, weight, longest = self.trie.get, self.pairs.get, self.weight, self.longest
        size = len(part)
        last = [-1] * (size + 1)
        start = [-1] * (size + 1)
        start[0] = 0
        for at in range(size):
            if start[at] < 0:
                continue
            left = last[at] + 1 << 32
            for end in range(at + 1, min(size, at + longest) + 1):
                number = trie(part[at:end])
                if number is None:
                    break
                if number >= 0 and start[end] < 0:
                    least = known(left | number)
                    if least is None:
                        least = weight(left | number)
                    if least == 0.0:
                        last[end], start[end] = number, at
        if start[size] < 0:
            raise ValueError(f"no path for {part!r}")
        ids = []
        while size:
            ids.append(last[size])
            size = start[size]
        return ids[::-1]

    def path(self, part: str) -> bytes:
        joined = self.joined
        cuts = [at for at in range(1, len(part)) if part[at - 1 : at + 1] not in joined]
        if cuts:
            return b"".join([self.paths[part[a:b]] for a, b in zip([0, *cuts], [*cuts, len(part)], strict=True)])
        if len(part) > 1 or part in self.ids:
            ids = self.shortest_path(part)
        else:
            ids = [self.byte_ids[byte] for byte in part.encode("utf-8", "replace")]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers; the empty text has none."""
        if not text:
            return b""
        normal = MARK + text.replace(" ", MARK)
        return b"".join(map(self.paths.__getitem__, self.borders.findall(normal)))

    def decode(self, ids: list[int]) -> str:
        """The text of ids, less the space in front; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")


def unpacked(ids: bytes) -> tuple[int, ...]:
    return struct.unpack(f"<{len(ids) // 4}I", ids)


class _Shipped:
    """A model file's content, which the driver reads, compiled once in each Python worker."""

    def __init__(self, df: DataFrame, model_path: str):
        ship_code(df.sparkSession)
        self.path = model_path
        self.content = df.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())

    def __call__(self) -> PieceTransducer:
        return once_per_worker(("pieces", self.path), lambda: PieceTransducer(self.content.value))


def encode(docs: DataFrame, text: str, model_path: str) -> Column:
    """Column (array of int) of the ids of a text column; a null is the empty text, which has none."""
    model = _Shipped(docs, model_path)

    @F.pandas_udf("array<int>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([list(unpacked(model().encode(text))) for text in texts(batch)], dtype=object)

    return encoded(docs[text])


def decode(rows: DataFrame, ids: str, model_path: str) -> Column:
    """Column of the text of an array column of ids; a null is no ids, whose text is empty."""
    model = _Shipped(rows, model_path)

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([model().decode([] if one is None else list(one)) for one in batch], dtype=object)

    return decoded(rows[ids])


def encode_digests(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, n_pieces, ids_crc32, round_trip.

    ids_crc32 is that of the ids as little-endian unsigned 32-bit numbers. round_trip tells whether decoding them gives the text
    again, marks U+2581 of the text as spaces. Every input row gives one row, repeated ids included; other input columns are
    ignored. Null and empty texts have no pieces. A null id stays null. An empty table gives an empty one.
    """
    model = _Shipped(docs, model_path)

    @F.pandas_udf("n_pieces long, ids_crc32 long, round_trip boolean")
    def digested(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            transducer = model()
            rows = []
            for text in texts(batch):
                ids = transducer.encode(text)
                back = transducer.decode(unpacked(ids))
                rows.append((len(ids) // 4, zlib.crc32(ids), back == text.replace(MARK, " ")))
            yield pd.DataFrame(rows, columns=["n_pieces", "ids_crc32", "round_trip"])

    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    digests = docs.select("doc_id", F.length("text").cast("long").alias("n_chars"), digested("text").alias("digest"))
    return digests.select("doc_id", "n_chars", "digest.*")
