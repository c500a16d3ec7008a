"""Token counts by byte-pair merging with a heap and a linked list; no identifiers are made.

A word's symbols form a doubly linked list. A heap holds every adjacent pair that has a merge
rank; the pair of lowest rank (leftmost among equals) is popped again and again and its two symbols
become one. The word's count is its number of symbols at first minus the number of merges.

Words recur, so each Python worker keeps the counts of the more recent pieces of text between white space, in small letters; those of
letters and punctuation at their end are added up from the two. The count of a text does not depend on that.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import pairwise
from pathlib import Path
from string import ascii_lowercase

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmill.llm.common import Recent, once_per_worker, ship_code, texts

#: Pieces of text, and words of other ones, whose counts a worker keeps, at most twice as many.
CACHE_SIZE = 400_000
WORDS_KEPT = 50_000
ID_BITS = 20
#: Punctuation at the end of a piece that is looked up apart from the letters before it.
ENDS = ".,;:!?%$&*#"
#: Letters before this one have no other normal form.
LATIN_END = "\u0250"


def byte_symbols() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte.

    Printable Latin-1 characters stand for themselves, the other bytes take code points from 256 on in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in plain]
    return {byte: chr(byte) for byte in plain} | {byte: chr(256 + k) for k, byte in enumerate(others)}


#: Characters that are a letter, a number, or neither, wherever tables are of, and in no vocabulary's contractions.
STANDS_FOR = {(True, False): "\u0436", (False, True): "\u0664", (False, False): "\u2603"}


def library_class(name: str) -> np.ndarray:
    """Whether each code point has a Unicode property in the tables of the tokenizers library."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    points = np.array([point for point in range(0x110000) if not 0xD800 <= point < 0xE000])
    rest = Split(Regex(rf"\p{{{name}}}"), "removed").pre_tokenize_str("".join(map(chr, points)))
    found = np.zeros(0x110000, dtype=bool)
    found[points] = True
    for _, (start, end) in rest:  # what is left has no such character
        found[points[start:end]] = False
    return found


@cache
def other_classes() -> dict[int, str]:
    """For each character that the library's tables class otherwise than those of `regex`, one that both class as the library does."""
    every = "".join(chr(point) if not 0xD800 <= point < 0xE000 else " " for point in range(0x110000))
    here, there = [], []
    for name in ("L", "N"):
        own = np.zeros(0x110000, dtype=bool)
        for match in regex.finditer(rf"\p{{{name}}}+", every):
            own[match.start() : match.end()] = True
        here.append(own)
        there.append(library_class(name))
    odd = np.flatnonzero((here[0] != there[0]) | (here[1] != there[1]))
    return {int(point): STANDS_FOR[bool(there[0][point]), bool(there[1][point])] for point in odd}


@cache
def late_marks() -> list[str]:
    """Marks that become one character with a small letter of ASCII but not with its capital."""

    def composed(text: str) -> str:
        return unicodedata.normalize("NFC", text).lower()

    marks = [mark for mark in map(chr, range(0x110000)) if unicodedata.combining(mark)]
    return [mark for mark in marks if any(composed(a.upper() + mark) != composed(a + mark) for a in ascii_lowercase)]


def small_letters(text: str, specials: list[bytes], errors: str = "surrogatepass") -> bytes:
    """A text as UTF-8, with A-Z in small letters.

    As it stands if that would change what normal forms make of it, or make one of the special strings.
    """
    data = text.encode("utf-8", errors)
    if not text.isascii() and any(mark in text for mark in late_marks()):
        return data
    small = data.lower()
    return data if any(special in small for special in specials) else small


class HeapMergeCounter:
    """Counts the tokens of texts under a byte-level BPE tokenizer file with a splitting pattern; `others` are its `other_classes`."""

    def __init__(self, definition: str, others: dict[int, str]):
        spec = json.loads(definition)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback"):
            raise ValueError("a byte-level BPE tokenizer is needed")
        vocabulary = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        symbols = byte_symbols()
        self.inner = [vocabulary[symbols[byte]] for byte in range(256)]
        self.final = [vocabulary[symbols[byte] + suffix] for byte in range(256)]
        #: The rank of each pair that merges, and what the pair of each rank becomes.
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[vocabulary[left] << ID_BITS | vocabulary[right]] = rank
            self.made.append(vocabulary[left + right])
        specials = [token["content"] for token in spec.get("added_tokens", [])]
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.special_bytes = [special.encode() for special in specials]
        self.normal_forms, self.lower = self._normalizers(spec.get("normalizer"))
        self.words = self._pattern(spec["pre_tokenizer"])
        self.others = others
        #: Looked up character by character; a pattern of them all would try those beyond 16 bits one after the other.
        self.odd = frozenset(map(chr, others))
        #: Letters before this one are kept together by the pattern, and apart from `ENDS`.
        self.plain_end = self._plain_end(specials)
        #: Counts of pieces, as they stand in the text or in small letters, and of normalised words of those that are not plain.
        self.known = Recent(self.make, CACHE_SIZE)
        self.word_counts = Recent(self.word, WORDS_KEPT)

    @staticmethod
    def _normalizers(spec: dict | None) -> tuple[list[str], bool]:
        steps = [] if spec is None else spec.get("normalizers", [spec])
        forms = [step["type"] for step in steps if step["type"] in ("NFC", "NFD", "NFKC", "NFKD")]
        left = [s["type"] for s in steps if s["type"] not in (*forms, "Lowercase") and s.get("content") != " "]
        if left:
            raise ValueError(f"normalizers not supported: {left}")
        return forms, any(step["type"] == "Lowercase" for step in steps)

    @staticmethod
    def _pattern(spec: dict) -> regex.Pattern:
        for step in spec.get("pretokenizers", [spec]):
            if step["type"] == "Split" and step.get("invert") and step["behavior"] == "Removed":
                # The library's \s is the Unicode property; that of `regex` has a few control characters more.
                return regex.compile(step["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        raise ValueError("a pre-tokenizer that keeps what a pattern matches and drops white space is needed")

    def _plain_end(self, specials: list[str]) -> str:
        end = min({LATIN_END, *self.odd}) if set(self.normal_forms) <= {"NFC"} else "\x80"
        letters = [letter for letter in map(chr, range(ord(end))) if letter.isalpha()]
        runs = ["".join(letters), *letters]
        kept = all(self.words.findall(run + mark) == [run, mark] for run in runs for mark in (ENDS, *ENDS))
        return "" if any(all(c.isalpha() or c in ENDS for c in special) for special in specials) or not kept else end

    def merged(self, ids: list[int]) -> int:
        """The number of merges that a word's symbols go through."""
        rank_of = self.ranks.get
        end = len(ids)
        # A heap of whole numbers: the rank, then the place.
        heap = [
            rank * end + at
            for at, (left, right) in enumerate(pairwise(ids))
            if (rank := rank_of(left << ID_BITS | right)) is not None
        ]
        if not heap:
            return 0
        heapify(heap)
        after = list(range(1, end + 1))
        before = list(range(-1, end - 1))
        done = 0
        while heap:
            rank, at = divmod(heappop(heap), end)
            right = after[at]
            # One of the two symbols may have been merged since; a merged one is -1, which no pair has.
            if right >= end or rank_of(ids[at] << ID_BITS | ids[right]) != rank:
                continue
            ids[at] = made = self.made[rank]
            ids[right] = -1
            done += 1
            after[at] = beyond = after[right]
            if beyond < end:
                before[beyond] = at
                if (rank := rank_of(made << ID_BITS | ids[beyond])) is not None:
                    heappush(heap, rank * end + at)
            if (left := before[at]) >= 0 and (rank := rank_of(ids[left] << ID_BITS | made)) is not None:
                heappush(heap, rank * end + left)
        return done

    def word(self, word: str) -> int:
        data = word.encode("utf-8", "surrogatepass")
        ids = [self.inner[byte] for byte in data]
        ids[-1] = self.final[data[-1]]
        return len(ids) - self.merged(ids)

    def _plain(self, text: str) -> int:
        if not text.isascii():
            for form in self.normal_forms:
                text = unicodedata.normalize(form, text)
        if self.lower:
            # Character by character: a whole string would turn a final capital sigma into another letter.
            text = text.lower() if "Σ" not in text else "".join(map(str.lower, text))
        words = self.words.findall(text) if text.isascii() or self.odd.isdisjoint(text) else self._odd_words(text)
        return sum(map(self.word_counts.__getitem__, words))

    def _odd_words(self, text: str) -> list[str]:
        """The words of a text with characters that the library classes otherwise."""
        return [text[match.start() : match.end()] for match in self.words.finditer(text.translate(self.others))]

    def piece(self, text: str) -> int:
        """Tokens of a piece of text; special strings count as one token each, as the library's default has it."""
        if self.specials is None or not (found := len(self.specials.findall(text))):
            return self._plain(text)
        return found + sum(map(self._plain, self.specials.split(text)))

    def make(self, piece: bytes) -> int:
        text = piece.decode("utf-8", "surrogatepass")
        word = text.rstrip(ENDS)
        small = word.lower() if self.lower else word
        if small.isalpha() and max(small) < self.plain_end:
            if small == text:
                return self.word(small)
            ends = text[len(word) :]
            return self.known[small.encode()] + (self.known[ends.encode()] if ends else 0)
        return self.piece(text)

    def count(self, text: str) -> int:
        # ASCII white space ends every word of the pattern and every special string, so counts add up over it.
        data = small_letters(text, self.special_bytes) if self.lower else text.encode("utf-8", "surrogatepass")
        return sum(map(self.known.__getitem__, data.split()))


def token_count(docs: DataFrame, text: str, tokenizer_path: str) -> Column:
    """Column of the number of tokens of a text column; a null is the empty text, which has none.

    The tokenizer file is read by the driver and its content, a few MB whatever the data, goes to the workers, and so does what the
    library's tables of characters have otherwise.
    """
    spark = docs.sparkSession
    ship_code(spark)
    definition = spark.sparkContext.broadcast((Path(tokenizer_path).read_text(encoding="utf-8"), other_classes()))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = once_per_worker(("heap-merge", tokenizer_path), lambda: HeapMergeCounter(*definition.value))
        for batch in batches:
            yield pd.Series([counter.count(text) for text in texts(batch)], dtype="int64")

    return count(docs[text])


def count_tokens(
    docs: DataFrame, tokenizer_path: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit.

    Every input row gives one row, repeated ids included; other input columns are ignored. Null and
    empty texts have 0 bytes and 0 tokens; a null id stays null. An empty table gives an empty one.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(docs, "text", tokenizer_path).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
