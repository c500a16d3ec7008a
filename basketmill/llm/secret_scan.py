"""Secret scan: fixed patterns, and a linear-chain conditional random field that finds what they leave.

The field tags each token of a text as beginning of a secret, inside of one, or outside. Its features are the token's shape, length,
kinds of characters and changes between them, its beginning and word; the two words before it and the one after it; and
features of the whole text, such as its share of code marks. It is trained with numpy by the driver, by forward and backward
recursion, on bounded passages of the documents, in which the patterns' matches are the secrets, with generated secrets
of common forms, and statements that only look like some, set into them. Tags are decoded by Viterbi's algorithm.

Scores are relative to those of "outside", so a run of tokens that aren't outside is worth the sum of its scores and transitions.
For each token there is a bound of what it can add to that. Where no run around a token has bounds that sum up to 0 or more, the
token is outside on the best path. Such tokens part the text, and Viterbi's algorithm runs over what lies between, with the
same result as over the whole text.
"""

from __future__ import annotations

import random
import re
import string
import uuid
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmill.llm.common import draw, once_per_worker, ship_code, texts

# The patterns, in the order of their kinds, with the least length of the match or, for "assign", of group 2.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
#: A run of such characters is matched as a whole or not at all, so the least length can be part of the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6
KINDS = ("assign", "access", "hex", "crf")
#: What "assign" needs in lower-case text; a text without any of these has no match.
KEYWORDS = ("passw", "secret", "token", "api")

TOKEN = re.compile(r"\w+|[^\w\s]")
SPACE = re.compile(r"\s")
#: Characters of a text whose tokens are held at a time, about.
PIECE = 1 << 20
OUTSIDE, BEGIN, INSIDE = range(3)

#: Passages that the field is trained on: documents drawn, characters of each, and passages in all.
SAMPLE_DOCUMENTS = 1000
SAMPLE_CHARACTERS = 400
PASSAGES = 3000
WINDOW = 44
STEPS = 90
RIDGE = 2e-4
#: Weights of tokens held by a worker.
HELD_TOKENS = 300_000
HELD_CHARACTERS = 1 << 25

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the patterns' matches, kind after kind."""
    found = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        found += [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(1, *m.span()) for m in ACCESS.finditer(text)]
    return found + [(2, *m.span()) for m in HEX.finditer(text)]


class _Kinds(dict):
    """Kind of each character met: A, a, 0, or the character itself."""

    def __missing__(self, character: str) -> str:
        self[character] = "A" if character.isupper() else "a" if character.isalpha() else "0" if character.isdigit() else character
        return self[character]


_KINDS = _Kinds()
LENGTHS = (2, 3, 4, 5, 7, 10, 15, 20, 30, 50)


def _kinds(token: str) -> tuple[str, str]:
    """Kinds of a token's characters, neighbours of the same kind taken as one; and its different kinds in order."""
    if token.isalpha() and token.islower():
        return "a", "a"
    kinds = list(map(_KINDS.__getitem__, token))
    runs = "".join([kind for kind, before in zip(kinds, [None, *kinds], strict=False) if kind != before])
    return runs, "".join(sorted(set(runs)))


def token_features(token: str) -> list[str]:
    """Features of a token by itself."""
    length, low = len(token), token.lower()
    runs, present = _kinds(token)
    size = bisect(LENGTHS, length)
    letters = length if present in ("a", "A", "Aa") else sum(map(str.isalpha, token))
    vowels = bisect((0.1, 0.2, 0.3), sum(map(low.count, "aeiouy")) / letters) if letters else 9
    found = [
        f"size {size}",
        f"shape {runs[:8]}",
        f"kinds {present[:6]} {size}",
        f"changes {bisect((2, 3, 4, 6, 9, 14), len(runs))} {length >= 7}",
        f"vowels {vowels} {length >= 6}",
        f"different {bisect((0.3, 0.5, 0.7), len(set(token)) / length)} {length >= 7}",
    ]
    if length >= 8:
        found.append("start " + token[:4])
    if length <= 12:
        found.append("word " + low)
    return found


def word(token: str) -> str:
    """What a neighbour sees of a token: its word, or of a longer one its characters' kinds."""
    return token.lower() if len(token) <= 12 else "long " + _kinds(token[:64])[1][:6]


def text_features(text: str) -> list[str]:
    """Features of a whole text."""
    size = max(1, len(text))
    marks = sum(text.count(mark) for mark in "=:{};\"'_")
    digits = sum(text.count(digit) for digit in string.digits)
    return [
        f"marks {bisect((0.003, 0.01, 0.03, 0.08), marks / size)}",
        f"digits {bisect((0.003, 0.01, 0.05, 0.15), digits / size)}",
        f"lines {bisect((40, 80, 200, 600), size / (1 + text.count(chr(10))))}",
    ]


@dataclass
class Field:
    """Weights of "begin" and "inside" relative to "outside" for each feature, and of tags that follow one another."""

    own: dict[str, tuple[float, float]]
    near: tuple[dict[str, tuple[float, float]], ...]
    whole: dict[str, tuple[float, float]]
    follows: np.ndarray
    identity: str = ""

    def bounds(self, found: np.ndarray) -> np.ndarray:
        """What each token adds, at most, to the worth of a run of tokens that aren't outside.

        Steps are counted relative to those between tokens outside, and each tag lends the cost of the
        step out of it to the step into it, so that leaving a run costs nothing; a run that ends with the text never leaves.
        """
        steps = self.follows - self.follows[OUTSIDE, OUTSIDE]
        lent = -steps[:, OUTSIDE]
        into = (steps + lent[:, None] - lent).max(axis=0)
        bound = (found + into[1:]).max(axis=1)
        bound[-1] += max(0.0, lent.max())
        return bound


#: Neighbours whose words count, by their distance.
NEIGHBOURS = (-1, -2, 1)
NOTHING = (0.0, 0.0)


@dataclass
class Weights(dict):
    """Number of each token met so far; its rows hold what it adds to the scores of itself and of its neighbours."""

    model: Field
    rows: np.ndarray = field(default_factory=lambda: np.zeros((1024, 8)))
    characters: int = 0

    def __missing__(self, token: str) -> int:
        number = len(self)
        if number == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        begin = inside = 0.0
        own = self.model.own
        for name in token_features(token):
            if name in own:
                weights = own[name]
                begin += weights[0]
                inside += weights[1]
        seen = word(token)
        one, two, three = (table.get(seen, NOTHING) for table in self.model.near)
        self.rows[number] = (begin, inside, *one, *two, *three)
        self.characters += len(token)
        self[token] = number
        return number

    def numbers(self, tokens: list[str]) -> np.ndarray:
        if len(self) > HELD_TOKENS or self.characters > HELD_CHARACTERS:
            self.clear()
            self.characters = 0
        return np.fromiter(map(self.__getitem__, tokens), dtype=np.int64, count=len(tokens))


def pieces(text: str, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive parts of a text that no token crosses."""
    start = 0
    while start < len(text):
        cut = SPACE.search(text, start + size)
        end = cut.end() if cut else len(text)
        yield start, end
        start = end


def scores(text: str, weights: Weights, size: int = PIECE) -> np.ndarray:
    """(token, 2): scores of "begin" and "inside"."""
    parts = []
    for start, end in pieces(text, size):
        tokens = TOKEN.findall(text, start, end)
        numbers = weights.numbers(tokens)
        parts.append(weights.rows[numbers])
    if not parts:
        return np.zeros((0, 2))
    rows = np.concatenate(parts)
    found = rows[:, :2] + sum(np.array(weights.model.whole.get(one, NOTHING)) for one in text_features(text))
    for at, distance in enumerate(NEIGHBOURS):
        added = rows[:, 2 + 2 * at : 4 + 2 * at]
        if distance < 0:
            found[-distance:] += added[:distance]
        else:
            found[:-distance] += added[distance:]
    return found


def viterbi(found: np.ndarray, follows: np.ndarray, last: bool) -> list[int]:
    """The best tags of consecutive tokens between tokens that are outside; `last` if the text ends with them."""
    best, back = list(follows[OUTSIDE] + [0.0, *found[0]]), []
    table = follows.T.tolist()
    for begin, inside in found[1:].tolist():
        steps = [max((best[before] + one, -before) for before, one in enumerate(into)) for into in table]
        back.append([-before for _, before in steps])
        best = [steps[OUTSIDE][0], steps[BEGIN][0] + begin, steps[INSIDE][0] + inside]
    ends = best if last else [one + table[OUTSIDE][tag] for tag, one in enumerate(best)]
    tags = [max(range(3), key=lambda tag: (ends[tag], -tag))]
    for before in reversed(back):
        tags.append(before[tags[-1]])
    return tags[::-1]


def tag(found: np.ndarray, model: Field) -> dict[int, int]:
    """Tags of all tokens that are not outside, by the token's number."""
    if not len(found):
        return {}
    sums = np.concatenate([[0.0], np.cumsum(model.bounds(found))])
    # The best run that holds a token goes from the least sum before it to the largest one after it; a little is for rounding.
    most = np.maximum.accumulate(sums[:0:-1])[::-1] - np.minimum.accumulate(sums[:-1])
    unsure = np.flatnonzero(most >= -1e-6)
    tags = {}
    if len(unsure):
        for run in np.split(unsure, np.flatnonzero(np.diff(unsure) > 1) + 1):
            first = int(run[0])
            decoded = viterbi(found[run], model.follows, last=int(run[-1]) == len(found) - 1)
            tags.update((first + at, one) for at, one in enumerate(decoded) if one != OUTSIDE)
    return tags


def field_spans(text: str, weights: Weights, size: int = PIECE) -> list[tuple[int, int]]:
    """(start, end) of each run of tokens that begins a secret and those inside of it."""
    tags = tag(scores(text, weights, size), weights.model)
    if not tags:
        return []
    spans, number, open_at = [], 0, -2
    for start, end in pieces(text, size):
        for match in TOKEN.finditer(text, start, end):
            one = tags.get(number, OUTSIDE)
            if one == INSIDE and open_at == number - 1:
                spans[-1][1] = match.end()
            elif one != OUTSIDE:
                spans.append([match.start(), match.end()])
            if one != OUTSIDE:
                open_at = number
            number += 1
    return [(start, end) for start, end in spans]


def all_spans(text: str, weights: Weights) -> list[Span]:
    """The patterns' matches, and the field's spans that touch none of them, by start, then kind."""
    base = base_spans(text)
    taken = sorted((start, end) for _, start, end in base)
    starts = np.array([start for start, _ in taken])
    ends = np.maximum.accumulate(np.array([end for _, end in taken], dtype=np.int64)) if taken else np.array([], dtype=np.int64)
    added = []
    for start, end in field_spans(text, weights):
        before = int(np.searchsorted(starts, end))  # matches that start before this one ends
        if not before or ends[before - 1] <= start:
            added.append((3, start, end))
    return sorted(base + added, key=lambda span: (span[1], span[0]))


# ---- training


def _random(rng: random.Random, characters: str, least: int, most: int) -> str:
    return "".join(rng.choices(characters, k=rng.randint(least, most)))


def made_secret(rng: random.Random) -> tuple[str, str, str]:
    """A statement that holds a secret: what comes before it, the secret, what comes after it."""
    alnum, hexes, base64 = string.ascii_letters + string.digits, "0123456789abcdef", string.ascii_letters + string.digits + "+/"
    upper = string.ascii_uppercase + string.digits
    known = [
        lambda: "ghp_" + _random(rng, alnum, 36, 36),
        lambda: rng.choice(["gho_", "ghs_", "github_pat_", "glpat_", "npm_", "hf_"]) + _random(rng, alnum, 20, 40),
        lambda: rng.choice(["sk_live_", "sk_test_", "rk_live_", "pk_live_"]) + _random(rng, alnum, 16, 30),
        lambda: rng.choice(["sk-", "sk-proj-", "key-", "SG."]) + _random(rng, alnum, 24, 50),
        lambda: f"xox{rng.choice('abp')}-{_random(rng, string.digits, 10, 12)}-{_random(rng, alnum, 20, 26)}",
        lambda: f"eyJ{_random(rng, alnum, 15, 40)}.eyJ{_random(rng, alnum, 20, 60)}.{_random(rng, alnum, 30, 45)}",
        lambda: "AIza" + _random(rng, alnum, 35, 35),
        lambda: "AKIA" + _random(rng, upper, 16, 16),
        lambda: _random(rng, base64, 38, 42),
        lambda: _random(rng, hexes, 32, 64),
        lambda: _random(rng, alnum, 16, 40),
    ]
    password = "".join(_random(rng, alnum, 3, 8) + rng.choice(["", "!", "#", "$", "-", "."]) for _ in range(rng.randint(1, 2))) + str(rng.randint(0, 99))
    name = rng.choice(
        "password passwd pwd secret token api_key apikey client_secret access_key auth_token private_key credential SECRET_KEY DB_PASSWORD".split()
    )
    equals, quote = rng.choice(["=", " = ", ": ", ":", "=>"]), rng.choice(["", '"', "'"])
    form = rng.randrange(7)
    if form == 0:
        return f"{name}{equals}{quote}", password, quote
    if form == 1:
        return f"{rng.choice(['my', 'the', 'your'])} {rng.choice(['password', 'pin', 'passphrase'])} is ", password, ""
    if form == 2:
        scheme = rng.choice(["postgres", "mysql", "mongodb", "amqp", "redis", "https"])
        return f"{scheme}://{_random(rng, string.ascii_lowercase, 4, 8)}:", password, f"@{_random(rng, string.ascii_lowercase, 4, 8)}.example.com/db"
    if form == 3:
        return f"{rng.choice(['Authorization', 'authorization'])}: {rng.choice(['Bearer', 'token', 'Basic'])} ", rng.choice(known)(), ""
    if form == 4:
        return "", rng.choice(known[:8])(), ""
    return f"{name}{equals}{quote}", rng.choice(known)(), quote


def made_plain(rng: random.Random) -> str:
    """A statement that looks like one with a secret and has none."""
    digits, low = string.digits, string.ascii_lowercase
    return rng.choice(
        [
            lambda: f"version = {rng.randint(0, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 9)}",
            lambda: f"{_random(rng, low, 3, 8)}.{_random(rng, digits, 1, 3)}@mail{rng.randint(0, 9)}.example.com",
            lambda: f"https://www.{_random(rng, low, 4, 9)}.org/{_random(rng, low, 4, 9)}/{rng.randint(1, 99999)}?page={rng.randint(1, 40)}",
            lambda: _random(rng, digits, 6, 19),
            lambda: f"+{_random(rng, digits, 1, 3)} {_random(rng, digits, 3, 4)} {_random(rng, digits, 5, 8)}",
            lambda: f"{rng.randint(1980, 2030)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}:00:00Z",
            lambda: f"{_random(rng, low, 4, 9)}_{_random(rng, low, 4, 9)} = {_random(rng, low, 3, 9)}",
            lambda: f"{_random(rng, low, 4, 9)}{_random(rng, low, 3, 7).title()}{_random(rng, low, 3, 7).title()}({rng.randint(0, 500)})",
            lambda: f"{_random(rng, string.ascii_uppercase, 3, 9)}_{_random(rng, string.ascii_uppercase, 3, 9)}",
            lambda: f"the {rng.choice(['token', 'secret', 'password', 'key'])} {rng.choice(['is not given', 'has expired', 'of the house', 'was lost'])}",
            lambda: f"max_tokens = {rng.randint(1, 4096)}",
            lambda: f"user: {_random(rng, low, 4, 9)}, host: {_random(rng, low, 4, 9)}.example.com:{rng.randint(80, 9000)}",
            lambda: _random(rng, low, 13, 28),
            lambda: f"ISBN 978-{_random(rng, digits, 1, 1)}-{_random(rng, digits, 3, 3)}-{_random(rng, digits, 5, 5)}-{_random(rng, digits, 1, 1)}",
            lambda: ".".join(str(rng.randint(0, 255)) for _ in range(rng.choice([3, 4]))),
            lambda: f"{_random(rng, low, 4, 9)}_{_random(rng, digits, 1, 3)}.{rng.choice(['txt', 'py', 'html', 'jpg'])}",
        ]
    )()


@dataclass
class Passage:
    tokens: list[str]
    tags: list[int]
    features: list[str]


def passage(text: str, secrets: list[tuple[int, int]]) -> Passage:
    """A text's tokens with tags by the secrets' bounds."""
    tokens, tags, last = [], [], -1
    for match in TOKEN.finditer(text):
        inside = next((at for at, (start, end) in enumerate(secrets) if start <= match.start() < end), -1)
        tags.append(OUTSIDE if inside < 0 else INSIDE if inside == last else BEGIN)
        tokens.append(match[0])
        last = inside
    return Passage(tokens, tags, text_features(text))


def _values(text: str) -> list[tuple[int, int]]:
    """Bounds of the secrets themselves in what the patterns match."""
    found = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    return found + [m.span() for pattern in (ACCESS, HEX) for m in pattern.finditer(text)]


def training_passages(sample: list[str], count: int = PASSAGES, seed: int = 0) -> list[Passage]:
    """Windows of the sampled texts; into half of them a generated secret is set, into others a statement without any."""
    rng = random.Random(seed)
    sample = [text for text in sample if text.strip()] or ["the text has no words of its own"]
    found = []
    for _ in range(count):
        words = rng.choice(sample).split(" ")
        start = rng.randint(0, max(0, len(words) - 12))
        words = words[start : start + rng.randint(0, 24)]
        cut, choice = rng.randint(0, len(words)), rng.random()
        head = " ".join(words[:cut]) + rng.choice([" ", "\n", "; ", ": ", "("]) if cut else ""
        tail = rng.choice([" ", "\n", ". ", ", ", ";", ") "]) + " ".join(words[cut:])
        if choice < 0.45:
            before, secret, after = made_secret(rng)
            text, at = head + before + secret + after + tail, len(head) + len(before)
            bounds = [*_values(head), (at, at + len(secret)), *((s, e) for s, e in _values(text) if s >= at + len(secret))]
        else:
            text = head + (made_plain(rng) if choice < 0.8 else "") + tail
            bounds = _values(text)
        one = passage(text, sorted(bounds))
        found.append(Passage(one.tokens[:WINDOW], one.tags[:WINDOW], one.features))
    return [one for one in found if one.tokens]


class Trainer:
    """Passages as arrays, padded to one length; token features are kept once for each different token."""

    def __init__(self, passages: list[Passage]):
        kinds = {token: at for at, token in enumerate(dict.fromkeys(token for one in passages for token in one.tokens))}
        lists = [token_features(token) for token in kinds]
        used = Counter(name for names in lists for name in names)
        self.names = {name: at for at, name in enumerate(name for name, n in used.items() if n > 1 or not name.startswith(("word", "start")))}
        self.words = {name: at for at, name in enumerate(dict.fromkeys(word(token) for token in kinds))}
        self.texts = {name: at for at, name in enumerate(dict.fromkeys(name for one in passages for name in one.features))}
        rows = [[self.names[name] for name in names if name in self.names] for names in lists]
        self.feature = np.array([number for row in rows for number in row], dtype=np.int64)
        self.owner = np.repeat(np.arange(len(rows)), [len(row) for row in rows])
        self.kinds = len(rows)
        longest = max(len(one.tokens) for one in passages)
        self.real = np.zeros((len(passages), longest), dtype=bool)
        self.kind = np.zeros((len(passages), longest), dtype=np.int64)
        self.truth = np.zeros((len(passages), longest), dtype=np.int64)
        for at, one in enumerate(passages):
            size = len(one.tokens)
            self.real[at, :size] = True
            self.kind[at, :size] = [kinds[token] for token in one.tokens]
            self.truth[at, :size] = one.tags
        word_of = np.array([self.words[word(token)] for token in kinds])
        #: Number of the word at each neighbour's place; one more than the last where there is none.
        self.near = []
        for distance in NEIGHBOURS:
            seen = np.full(self.kind.shape, len(self.words))
            own = np.where(self.real, word_of[self.kind], len(self.words))
            if distance < 0:
                seen[:, -distance:] = own[:, :distance]
            else:
                seen[:, :-distance] = own[:, distance:]
            self.near.append(seen)
        self.text = np.array([[self.texts[name] for name in one.features] for one in passages])
        self.shapes = [(len(self.names), 3), *[(len(self.words) + 1, 3)] * len(NEIGHBOURS), (len(self.texts), 3), (3, 3)]

    def split(self, theta: np.ndarray) -> list[np.ndarray]:
        ends = np.cumsum([rows * columns for rows, columns in self.shapes])
        return [part.reshape(shape) for part, shape in zip(np.split(theta, ends[:-1]), self.shapes, strict=True)]

    @staticmethod
    def _sums(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
        return np.stack([np.bincount(index, values[:, tag], size) for tag in range(3)], axis=1)

    def emissions(self, theta: np.ndarray) -> np.ndarray:
        own, *near, whole, _ = self.split(theta)
        of_kind = self._sums(self.owner, own[self.feature], self.kinds)
        found = of_kind[self.kind] + whole[self.text].sum(axis=1)[:, None]
        for table, seen in zip(near, self.near, strict=True):
            found += table[seen]
        return found

    def loss(self, theta: np.ndarray) -> tuple[float, np.ndarray]:
        """Negative log-likelihood of the tags per token, with the ridge, and its gradient."""
        follows = self.split(theta)[-1]
        emitted = self.emissions(theta)
        many, longest = self.kind.shape
        shift = emitted.max(axis=2, keepdims=True)
        local, step = np.exp(emitted - shift), np.exp(follows - follows.max())
        forward, backward = np.zeros_like(emitted), np.zeros_like(emitted)
        scale = np.ones((many, longest))
        for at in range(longest):
            before = forward[:, at - 1] if at else np.eye(3)[[OUTSIDE]].repeat(many, 0)
            here = (before @ step) * local[:, at]
            scale[:, at] = np.where(self.real[:, at], here.sum(axis=1), 1.0)
            forward[:, at] = np.where(self.real[:, at, None], here / here.sum(axis=1, keepdims=True), forward[:, at - 1] if at else 1 / 3)
        backward[:, -1] = 1.0
        pairs = np.zeros((3, 3))
        for at in range(longest - 1, 0, -1):
            ahead = local[:, at] * backward[:, at] / scale[:, at, None]
            live = self.real[:, at]
            pairs += step * (forward[live, at - 1].T @ ahead[live])
            backward[:, at - 1] = np.where(live[:, None], ahead @ step.T, 1.0)
        first = np.zeros((many, 3))
        first[:, OUTSIDE] = 1.0
        pairs += step * (first.T @ (local[:, 0] * backward[:, 0] / scale[:, 0, None]))
        tokens = self.real.sum()
        likelihood = (np.log(scale) + (shift[..., 0] + follows.max()))[self.real].sum()
        told = np.take_along_axis(emitted, self.truth[..., None], axis=2)[..., 0][self.real].sum()
        before = np.concatenate([np.full((many, 1), OUTSIDE), self.truth[:, :-1]], axis=1)
        seen = np.bincount((before * 3 + self.truth)[self.real], minlength=9).reshape(3, 3)
        told += (seen * follows).sum()
        slope = (forward * backward - np.eye(3)[self.truth]) * self.real[..., None]
        flat = slope.reshape(-1, 3)
        gradient = [self._sums(self.feature, self._sums(self.kind.ravel(), flat, self.kinds)[self.owner], self.shapes[0][0])]
        gradient += [self._sums(seen_at.ravel(), flat, len(self.words) + 1) for seen_at in self.near]
        of_text = slope.sum(axis=1)
        gradient.append(sum(self._sums(column, of_text, len(self.texts)) for column in self.text.T))
        gradient.append(pairs - seen)
        joined = np.concatenate([one.ravel() for one in gradient])
        return (likelihood - told) / tokens + RIDGE / 2 * (theta @ theta), joined / tokens + RIDGE * theta

    def fit(self, steps: int = STEPS) -> np.ndarray:
        """Adam on all passages."""
        theta = np.zeros(sum(rows * columns for rows, columns in self.shapes))
        mean, square = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, steps + 1):
            _, gradient = self.loss(theta)
            mean += 0.1 * (gradient - mean)
            square += 0.01 * (gradient**2 - square)
            theta -= 0.15 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step) * mean / (np.sqrt(square) + 1e-8)
        return theta

    def model(self, theta: np.ndarray) -> Field:
        own, *near, whole, follows = self.split(theta)

        def table(names: dict[str, int], weights: np.ndarray) -> dict[str, tuple[float, float]]:
            relative = weights[:, 1:] - weights[:, :1]
            return {name: tuple(relative[at].tolist()) for name, at in names.items()}

        return Field(table(self.names, own), tuple(table(self.words, one) for one in near), table(self.texts, whole), follows.copy())


def train(sample: list[str], count: int = PASSAGES, seed: int = 0) -> Field:
    """A field trained on `count` passages of the sampled texts, generated secrets set into some."""
    trainer = Trainer(training_passages(sample, count, seed))
    model = trainer.model(trainer.fit())
    model.identity = uuid.uuid4().hex
    return model


def draw_sample(docs: DataFrame, doc_id: str, text: str) -> list[str]:
    """One passage each of at most `SAMPLE_DOCUMENTS` documents, in the order of a hash, from a place that a hash tells."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    start = F.pmod(F.xxhash64(doc_id, F.lit("start")), F.greatest(F.lit(1), F.length(value) - SAMPLE_CHARACTERS + 1)) + 1
    parts = docs.select(F.col(doc_id).alias("id"), F.substring(value, start.cast("int"), F.lit(SAMPLE_CHARACTERS)).alias("part"))
    return [row["part"] for row in draw(parts, SAMPLE_DOCUMENTS, "id", "part")]


def secret_spans(docs: DataFrame, text: str, model: Field) -> Column:
    """Column of the spans of a text column: kind, start and end in code points, and what lies between. A null text is the empty one."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of bounded size, as the sample is

    @F.pandas_udf("array<struct<kind:string,start:int,end:int,value:string>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = once_per_worker(("secret weights", shared.value.identity), lambda: Weights(shared.value))
        for batch in batches:
            found = [
                [{"kind": KINDS[kind], "start": start, "end": end, "value": one[start:end]} for kind, start, end in all_spans(one, weights)]
                for one in texts(batch)
            ]
            yield pd.Series(found, dtype=object)

    return spans(F.col(text).cast("string"))


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: Field | None = None) -> DataFrame:
    """Per document: doc_id, spans (kind, start, end, value), by start, then kind.

    Spans of the kinds "assign", "access" and "hex" are the patterns' whole matches; "crf" are those of the field that touch none of them. The
    field is trained on a sample of these documents unless given. Repeated documents are scanned each; a null or empty text
    has no span, a null id stays null, other columns are ignored, and no documents give none.
    """
    model = model or train(draw_sample(docs, doc_id, text))
    return docs.select(F.col(doc_id).alias("doc_id"), secret_spans(docs, text, model).alias("spans"))


def span_digests(found: DataFrame) -> DataFrame:
    """Per row of `find_secrets`: doc_id, n_assign, n_access, n_hex, base_sha256, spans as text."""

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda one: F.concat_ws(":", one["kind"], one["start"], one["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda one: one["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda one: one["kind"] != "crf")
    return found.select(
        "doc_id",
        *(count(kind) for kind in KINDS[:3]),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
