"""Licence scan: a paragraph classifier over word n-grams, confirmed by comparison with templates.

Units are single lines, and windows of words over each run of lines without an empty one between them, so that neither line breaks
nor text around a statement hide it. Words and pairs of words of a unit are hashed to `FEATURES` numbers, each occurrence counts 1 / sqrt(all occurrences).
A logistic regression tells licence statements from other text; for units that it does not rule out, a
second one with a class for each licence family and one for unknown text gives probabilities, whose temperature is set on
held-out paragraphs. A predicted family is confirmed if the unit holds most of the n-grams of one of its templates.

Both are trained by the driver on the templates, altered copies of them, near misses, and a bounded sample of the documents'
paragraphs as unknown text. Scoring is a column expression; the models are constants of the plan.
"""

from __future__ import annotations

import json
import random
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmill.operators.staging import stage

FEATURES = 8192
SEED = 42  # of the hash, as Spark's xxhash64 has it
#: Paragraphs of the documents that stand for unknown text, at most, the documents they come from, and their length.
MOST_UNKNOWN = 3000
MOST_DOCUMENTS = 600
LONGEST_SAMPLE = 20_000
#: Altered copies of each template.
COPIES = 40
#: Passages of unknown text of a window's length.
PASSAGES = 4000
#: Least probability of being a licence statement at all for the second model to be asked.
PASSING = 0.02
#: The same of a window; several hold a statement, so that one of them has little else.
PASSING_WINDOW = 0.3
ACCEPT = 0.5
#: Windows over longer paragraphs: words in a step, and widths in steps. Each begins half a width after the one before.
STEP = 6
WINDOWS = (2, 4, 10)
#: Comment marks that are words.
COMMENT_WORDS = ("dnl", "rem")
CONFIRM = 0.6

# Notices by which the licences of each family are commonly stated.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction, including without limitation the rights to use,"
        " copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the"
        " Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the"
        " License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        " AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GPL v3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later"
        " version.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public"
        " License as published by the Free Software Foundation.",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-ND": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-NC-SA": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-ND": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "Released under the AGPL v3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public"
        " License as published by the Free Software Foundation.",
    ),
    "EPL": (
        "Licensed under the Eclipse Public License, version 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
        " provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Zlib": (
        "Released under the zlib License.",
        "SPDX-License-Identifier: Zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it"
        " and redistribute it freely.",
    ),
    "public domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work (CC0 1.0).",
        "SPDX-License-Identifier: CC0-1.0",
    ),
}
#: Statements that have words in common with licences but grant nothing.
NEAR_MISSES = (
    "All rights reserved.",
    "Copyright 2020 the authors. All rights reserved.",
    "The driving license must be renewed every ten years.",
    "A license to sell food is issued by the city.",
    "The software is distributed by the vendor and may not be copied.",
    "General terms and conditions of the public service apply.",
    "The version released in spring has many new features.",
    "He studied at MIT and works for a public foundation.",
    "An Apache helicopter landed under heavy fire.",
    "No license is granted by this document.",
    "The work is in the library and is open to the public.",
    "See the license for details.",
)
#: Words that deny what follows them, if that is one of the second kind and no template has the two together.
DENIALS = ("not", "never", "no", "nor", "neither")
DENIED = ("licensed", "released", "under", "available", "covered", "distributed", "granted", "permitted", "license")
#: Words before a statement in which it may be denied.
DENIED_BEFORE = 3
#: Words that other texts often have too.
COMMON = frozenset(
    "a all an and any at be by can code copy conditions distribute following for free general general in included is it library may modify no not"
    " notice of on or out program project provided public released rights software source subject terms that the this to under use version"
    " with without work you your 0 1 2 3 4 v".split()
)
UNKNOWN = "unknown"
FAMILIES = (*TEMPLATES, UNKNOWN)
WORD_BORDER = r"[^\p{L}\p{N}]+"


def _split(paragraph: str) -> list[str]:
    return [word for word in regex.split(WORD_BORDER, paragraph.lower()) if word]


def ngrams(paragraph: str) -> list[str]:
    words = _split(paragraph)
    return words + [f"{one} {other}" for one, other in zip(words, words[1:], strict=False)]


def own_ngrams() -> dict[str, list[str]]:
    """For each family the n-grams of its templates that no template of another family has."""
    held = {family: {ngram for one in templates for ngram in ngrams(one)} for family, templates in TEMPLATES.items()}
    others = {family: set().union(*(held[other] for other in held if other != family)) for family in held}
    return {family: sorted(held[family] - others[family]) for family in held}


def anchors() -> list[str]:
    """Words of which a text must have one, if it holds enough of any template to be confirmed.

    Of each template so many words that its n-grams without any of them are too few; common words come last, then short ones.
    """
    found = set()
    for template in (one for templates in TEMPLATES.values() for one in templates):
        every, rest = set(ngrams(template)), set(ngrams(template))
        for word in sorted({word for word in _split(template)}, key=lambda word: (word in COMMON, -len(word), word)):
            if len(rest) < CONFIRM * len(every):
                break
            found.add(word)
            rest = {ngram for ngram in rest if word not in ngram.split()}
    return sorted(found)


def denied_pairs() -> list[str]:
    known = {ngram for templates in TEMPLATES.values() for one in templates for ngram in ngrams(one)}
    return [pair for deny in DENIALS for word in DENIED if (pair := f"{deny} {word}") not in known]


def features(paragraph: str) -> list[int]:
    """Numbers of the words, and of each word with the one before it; the first word, which has none, counts twice.

    They are Spark's pmod(xxhash64(...), FEATURES) of one or two words.
    """
    found, before = [], SEED
    for word in _split(paragraph):
        data = word.encode()
        alone = xxhash.xxh64_intdigest(data, SEED)
        found += [alone, xxhash.xxh64_intdigest(data, before)]
        before = alone
    return [number % FEATURES for number in found]


@dataclass(frozen=True)
class Classifier:
    """Weights (class, feature) and biases of both models, the second one divided by its temperature."""

    licence: np.ndarray
    licence_bias: float
    families: np.ndarray
    family_bias: np.ndarray


class _Rows:
    """Sparse rows of hashed n-grams."""

    def __init__(self, paragraphs: list[str]):
        found = [features(paragraph) for paragraph in paragraphs]
        self.count = len(found)
        self.row = np.repeat(np.arange(len(found)), [len(one) for one in found])
        self.feature = np.array([number for one in found for number in one], dtype=np.int64)
        self.value = np.repeat([1 / np.sqrt(max(1, len(one))) for one in found], [len(one) for one in found])

    def times(self, weights: np.ndarray) -> np.ndarray:
        parts = [np.bincount(self.row, one[self.feature] * self.value, self.count) for one in weights]
        return np.stack(parts, axis=1)

    def back(self, slope: np.ndarray) -> np.ndarray:
        parts = [np.bincount(self.feature, one[self.row] * self.value, FEATURES) for one in slope.T]
        return np.stack(parts)


def _softmax(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def fit_softmax(rows: _Rows, truth: np.ndarray, classes: int, steps: int = 120, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases of a multinomial logistic regression, by Adam on all rows; classes weigh the same in total."""
    weight = (1 / np.maximum(1, np.bincount(truth, minlength=classes)))[truth] / classes
    target = np.eye(classes)[truth]
    theta = np.zeros((classes, FEATURES + 1))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        slope = (_softmax(rows.times(theta[:, :-1]) + theta[:, -1]) - target) * weight[:, None]
        gradient = np.column_stack([rows.back(slope), slope.sum(axis=0)]) + ridge * theta
        mean += 0.1 * (gradient - mean)
        square += 0.001 * (gradient**2 - square)
        theta -= 0.3 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step) * mean / (np.sqrt(square) + 1e-8)
    return theta[:, :-1], theta[:, -1]


def _altered(template: str, others: list[str], rng: random.Random) -> str:
    """A copy with a few words dropped, and some words of other text before or after it."""
    words = [word for word in template.split() if rng.random() > 0.06]
    around = rng.choice(others).split() if others and rng.random() < 0.3 else []
    cut = rng.randint(0, min(8, len(around)))
    words = around[:cut] + words if rng.random() < 0.5 else words + around[:cut]
    return " ".join(words)


def _within(template: str, others: list[str], rng: random.Random) -> str:
    """A copy in the smallest window that always holds it, filled up with other text before and after it."""
    size = len(template.split())
    width = next((one * STEP for one in WINDOWS if size <= (one // 2 + 1) * STEP), WINDOWS[-1] * STEP)
    room = max(0, width - len(_split(template)))
    before, after = (rng.choice(others).split() for _ in range(2))
    cut = rng.randint(0, room)
    return " ".join([*before[max(0, len(before) - cut) :], template, *after[: room - cut]])


def _passage(unknown: list[str], rng: random.Random) -> str:
    """As many words of unknown text as a window has."""
    words, width = rng.choice(unknown).split(), rng.choice(WINDOWS) * STEP
    start = rng.randint(0, max(0, len(words) - width))
    return " ".join(words[start : start + width])


def train(unknown: list[str], seed: int = 0) -> Classifier:
    """Fit both models; `unknown` are paragraphs that hold no template's n-grams."""
    rng = random.Random(seed)
    paragraphs, truth = [], []
    for number, templates in enumerate(TEMPLATES.values()):
        for template in templates:
            copies = [template, *(_altered(template, unknown, rng) for _ in range(COPIES))]
            copies += [_within(template, [*unknown, *NEAR_MISSES], rng) for _ in range(COPIES // 2)]
            paragraphs += copies
            truth += [number] * len(copies)
    words = [word for templates in TEMPLATES.values() for template in templates for word in template.split()]
    mixed = [" ".join(rng.sample(words, rng.randint(1, 12))) for _ in range(200)]
    others = [*unknown, *NEAR_MISSES * 5, *mixed, *(_passage(unknown, rng) for _ in range(PASSAGES if unknown else 0))]
    paragraphs += others
    truth += [len(TEMPLATES)] * len(others)
    order = rng.sample(range(len(paragraphs)), len(paragraphs))
    held = set(order[: len(order) // 5])
    fit = [at for at in order if at not in held]
    label = np.array(truth)
    rows, rest = _Rows([paragraphs[at] for at in fit]), _Rows([paragraphs[at] for at in sorted(held)])
    licence, bias = fit_softmax(rows, (label[fit] < len(TEMPLATES)).astype(np.int64), 2)
    families, family_bias = fit_softmax(rows, label[fit], len(FAMILIES))
    logits, known = rest.times(families) + family_bias, label[sorted(held)]
    temperatures = np.exp(np.linspace(-2, 2, 41))

    def loss(temperature: float) -> float:
        return -np.log(_softmax(logits / temperature)[np.arange(len(known)), known] + 1e-12).mean()

    best = min(temperatures, key=loss)
    return Classifier(licence[1] - licence[0], float(bias[1] - bias[0]), families / best, family_bias / best)


def _constant(values: object, kind: str) -> Column:
    """A constant array; the optimiser reads it once."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _words(paragraph: Column) -> Column:
    return F.filter(F.split(F.lower(paragraph), WORD_BORDER), lambda word: word != "")


def _feature(*words: Column) -> Column:
    return F.pmod(F.xxhash64(*words), F.lit(FEATURES)).cast("int")


def _weights(words: Column, weights: np.ndarray) -> Column:
    """What each word, and the pair with the word before it, add to the score."""
    table = _constant([round(float(weight), 6) for weight in weights], "array<double>")

    def weight(*hashed: Column) -> Column:
        return F.get(table, _feature(*hashed))

    # The hash passes over a null: before the first word there is none, so that one counts twice.
    return F.transform(words, lambda word, at: weight(word) + weight(F.get(words, at - 1), word))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, one: total + one)


def _logit(words: Column, weights: np.ndarray, bias: float) -> Column:
    """The score of a paragraph's words."""
    return _sum(_weights(words, weights)) / F.sqrt(2 * F.size(words)) + F.lit(bias)


def unknown_sample(paragraphs: DataFrame) -> list[str]:
    """At most `MOST_UNKNOWN` paragraphs of at most `MOST_DOCUMENTS` documents, by the order of a hash, that resemble no template."""
    known = {ngram for templates in TEMPLATES.values() for template in templates for ngram in ngrams(template) if " " in ngram}
    rows = paragraphs.filter((F.length("paragraph") > 0) & (F.length("paragraph") <= LONGEST_SAMPLE))
    rows = rows.orderBy(F.xxhash64("doc_id", "position"), "doc_id", "position", "paragraph").limit(MOST_UNKNOWN)
    found = [row["paragraph"] for row in rows.select("paragraph").collect()]
    return [one for one in found if sum(ngram in known for ngram in set(ngrams(one))) < 2]


def _paragraphs(lines: Column) -> Column:
    """Runs of lines that have a word each: position of the first line, and the lines."""
    at = F.sequence(F.lit(0), F.size(lines) - 1)

    def filled(number: Column) -> Column:
        return F.coalesce(F.get(lines, number).rlike(r"[\p{L}\p{N}]"), F.lit(False))

    def runs(has: Column) -> Column:
        def has_word(number: Column) -> Column:
            return F.coalesce(F.get(has, number), F.lit(False))

        starts = F.filter(at, lambda number: has_word(number) & ~has_word(number - 1))
        ends = F.filter(at, lambda number: has_word(number) & ~has_word(number + 1))
        return F.zip_with(
            starts,
            ends,
            lambda start, end: F.struct(start.alias("position"), F.slice(lines, start + 1, end - start + 1).alias("lines")),
        )

    return _with(F.transform(at, filled), runs)


def _line_words(line: Column) -> Column:
    """The words of a line without a comment mark of letters before them; marks of other characters are no words anyway."""
    return _with(_words(line), lambda words: F.when(_marked(words), F.slice(words, 2, F.size(words))).otherwise(words))


def _marked(words: Column) -> Column:
    return (F.size(words) > 1) & F.coalesce(F.get(words, F.lit(0)).isin(*COMMENT_WORDS), F.lit(False))


def _unit(line: Column, first: Column, size: Column) -> Column:
    return F.struct(line.cast("int").alias("line"), first.cast("int").alias("first"), size.cast("int").alias("size"))


def _passing(lines: Column, weights: np.ndarray, bias: float) -> Column:
    """Units of a paragraph that may be licence statements: each line, and windows over the words of all lines.

    A window's score takes over the weights of the lines' words, so that words on either side of a line's end are no pair in it.
    """
    of_line, of_window = (float(np.log(one / (1 - one))) - bias for one in (PASSING, PASSING_WINDOW))
    nothing = F.lit(None).cast("int")

    def enough(total: Column, size: Column, least: float) -> Column:
        return (size > 0) & (total >= least * F.sqrt(2 * size))

    def whole_lines(by_line: Column) -> Column:
        found = F.transform(by_line, lambda each, at: F.when(enough(_sum(each), F.size(each), of_line), _unit(at, nothing, nothing)))
        return F.filter(found, lambda one: one.isNotNull())

    def windows(each: Column, more_lines: Column) -> Column:
        size = F.size(each)

        def of_width(steps: Column, before: int, width: int) -> Column:
            def window(start: Column) -> Column:
                words = F.least(F.lit(width * STEP), size - start * STEP)
                total = _sum(F.slice(steps, start + 1, F.lit(width)))
                return F.when(enough(total, words, of_window), _unit(nothing, start * STEP, words))

            count, half = F.size(steps), width // 2
            starts = F.sequence(F.lit(0), F.greatest(F.lit(0), count - half - 1), F.lit(half))
            # Fewer words are one window of the size before, or a single line.
            needed = count > before if before else more_lines | (count > width)
            found = F.filter(F.transform(starts, window), lambda one: one.isNotNull())
            return F.when(needed, found).otherwise(F.array().cast("array<struct<line:int,first:int,size:int>>"))

        def of_steps(steps: Column) -> Column:
            return F.concat(*(of_width(steps, before, width) for before, width in zip((0, *WINDOWS), WINDOWS, strict=False)))

        steps = F.transform(
            F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((size - 1) / STEP).cast("int"))),
            lambda number: _sum(F.slice(each, number * STEP + 1, F.lit(STEP))),
        )
        return _with(steps, of_steps)

    def units(by_line: Column) -> Column:
        return F.concat(whole_lines(by_line), _with(F.flatten(by_line), lambda each: windows(each, F.size(by_line) > 1)))

    return _with(F.transform(lines, lambda line: _with(_line_words(line), lambda words: _weights(words, weights))), units)


def _tokens(lines: Column) -> Column:
    """Words of the lines, each with the text up to the next word and the number of its line."""

    def of_line(line: Column, at: Column) -> Column:
        def paired(words: Column, pieces: Column) -> Column:
            both = F.zip_with(
                words,
                # Lower case may have other words.
                F.when(F.size(pieces) == F.size(words), pieces).otherwise(F.transform(words, lambda word: F.concat(word, F.lit(" ")))),
                lambda word, piece: F.struct(word.alias("word"), piece.alias("piece"), at.cast("int").alias("line")),
            )
            return F.when(_marked(words), F.slice(both, 2, F.size(both))).otherwise(both)

        pieces = F.split(F.regexp_replace(F.concat(line, F.lit(" ")), r"^[^\p{L}\p{N}]+", ""), r"(?<=[^\p{L}\p{N}])(?=[\p{L}\p{N}])")
        return _with(_words(line), lambda words: _with(pieces, lambda found: paired(words, found)))

    return F.flatten(F.transform(lines, of_line))


def _cut(tokens: Column, numbers: Column, unit: Column) -> Column:
    """A unit's tokens, their place, the words before them, and for a line its text; `numbers` are the tokens' lines, rising."""
    line = unit["line"]
    start = F.when(line.isNull(), unit["first"]).otherwise((F.array_position(numbers, line) - 1).cast("int"))
    after = F.array_position(numbers, line + 1).cast("int")
    end = F.when(after > 0, after - 1).otherwise(F.size(numbers))

    def cut(first: Column) -> Column:
        size = F.when(line.isNull(), unit["size"]).otherwise(end - first)
        return F.struct(
            line.alias("line"),
            F.get(F.col("lines"), line).alias("whole"),
            first.alias("first"),
            F.slice(tokens, first + 1, size).alias("tokens"),
            F.when(line.isNull(), F.transform(_before(tokens, first), lambda token: token["word"])).alias("lead"),
        )

    return _with(start, cut)


def _before(tokens: Column, first: Column) -> Column:
    """The last tokens before one."""
    count = F.least(F.lit(DENIED_BEFORE), first)
    return F.slice(tokens, first - count + 1, count)


def _ngrams(words: Column) -> Column:
    pair = F.size(words) - 1
    pairs = F.zip_with(F.slice(words, F.lit(1), pair), F.slice(words, F.lit(2), pair), lambda one, other: F.concat_ws(" ", one, other))
    return F.concat(words, pairs)


def _best_apart(units: Column) -> Column:
    """The units, best first, that share no matched word with one taken before."""

    def take(taken: Column, one: Column) -> Column:
        clash = F.exists(taken, lambda other: (other["begin"] <= one["end"]) & (one["begin"] <= other["end"]))
        return F.when(clash, taken).otherwise(F.concat(taken, F.array(one)))

    return F.aggregate(units, F.slice(units, 1, 0), take)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unconfirmed: bool = False) -> DataFrame:
    """Per licence statement: doc_id, paragraph (number of its first line, from 0), family, probability, similarity, confirmed, statement.

    Units are lines, and overlapping windows of words over each run of lines that have words, so that wrapped statements and
    those within long lines are found. A unit counts whose most likely class is a family with probability `ACCEPT` or more and
    that a template confirms, or without the latter if `unconfirmed`: the unit holds most of one of the family's templates and an n-gram that
    no other family's templates have, and it isn't denied. similarity is the largest share of a template's n-grams
    that the unit holds, over the family's templates; `CONFIRM` or more is most. Of units that share words which match their templates
    the most similar one is given, a line before a window; a window's statement begins and ends with words that match.
    Repeated documents are scanned each; other input columns are ignored. Null and empty texts
    have no licence; a null id stays null. An empty table gives an empty one.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    drawn = docs.filter("doc_id IS NOT NULL").select("doc_id").distinct()
    drawn = drawn.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_DOCUMENTS)
    lines = F.posexplode(F.split("text", "\n")).alias("position", "paragraph")
    sampled = docs.join(F.broadcast(drawn), "doc_id")  # ids only, of bounded number
    model = train(unknown_sample(sampled.select("doc_id", lines)))

    if not unconfirmed:
        # Texts without any of these words hold no statement that could be confirmed. Looking for them costs far less than cutting words.
        pattern = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(anchors())})(?![\p{{L}}\p{{N}}])"
        docs = docs.filter(F.lower("text").rlike(pattern))
    rows = docs.select("doc_id", F.explode(_with(F.split("text", "\n"), _paragraphs)).alias("run")).select("doc_id", "run.*")
    rows = rows.withColumn("units", _passing(F.col("lines"), model.licence, model.licence_bias))
    # Filters aren't moved below a number that is given out, so that units are found once and templates are compared with few.
    rows = rows.withColumn("run", F.monotonically_increasing_id()).filter((F.size("units") > 0) & (F.col("run") >= 0))
    tokens = _with(
        _tokens(F.col("lines")), lambda tokens: _with(tokens["line"], lambda numbers: F.transform("units", lambda unit: _cut(tokens, numbers, unit)))
    )
    rows = rows.select("doc_id", "position", "run", F.explode(tokens).alias("unit")).select("doc_id", "position", "run", "unit.*")
    templates = [[sorted(set(ngrams(one))) for one in TEMPLATES[family]] for family in TEMPLATES]
    if not unconfirmed:
        # Only units that some template confirms go on; those are few.
        every = F.lit(json.dumps(sorted({ngram for family in templates for one in family for ngram in one})))
        flat = _constant([one for family in templates for one in family], "array<array<string>>")
        least = min(len(one) for family in templates for one in family)

        def possible(known: Column) -> Column:
            held = F.exists(flat, lambda one: F.size(F.array_intersect(one, known)) >= CONFIRM * F.size(one))
            return (F.size(known) >= CONFIRM * least) & held

        # Bound to a name, as what a lambda mentions is computed anew for each of its elements.
        known = F.array_intersect(_ngrams(F.col("tokens.word")), F.from_json(every, "array<string>"))
        rows = rows.withColumn("possible", _with(known, possible)).withColumn("unit", F.monotonically_increasing_id())
        rows = rows.filter((F.col("unit") >= 0) & F.col("possible")).drop("unit", "possible")
    rows = stage(rows.withColumn("number", F.monotonically_increasing_id()), "licence-units")

    # Each word and pair is hashed once and finds the weights of all classes in a table of fixed size.
    names = [f"class{number}" for number in range(len(FAMILIES))]
    weights = docs.sparkSession.createDataFrame(
        [(feature, *map(float, row)) for feature, row in enumerate(model.families.T)], ", ".join(["feature int", *(f"{name} double" for name in names)])
    )
    hashed = F.flatten(F.transform("tokens.word", lambda word, at: F.array(_feature(word), _feature(F.get(F.col("tokens.word"), at - 1), word))))
    sums = rows.select("number", F.explode(hashed).alias("feature")).join(F.broadcast(weights), "feature").groupBy("number")
    sums = sums.agg(*(F.sum(name).alias(name) for name in names))
    rows = rows.join(sums, "number")
    logits = [F.col(name) / F.sqrt(2 * F.size("tokens")) + float(bias) for name, bias in zip(names, model.family_bias, strict=True)]

    def most_likely(logits: Column) -> Column:
        return _with(F.array_max(logits), lambda top: likelihood(logits, top))

    def likelihood(logits: Column, top: Column) -> Column:
        total = F.aggregate(F.transform(logits, lambda one: F.exp(one - top)), F.lit(0.0), lambda total, one: total + one)
        return F.struct((1 / total).alias("probability"), F.array_position(logits, top).cast("int").alias("class"))

    rows = rows.withColumn("guess", _with(F.array(*logits), most_likely)).drop(*names).select("*", "guess.*").drop("guess")
    rows = rows.filter((F.col("class") < len(FAMILIES)) & (F.col("probability") >= ACCEPT))
    known = F.get(_constant(templates, "array<array<array<string>>>"), F.col("class") - 1)
    own = F.get(_constant(list(own_ngrams().values()), "array<array<string>>"), F.col("class") - 1)

    def compared(grams: Column) -> Column:
        shares = F.transform(known, lambda one: F.struct((F.size(F.array_intersect(one, grams)) / F.size(one)).alias("share"), one.alias("template")))
        return _with(F.array_max(shares), lambda best: _with(matching(best["template"], grams), lambda at: outcome(best, grams, at)))

    def matching(template: Column, grams: Column) -> Column:
        """Places of the unit's pairs that the template has."""
        size = F.size("tokens")
        pairs = F.slice(grams, size + 1, size)
        places = F.sequence(F.lit(0), F.greatest(F.lit(0), size - 2))
        return _with(pairs, lambda pairs: F.filter(places, lambda at: F.array_contains(template, F.get(pairs, at))))

    def outcome(best: Column, grams: Column, at: Column) -> Column:
        # From the first to the last pair of the template, or the whole unit without any.
        first = F.coalesce(F.array_min(at), F.lit(0))
        return F.struct(
            best["share"].alias("similarity"),
            ((best["share"] >= CONFIRM) & F.arrays_overlap(own, grams)).alias("confirmed"),
            first.alias("from"),
            (F.coalesce(F.array_max(at) + 2, F.size("tokens")) - first).alias("count"),
        )

    rows = rows.select("*", _with(_ngrams(F.col("tokens.word")), compared).alias("compared")).select("*", "compared.*").drop("compared")
    # With the words before it, in which the statement may be denied.
    words = F.concat(F.coalesce("lead", F.array().cast("array<string>")), F.col("tokens.word"))
    start = F.coalesce(F.size("lead"), F.lit(0)) + F.col("from")
    first = F.greatest(F.lit(0), start - DENIED_BEFORE)
    nearby = F.slice(words, first + 1, start + F.col("count") - first)
    denied = F.arrays_overlap(_ngrams(nearby), _constant(denied_pairs(), "array<string>"))
    rows = rows.withColumn("confirmed", F.col("confirmed") & ~denied)
    rows = rows if unconfirmed else rows.filter("confirmed")
    inner = F.slice("tokens", F.col("from") + 1, "count")
    is_line = F.col("line").isNotNull()
    rows = rows.select(
        "doc_id",
        "run",
        F.struct(
            (-F.col("similarity")).alias("order"),
            (~is_line).alias("window"),
            (-F.col("probability")).alias("unlikely"),
            (F.col("first") + F.col("from")).alias("begin"),
            (F.col("first") + F.col("from") + F.col("count") - 1).alias("end"),
            (F.col("position") + F.coalesce("line", F.get(inner, F.lit(0))["line"])).alias("paragraph"),
            F.get(_constant(list(FAMILIES), "array<string>"), F.col("class") - 1).alias("family"),
            "probability",
            "similarity",
            "confirmed",
            F.coalesce("whole", F.trim(F.array_join(F.transform(inner, lambda token: token["piece"]), ""))).alias("statement"),
        ).alias("unit"),
    )
    rows = rows.groupBy("run").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list("unit")).alias("units"))
    rows = rows.select("doc_id", F.explode(_best_apart(F.col("units"))).alias("unit"))
    names = ("paragraph", "family", "probability", "similarity", "statement", "confirmed")
    return rows.select("doc_id", *(f"unit.{name}" for name in names))
