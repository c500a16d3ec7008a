"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples and a sample of texts whose labels are not looked at train logistic classifiers in numpy. The risk is
that of Kiryo et al. (2017): prior * risk of the positives as positives, plus the larger of 0 and (risk of the
unlabelled as negatives - prior * risk of the positives as negatives). Where the second part falls below 0, the step goes
the other way, which keeps the classifier from learning the unlabelled positives as negatives.

Features are whether a text has a word, and whether it has one, two or four different words that begin with some letters.
Those that positives have clearly more often than the unlabelled are kept. The models' mean logit is then shifted to the threshold that maximises
recall squared / share of unlabelled texts above it (Lee and Liu 2003), which needs no negatives either.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmill.llm.common import Recent, doc_crc, once_per_worker, ship_code, texts
from basketmill.operators.staging import stage

#: Bounds of the training sample and of the model.
MOST_POSITIVES = 2000
MOST_UNLABELLED = 6000
MOST_FEATURES = 4096
#: A feature's least number of positives, and by how many standard errors its share must be higher among them.
LEAST_POSITIVES = 3
LEAST_EVIDENCE = 4.0
PREFIXES = range(3, 8)
#: Numbers of different words with the same beginning that make a feature each.
LEVELS = (1, 2, 4)
MODELS = 3
CACHE_SIZE = 150_000
EDGES = string.punctuation + "…“”‘’„«»¿¡—–"


def features_of(word: str) -> list[str]:
    """Features of a word in lower case: itself, and its beginnings."""
    return [f"={word}", *(f"^{word[:size]}" for size in PREFIXES if len(word) > size)] if word else []


def leveled(counts: Counter) -> list[str]:
    """Feature names of the numbers of pieces that have a feature: of words plainly, of beginnings for each level reached."""
    return [f"{level}{name}" for name, n in counts.items() for level in LEVELS if n >= level and (level == 1 or name[0] == "^")]


def features(text: str) -> list[str]:
    return leveled(Counter(one for piece in {piece.strip(EDGES) for piece in text.lower().split()} for one in features_of(piece)))


@dataclass(frozen=True)
class Toxicity:
    """Selected features, a weight for each, and the bias; with nothing to learn from the positives every score is 0."""

    identity: str
    names: list[str]
    weights: np.ndarray
    bias: float


class FeatureFinder:
    """Finds the selected features of texts; what it knows of pieces of text is kept up to a bound."""

    def __init__(self, names: list[str]):
        self.index = {name: at for at, name in enumerate(names)}
        self.asked = {name[1:] for name in names}
        self.known = Recent(self.of_piece, CACHE_SIZE)

    def of_piece(self, piece: str) -> tuple[str, tuple[str, ...]]:
        """The word, and what is asked for of its features."""
        word = piece.strip(EDGES)
        return word, tuple(name for name in features_of(word) if name in self.asked)

    def find(self, text: str) -> list[int]:
        # Few words have any feature that is asked for.
        found = {one for one in map(self.known.__getitem__, set(text.lower().split())) if one[1]}
        if not found:
            return []
        index = self.index
        names = leveled(Counter(name for _, has in found for name in has))
        return sorted(index[name] for name in names if name in index)


def _by_text(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every entry."""
    sizes = [len(row) for row in rows]
    return np.repeat(np.arange(len(rows)), sizes), np.array([f for row in rows for f in row], dtype=np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _logits(rows: list[list[int]], weights: np.ndarray, bias: float) -> np.ndarray:
    row, feature = _by_text(rows)
    return bias + np.bincount(row, weights[feature], len(rows))


def train_nnpu(
    positives: list[list[int]],
    unlabelled: list[list[int]],
    size: int,
    prior: float,
    seed: int,
    epochs: int = 120,
    rate: float = 0.3,
    sparsity: float = 1e-3,
    batches: int = 10,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic classifier, by Adam on the non-negative risk; small weights are shrunk to 0."""
    rng = np.random.default_rng(seed)
    theta, mean, square = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)  # the last one is the bias
    theta[-1] = -1.0
    step = 0
    for _ in range(epochs):
        dealt_p = np.array_split(rng.permutation(len(positives)), batches)
        dealt_u = np.array_split(rng.permutation(len(unlabelled)), batches)
        for part_p, part_u in zip(dealt_p, dealt_u, strict=True):
            if not len(part_p) or not len(part_u):
                continue
            rows_p, rows_u = [positives[at] for at in part_p], [unlabelled[at] for at in part_u]
            at_p, at_u = _logits(rows_p, theta[:-1], theta[-1]), _logits(rows_u, theta[:-1], theta[-1])
            negative_risk = np.logaddexp(0, at_u).mean() - prior * np.logaddexp(0, at_p).mean()
            of_u, of_p = _sigmoid(at_u) / len(at_u), -prior * _sigmoid(at_p) / len(at_p)
            if negative_risk >= 0:
                slope_u, slope_p = of_u, of_p + prior * (_sigmoid(at_p) - 1) / len(at_p)
            else:
                slope_u, slope_p = -of_u, -of_p
            gradient = np.zeros(size + 1)
            for rows, slope in ((rows_p, slope_p), (rows_u, slope_u)):
                row, feature = _by_text(rows)
                gradient[:-1] += np.bincount(feature, slope[row], size)
                gradient[-1] += slope.sum()
            step += 1
            mean += 0.1 * (gradient - mean)
            square += 0.001 * (gradient**2 - square)
            scale = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step) / (np.sqrt(square) + 1e-8)
            theta -= scale * mean
            shrink = np.minimum(rate, scale[:-1] * sparsity)
            theta[:-1] = np.sign(theta[:-1]) * np.maximum(0, np.abs(theta[:-1]) - shrink)
    return theta[:-1], float(theta[-1])


def threshold(positives: np.ndarray, unlabelled: np.ndarray, plain: float) -> float:
    """The logit, midway between two that occur, where recall squared / share of unlabelled above is largest.

    It lies above `plain`, the logit of a text without any feature; infinity if none there is better than to call all texts positive.
    """
    values = np.unique(np.concatenate([positives, unlabelled, [plain]]))
    above_p = 1 - np.searchsorted(np.sort(positives), values) / len(positives)
    above_u = 1 - np.searchsorted(np.sort(unlabelled), values) / len(unlabelled)
    gain = above_p**2 / np.maximum(above_u, 1 / len(unlabelled))
    gain[values <= plain] = 1.0  # that of all texts
    best = int(np.argmax(gain))
    return float((values[best - 1] + values[best]) / 2) if gain[best] > 1 and values[best] > plain else np.inf


def _sample_of(ids: DataFrame, most: int) -> DataFrame:
    """At most so many ids, by the order of a hash."""
    return ids.filter("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def train_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text") -> Toxicity:
    """Fit on the rows for which `learn`, a condition on the column doc_id, holds.

    `labels` has doc_id and toxic; an id is positive if any of its rows has toxic = 1. The class prior is the share
    of positives among learnt rows with a label. At most `MOST_POSITIVES` confirmed texts and `MOST_UNLABELLED`
    texts of any kind are used, chosen by a hash of the id, one text for each id; the driver gets the selected features' numbers only.
    """
    spark = docs.sparkSession
    ship_code(spark)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(learn)
    known = labels.select("doc_id", "toxic").filter(learn).filter("toxic IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    positive = _sample_of(known.filter("toxic = 1").select("doc_id"), MOST_POSITIVES).withColumn("positive", F.lit(True))
    other = _sample_of(docs.select("doc_id"), MOST_UNLABELLED).withColumn("positive", F.lit(False))
    chosen = F.broadcast(positive.unionByName(other))  # ids only, of bounded number
    # One text for each id and kind, however often an id is repeated.
    one = docs.join(chosen, "doc_id").groupBy("doc_id", "positive").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("row"))
    sample = stage(one.select("row.text", "positive"), "toxicity-sample")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = {True: Counter(), False: Counter()}
            for text, positive in zip(texts(batch["text"]), batch["positive"], strict=True):
                counts[bool(positive)].update(features(text))
            for positive, found in counts.items():
                n = np.array(list(found.values()), dtype=np.int64)
                zero = np.zeros_like(n)
                if found:
                    names = pd.Series(list(found), dtype=object)
                    yield pd.DataFrame({"name": names, "p": n if positive else zero, "u": zero if positive else n})

    sizes = {row["positive"]: row["n"] for row in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        return Toxicity(uuid4().hex, [], np.zeros(0), -np.inf)
    found = sample.mapInPandas(counted, "name string, p long, u long").groupBy("name")
    found = found.agg(F.sum("p").alias("p"), F.sum("u").alias("u")).filter(F.col("p") >= LEAST_POSITIVES)
    pooled = (F.col("p") + F.col("u") + 1) / (n_p + n_u) * (1 / n_p + 1 / n_u)
    evidence = (F.col("p") / n_p - F.col("u") / n_u) / F.sqrt(pooled)
    best = found.withColumn("z", evidence).filter(F.col("z") >= LEAST_EVIDENCE).orderBy(F.desc("z"), "name")
    names = [row["name"] for row in best.limit(MOST_FEATURES).select("name").collect()]
    if not names:
        return Toxicity(uuid4().hex, [], np.zeros(0), -np.inf)

    def indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = FeatureFinder(names)
        for batch in batches:
            yield pd.DataFrame({"positive": batch["positive"], "found": [finder.find(t) for t in texts(batch["text"])]})

    rows = sample.mapInPandas(indexed, "positive boolean, found array<int>").collect()
    # In a fixed order, as training depends on it.
    positives = sorted(row["found"] for row in rows if row["positive"])
    unlabelled = sorted(row["found"] for row in rows if not row["positive"])
    models = [train_nnpu(positives, unlabelled, len(names), prior, seed) for seed in range(MODELS)]
    weights = np.mean([weights for weights, _ in models], axis=0)
    bias = float(np.mean([bias for _, bias in models]))
    bias -= threshold(_logits(positives, weights, bias), _logits(unlabelled, weights, bias), bias)
    return Toxicity(uuid4().hex, names, weights, bias)


def toxicity_score(docs: DataFrame, text: str, model: Toxicity) -> Column:
    """Column of the score from 0 to 1 of a text column; null and empty texts have no feature and score below 0.5."""
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        finder = once_per_worker(("toxicity", model.identity), lambda: FeatureFinder(model.names))
        for batch in batches:
            found = [finder.find(text) for text in texts(batch)]
            yield pd.Series(_sigmoid(_logits(found, model.weights, model.bias)))

    return score(docs[text])


def held_out(modulus: int, remainder: int, doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves the remainder; a null id is never held out."""
    return F.coalesce(doc_crc(doc_id) % modulus == remainder, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (1 if score >= 0.5).

    Every input row gives one row, repeated ids included; columns beside doc_id and text are not read. Labels of held-out ids
    are not learnt from, nor are their texts. Where no positive label is learnt from, no feature tells the positives apart, or no
    threshold is better than to call all texts toxic, all scores are 0. An empty table gives an empty one.
    """
    held = held_out(modulus, remainder)
    model = train_toxicity(docs, labels, ~held)
    scored = docs.select("doc_id", "text")
    scored = scored.select("doc_id", held.alias("held_out"), toxicity_score(scored, "text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
