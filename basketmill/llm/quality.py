"""Quality by compression: zstandard dictionaries built from good and from bad text.

A text is compressed without a dictionary, with one trained on good texts and with one trained on bad ones. The difference
of the last two sizes, divided by the larger one and by the text's size, and how far the text shrinks at all are
calibrated to a probability by logistic regression on labelled rows that no dictionary was built from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmill.llm.common import once_per_worker, ship_code, texts
from basketmill.llm.toxicity import held_out
from basketmill.operators.staging import stage

LEVEL = 1
DICTIONARY_BYTES = 110_000
#: Labelled texts of each class that a dictionary is built from, and that the score is calibrated on, at most.
DICTIONARY_TEXTS = 1000
CALIBRATION_TEXTS = 3000
#: Longer texts, in characters, are not used for dictionaries.
LONGEST_SAMPLE = 30_000
RIDGE = 1e-3


@dataclass(frozen=True)
class Quality:
    """Both dictionaries, the coefficients, and the share of good rows among those learnt from."""

    identity: str
    good: bytes
    bad: bytes
    coefficients: np.ndarray | None
    prior: float


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; plain text of the samples' end where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-DICTIONARY_BYTES:]


class Sizes:
    """Compresses texts in the three ways."""

    def __init__(self, good: bytes, bad: bytes):
        self.ways = [zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)]
        for content in (good, bad):
            shared = zstandard.ZstdCompressionDict(content)
            shared.precompute_compress(level=LEVEL)
            self.ways.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=False))

    def of(self, batch: list[str]) -> np.ndarray:
        """Rows (bytes, compressed plainly, with the good dictionary, with the bad one); zeros for an empty text."""
        out = np.zeros((len(batch), 4))
        for at, text in enumerate(batch):
            if data := text.encode("utf-8", "surrogatepass"):
                out[at] = (len(data), *(len(way.compress(data)) for way in self.ways))
        return out


def design(sizes: np.ndarray) -> np.ndarray:
    """The regression's inputs, of about the same scale."""
    n, plain, good, bad = np.maximum(sizes, 1).T
    difference = 10 * (good - bad) / np.maximum(good, bad)
    per_byte = 20 * (good - bad) / n
    shrunk, least, length = 4 * plain / n, 4 * np.minimum(good, bad) / n, np.log1p(n) / 5
    columns = [difference, per_byte, shrunk, length, least]
    columns += [difference * length, shrunk**2, shrunk * length, length**2]
    return np.stack([np.ones_like(n), *columns], axis=1)


def fit_logistic(rows: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton's method with a small ridge, each step halved until the loss falls."""
    theta = np.zeros(rows.shape[1])

    def loss(theta: np.ndarray) -> float:
        logit = rows @ theta
        return float(weight @ (np.logaddexp(0, logit) - truth * logit) + RIDGE / 2 * theta @ theta)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ theta, -40, 40)))
        curvature = (rows * (weight * p * (1 - p))[:, None]).T @ rows + RIDGE * np.eye(len(theta))
        move = np.linalg.solve(curvature, rows.T @ (weight * (p - truth)) + RIDGE * theta)
        while loss(theta - move) > loss(theta) and np.abs(move).max() > 1e-9:
            move = move / 2
        theta = theta - move
        if np.abs(move).max() <= 1e-9:
            break
    return theta


def train_quality(docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text") -> Quality:
    """Fit on the rows for which `learn`, a condition on the column doc_id, holds.

    `labels` has doc_id and quality; an id is good if any of its rows has quality = 1. Of each class at most `DICTIONARY_TEXTS`
    texts (a third of the class at most) build its dictionary and `CALIBRATION_TEXTS` others calibrate, chosen by a hash of the id, one text for each id.
    """
    spark = docs.sparkSession
    ship_code(spark)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(learn)
    known = labels.select("doc_id", "quality").filter(learn).filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    known = known.groupBy("doc_id").agg((F.max("quality") == 1).alias("good"))
    sizes = {row["good"]: row["n"] for row in known.groupBy("good").agg(F.count("*").alias("n")).collect()}
    prior = sizes.get(True, 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return Quality(uuid4().hex, b"", b"", None, prior if sizes else 1.0)
    chosen = None
    for good, n in sizes.items():
        first = min(DICTIONARY_TEXTS, n // 3)
        ids = known.filter(F.col("good") == good).orderBy(F.xxhash64("doc_id"), "doc_id").limit(first + CALIBRATION_TEXTS)
        # The dictionary's share by another hash, so that it needs no count over the ordered rows.
        share = first / min(n, first + CALIBRATION_TEXTS)
        builds = F.pmod(F.hash("doc_id"), F.lit(10_000)) < int(share * 10_000)
        part = ids.select("doc_id", "good", builds.alias("builds"))
        chosen = part if chosen is None else chosen.unionByName(part)
    # Ids only, of bounded number.
    one = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "good", "builds")
    one = one.agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("row"))  # however often an id is repeated
    sample = stage(one.select("doc_id", "row.text", "good", "builds"), "quality-sample")
    material = sample.filter(F.col("builds") & (F.length("text") <= LONGEST_SAMPLE)).orderBy(F.xxhash64("doc_id"), "text")
    gathered: dict[bool, list[bytes]] = {True: [], False: []}
    for row in material.select("good", "text").collect():
        gathered[row["good"]].append(row["text"].encode("utf-8", "surrogatepass"))
    good, bad = (build_dictionary([one for one in gathered[kind] if one]) for kind in (True, False))
    identity = uuid4().hex

    def sized(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ways = once_per_worker(("quality", identity), lambda: Sizes(good, bad))
        for batch in batches:
            out = pd.DataFrame(ways.of(texts(batch["text"])), columns=["n", "plain", "with_good", "with_bad"])
            yield out.assign(good=batch["good"].to_numpy())

    schema = "n double, plain double, with_good double, with_bad double, good boolean"
    rest = sample.filter(~F.col("builds") & (F.length("text") > 0)).mapInPandas(sized, schema)
    rows = np.array([tuple(row) for row in rest.orderBy("n", "plain", "with_good", "with_bad", "good").collect()], dtype=float)
    truth = rows[:, 4] if len(rows) else np.zeros(0)
    if not 0 < truth.sum() < len(truth):
        return Quality(identity, good, bad, None, prior)
    # Classes are sampled at different rates; the weights restore their shares.
    weight = np.where(truth == 1, prior / truth.mean(), (1 - prior) / (1 - truth.mean()))
    return Quality(identity, good, bad, fit_logistic(design(rows[:, :4]), truth, weight), prior)


def quality_score(docs: DataFrame, text: str, model: Quality) -> Column:
    """Column of the score from 0 to 1 of a text column.

    Null and empty texts, and all texts where labels of one class only were learnt from, get the share of good rows.
    """
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for batch in batches:
            if model.coefficients is None:
                yield pd.Series(np.full(len(batch), model.prior))
                continue
            ways = once_per_worker(("quality", model.identity), lambda: Sizes(model.good, model.bad))
            sizes = ways.of(texts(batch))
            logit = np.clip(design(sizes) @ model.coefficients, -40, 40)
            yield pd.Series(np.where(sizes[:, 0] > 0, 1 / (1 + np.exp(-logit)), model.prior))

    return score(docs[text])


def score_documents(
    docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, accept: float = 0.7
) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (1 if score >= `accept`).

    Every input row gives one row, repeated ids included; columns beside doc_id and text are not read. Labels and
    texts of held-out ids are not learnt from. An empty table gives an empty one.
    """
    held = held_out(modulus, remainder)
    model = train_quality(docs, labels, ~held)
    scored = docs.select("doc_id", "text")
    scored = scored.select("doc_id", held.alias("held_out"), quality_score(scored, "text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= accept).cast("int"))
