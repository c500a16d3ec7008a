"""From raw documents to packed training sequences: toxicity, quality, near duplicates, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketmill.llm import packing, quality, simhash, toxicity
from basketmill.llm.common import read_table
from basketmill.llm.queries import WORD_TOKENIZER
from basketmill.operators.staging import stage, staging_job

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOXIC_FROM = 0.5
GOOD_FROM = 0.7
#: Number of a row, under a name that no input has.
ROW = "_pipeline_row"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below `TOXIC_FROM`; the classifier learns from these documents outside the held-out fold.

    Empty and null texts have no toxic feature and stay. Columns beside doc_id and text pass through. No documents give none.
    """
    labels = read_table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.train_toxicity(docs, labels, ~toxicity.held_out(5, 0))
    return docs.filter(toxicity.toxicity_score(docs, "text", model) < TOXIC_FROM)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least `GOOD_FROM`; the classifier learns from these documents outside the held-out fold.

    Empty and null texts score the share of good labels. Columns beside doc_id and text pass through. No documents give none.
    """
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality")
    model = quality.train_quality(docs, labels, ~toxicity.held_out(4, 2))
    return docs.filter(quality.quality_score(docs, "text", model) >= GOOD_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest doc_id; of several with that id, the one whose text's hash is least.

    Groups are of rows, so that rows which share an id but not a text are told apart, and rows without an id are in groups like any
    others, where they come last. Of equal rows one stays. Empty and null texts are copies of one another. Other columns pass through.
    No documents give none.
    """
    # Written, so that a row has the same number in all that follows.
    rows = stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered-documents")
    groups = simhash.near_duplicates(rows, doc_id=ROW).select(F.col("doc_id").alias(ROW), "component_id")
    order = rows.select(ROW, F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), ROW).alias("place"))
    firsts = groups.join(order, ROW).groupBy("component_id").agg(F.min("place").alias("first"))
    # At no size by broadcast, as the numbers grow with the documents, and without sorting texts.
    kept = firsts.select(f"first.{ROW}").hint("shuffle_hash")
    return rows.join(kept, ROW, "left_semi").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces in sequences of 2048.

    A null or empty text is the token that ends a document. Repeated rows and ids are packed each, null ids stay null, equal lengths are placed in
    the order of packing's ranks, other columns are ignored, and no documents give no piece.
    """
    return packing.pack_documents(docs, WORD_TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near duplicates", drop_near_duplicates),
    ("packing", pack),
]

#: No stage can be put in SQL; tests hold each against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in a folder; each one's result is written and read again, and removed once the next one is."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        with staging_job(spark) as job:
            docs = job.keep(stage(step(spark, docs, sf_dir), name.replace(" ", "-"), docs))
    return docs
