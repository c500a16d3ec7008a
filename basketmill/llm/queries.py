"""The queries of this subpackage by name, and the SQL twin of the one that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from basketmill.llm import (
    html_text,
    licenses,
    lz_fingerprint,
    packing,
    piece_transducer,
    quality,
    rp_forest,
    secret_scan,
    simhash,
    token_count,
    toxicity,
    vector_codes,
    whitening,
)
from basketmill.llm.common import read_table

#: The queries' tokenizer files.
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read_table(spark, sf_dir, "documents", "doc_id", "text"), WORD_TOKENIZER)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score_documents(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_transducer.encode_digests(read_table(spark, sf_dir, "documents", "doc_id", "text"), PIECE_MODEL)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return quality.score_documents(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.compare_with_edited(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents", "doc_id", "text"), WORD_TOKENIZER)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.nearest(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.span_digests(secret_scan.find_secrets(read_table(spark, sf_dir, "documents", "doc_id", "text")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_token_counts,
        op2_toxicity,
        op3_licenses,
        op4_html_text,
        op5_pieces,
        op6_quality,
        op7_fingerprints,
        op8_packing,
        op9_simhash,
        op10_neighbours,
        op11_vector_codes,
        op12_secrets,
        op13_whitening,
    )
}


def vector_codes_sql(rounds: int = 6) -> str:
    """Codes by comparing each part with every entry, a round after the other; long for many rounds, so it is made by a rule."""
    steps = [
        """kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS whole FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """cut AS MATERIALIZED (
  SELECT vec_id, part, whole[part * (len(whole) // 8) + 1 : (part + 1) * (len(whole) // 8)] AS v
  FROM kept, range(8) AS parts(part))""",
        """book0 AS MATERIALIZED (
  SELECT part, entry, v FROM cut
  JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 16) USING (vec_id))""",
    ]
    for number in range(rounds + 1):
        steps.append(f"""near{number} AS MATERIALIZED (
  SELECT vec_id, part, min(struct_pack(
      d := CAST(list_sum(list_transform(list_zip(c.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS BIGINT), e := entry)) AS best
  FROM cut AS c JOIN book{number} AS b USING (part) GROUP BY vec_id, part)""")
        if number < rounds:
            steps.append(f"""mean{number} AS MATERIALIZED (
  SELECT part, entry, list(m ORDER BY position) AS v
  FROM (SELECT part, best.e AS entry, position, CAST(sum(x) - ((sum(x) % count(*)) + count(*)) % count(*) AS BIGINT) // count(*) AS m
        FROM (SELECT part, best, generate_subscripts(v, 1) AS position, unnest(v) AS x FROM cut JOIN near{number} USING (vec_id, part))
        GROUP BY part, best.e, position)
  GROUP BY part, entry)""")
            steps.append(f"""book{number + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.v, b.v) AS v FROM book{number} AS b LEFT JOIN mean{number} AS m USING (part, entry))""")
    return "WITH " + ",\n".join(steps) + f""",
coded AS MATERIALIZED (
  SELECT vec_id, string_agg(printf('%02x', CAST(best.e AS INT)), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""


ORACLE_SQL: dict[str, str] = {"op11_vector_codes": vector_codes_sql()}
