"""Recency / frequency / monetary segmentation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketmill.functions.labels import SEGMENT_ENGLISH, segment, translate
from basketmill.functions.numeric import money, percent, ratio, round_half_up
from basketmill.operators.customers import customer_totals
from basketmill.operators.ranking import with_tiles
from basketmill.operators.staging import stage
from basketmill.sources.lines import LineSource

SCORES = 5
# Weights of the three scores in the overall score.
WEIGHTS = {"r_score": "0.30", "f_score": "0.35", "m_score": "0.35"}
# A customer without any date ranks as the most recent one.
NO_DAY = 2**31 - 1


def scored_customers(source: LineSource) -> DataFrame:
    """Measures, 1-5 scores and segment of every customer.

    Recency counts days up to the day after the last sale; fewer days score higher, so the score
    follows the last date upwards. Equal values score by customer id. Stored scores are taken as they are.
    """
    stored = source.scored()
    if stored is not None:
        return stored
    measures = stage(customer_totals(source).withColumn("monetary", F.round("spend", 2)), "customers")
    scored = with_tiles(
        measures,
        "customer_id",
        {
            "r_score": F.coalesce(F.unix_date("last_date"), F.lit(NO_DAY)).cast("bigint"),
            "f_score": F.col("frequency"),
            "m_score": (F.col("monetary") * 100).cast("bigint"),
        },
        SCORES,
    )
    today = measures.select(F.date_add(F.max("last_date"), 1)).scalar()
    return scored.select(
        "customer_id",
        F.datediff(today, F.col("last_date")).alias("recency_days"),
        "frequency",
        "monetary",
        "spend",
        "last_date",
        *WEIGHTS,
        segment(*[F.col(score) for score in WEIGHTS]).alias("user_segment"),
    )


def rfm_customers(source: LineSource) -> DataFrame:
    """Measures, scores, weighted score and segment of every customer."""
    weighted = sum((F.col(score) * F.lit(weight).cast("decimal(3,2)") for score, weight in WEIGHTS.items()), F.lit(0))
    return scored_customers(source).select(
        F.col("customer_id").alias("CustomerID"),
        "recency_days",
        "frequency",
        F.col("monetary").cast("double").alias("monetary"),
        *WEIGHTS,
        F.round(weighted, 2).cast("double").alias("rfm_score"),
        "user_segment",
    )


def rfm_customer_detail(source: LineSource, top: int = 50) -> DataFrame:
    """The customers with the highest weighted score."""
    return rfm_customers(source).orderBy(F.desc("rfm_score"), "CustomerID").limit(top)


def rfm_segments(source: LineSource) -> DataFrame:
    """Size, revenue and mean measures of each segment, with shares of the total."""
    grouped = (
        scored_customers(source)
        .groupBy("user_segment")
        .agg(
            F.count("customer_id").alias("user_count"),
            F.sum("monetary").alias("gmv"),
            F.sum("frequency").alias("frequency"),
            F.sum("recency_days").alias("recency_days"),
            F.count("recency_days").alias("dated_users"),
        )
    )
    # At most six rows are left here.
    everyone = Window.partitionBy()
    users, gmv = F.col("user_count"), F.col("gmv")
    return grouped.select(
        "user_segment",
        "user_count",
        percent(users, F.sum(users).over(everyone), 1).alias("user_pct"),
        money(gmv).alias("segment_gmv"),
        percent(gmv, F.sum(gmv).over(everyone), 1).alias("gmv_pct"),
        round_half_up(ratio(gmv, users), 2).alias("avg_monetary"),
        round_half_up(ratio(F.col("frequency"), users), 1).alias("avg_frequency"),
        round_half_up(ratio(F.col("recency_days"), F.col("dated_users")), 0).alias("avg_recency_days"),
    ).orderBy(F.desc("segment_gmv"), "user_segment")


def with_english_segment(segments: DataFrame) -> DataFrame:
    return segments.withColumn("user_segment_label", translate(F.col("user_segment"), SEGMENT_ENGLISH))


def rfm_segment_labels(source: LineSource) -> DataFrame:
    """`rfm_segments` with an English label next to each segment."""
    return with_english_segment(rfm_segments(source))
