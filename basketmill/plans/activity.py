"""Activity by hour of day for any timestamped relation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmill.functions.calendar import hour_text


def hourly_distinct(df: DataFrame, ts: str, key: str, volume: str) -> DataFrame:
    """Distinct keys per hour of the day."""
    volumes = df.groupBy(F.hour(ts).alias("hour")).agg(F.countDistinct(key).alias(volume))
    return volumes.select(hour_text(F.col("hour")).alias("Hour"), volume).orderBy("Hour")
