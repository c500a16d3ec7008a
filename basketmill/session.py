"""Spark session with the settings the jobs are designed for."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Recording the Python call site of every column expression slows plan building down.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Runtime re-planning: small sides become broadcasts only after their size is
    # measured, hot join keys are split, and small shuffle partitions are merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


GIB = 2**30
MIB = 2**20


def sized_for(input_bytes: int) -> dict[str, str]:
    """Scan and shuffle settings for an input of this many bytes, to pass to `get_spark`.

    The jobs shuffle a few narrow columns of the lines, about a tenth of the input. One shuffle partition per 5 GiB of
    input therefore holds about half a GiB, whatever the input's size, and sorts without much spilling; run-time re-planning merges
    partitions that turn out smaller. Scan tasks grow with very large inputs, to keep the number of map outputs in bounds.
    """
    partitions = max(input_bytes // (5 * GIB), 200)
    scan = max(input_bytes // 200_000 // MIB, 128)
    return {
        "spark__sql__shuffle__partitions": str(partitions),
        "spark__sql__files__maxPartitionBytes": f"{scan}m",
    }


def input_size(spark: SparkSession, path: str) -> int:
    """Bytes of the files at a path, as listed; 0 if there are none."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return files.agg(F.sum("length")).first()[0] or 0


def size_session(spark: SparkSession, *paths: str) -> int:
    """Apply `sized_for` the files at the paths to a running session; their size."""
    total = sum(input_size(spark, path) for path in paths)
    for key, value in sized_for(total).items():
        spark.conf.set(key.replace("__", "."), value)
    return total


def get_spark(app_name: str = "basketmill", master: str | None = None, **conf: str) -> SparkSession:
    """Create or get a session; `conf` keys use `__` for `.` and override the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): str(value) for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
