"""Written intermediate tables that cut lineage and survive the loss of executors, and how long they stay."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


class Job:
    """What is to be undone when a job ends: folders to remove, and other steps."""

    def __init__(self, spark: SparkSession, outer: Job | None):
        self.spark = spark
        self.outer = outer
        self.folders: dict[str, None] = {}
        self.steps: list[Callable[[], object]] = []

    def keep(self, frame: DataFrame) -> DataFrame:
        """Let a staged frame outlive this job; it then ends with the job around it, or with the session."""
        folder = _folders.get(frame)
        if folder in self.folders:
            del self.folders[folder]
            if self.outer:
                self.outer.folders[folder] = None
        return frame

    def end(self) -> None:
        for step in self.steps:
            step()
        for folder in self.folders:
            remove_folder(self.spark, folder)


_job: ContextVar[Job | None] = ContextVar("job", default=None)
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"basketmill-{application}-")


def staging_folder(spark: SparkSession) -> str:
    """The shared folder of `spark.checkpoint.dir`; where that is unset, a temporary one, in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _local_folder(context.applicationId)
    return folder.rstrip("/")


def located(spark: SparkSession, folder: str):
    """The file system that a folder is on, and its path there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def remove_folder(spark: SparkSession, folder: str) -> None:
    files, path = located(spark, folder)
    files.delete(path, True)


def passing_folder(spark: SparkSession, folder: str) -> str:
    """Note that a folder, which must exist, is to be removed with the current job, at the latest with the session."""
    files, path = located(spark, folder)
    files.deleteOnExit(path)
    job = _job.get()
    if job:
        job.folders[folder] = None
    return folder


def at_job_end(step: Callable[[], object]) -> None:
    """Run a step when the current job ends; without one, never."""
    job = _job.get()
    if job:
        job.steps.append(step)


@contextmanager
def staging_job(spark: SparkSession) -> Iterator[Job]:
    """A job whose staged tables are removed at its end.

    Its results must have been written, collected or kept by then, as a frame reads staged tables only when it is run. What
    is staged outside of any job stays as long as the session.
    """
    job = Job(spark, _job.get())
    token = _job.set(job)
    try:
        yield job
    finally:
        _job.reset(token)
        job.end()


def stage(df: DataFrame, label: str, *used: DataFrame) -> DataFrame:
    """Write a frame once as parquet and read it back.

    `used` are staged frames that nothing needs but this one; they are removed once it is written.
    """
    spark = df.sparkSession
    path = f"{staging_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    _folders[found] = passing_folder(spark, path)
    for frame in used:
        unstage(frame)
    return found


def unstage(frame: DataFrame) -> None:
    """Remove a staged table that is needed no more; other frames are left alone."""
    folder = _folders.pop(frame, None)
    if folder:
        job = _job.get()
        if job:
            job.folders.pop(folder, None)
        remove_folder(frame.sparkSession, folder)
