"""Stored layers: raw lines, cleaned lines, sums per invoice and per customer, and result tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketmill.operators.cleaning import clean_lines, date_format
from basketmill.operators.staging import located, remove_folder, staging_job
from basketmill.plans.layers import published
from basketmill.plans.registry import RESULT_TABLES, STORED_RESULTS, Job
from basketmill.plans.rfm import scored_customers
from basketmill.schema import (
    CUSTOMER_MONTH_TABLE,
    CUSTOMER_TABLE,
    DETAIL_TABLE,
    INVOICE_COLUMNS,
    INVOICE_TABLE,
    RAW_TABLE,
    REJECT_TABLE,
    RESULT_COLUMNS,
    RESULT_ORDER,
    RESULT_PREFIX,
)
from basketmill.sources.files import ENCODING, find_records, left_out, lines_of, odd_lines_of
from basketmill.sources.lines import FrameSource, LineSource
from basketmill.sources.stored import CUSTOMER_MONTH, StoredSource

#: Bucketed tables, and the column of the buckets.
BUCKETED = {CUSTOMER_MONTH_TABLE: "customer_id"}

#: Name of the file that tells that a version of a table is complete, and its number of buckets, 0 for none.
COMPLETE = "_complete-"
#: Result tables that are built at the same time.
AT_ONCE = 3


class Warehouse:
    """Tables of one database, each rebuilt as a whole.

    With a `location` the tables are parquet folders below it, which a later session can attach;
    otherwise they live in the session's warehouse directory. A rebuilt table takes the place of the
    old one once it is written in full; if writing fails, the old one stays. At a location the version before
    stays as well, for jobs that still read it; the ones before that are removed.
    """

    def __init__(self, spark: SparkSession, database: str = "default", location: str | None = None):
        self.spark = spark
        self.database = database
        self.location = location.rstrip("/") if location else None

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def write(self, df: DataFrame, table: str, partition_by: str | None = None, bucket_by: str | None = None) -> int:
        """Replace a table and return its number of rows, counted while it is written.

        A bucketed table has one file for each bucket, sorted, so that jobs which group by that column need no shuffle. It is for
        columns of which no value is on very many rows.
        """
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions")) if bucket_by else 0
        if partition_by:
            # One or a few files per partition value; a value with very many rows is split further.
            df = df.hint("rebalance", partition_by)
        elif bucket_by:
            df = df.repartition(buckets, bucket_by)
        rows = Observation()
        writer = df.observe(rows, F.count("*").alias("rows")).write.format("parquet")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        if bucket_by:
            writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
        fresh = f"{self.name(table)}_{uuid.uuid4().hex}"
        if self.location:
            version, before = time.time_ns(), self._versions(table)
            folder = self._folder(table, version)
            if bucket_by:  # only the catalog's tables can have buckets
                writer.option("path", folder).saveAsTable(fresh)
                self.spark.sql(f"DROP TABLE {fresh}")
            else:
                writer.save(folder)
            files, done = located(self.spark, f"{folder}/{COMPLETE}{buckets}")
            files.createNewFile(done)
            self._point(table, version, buckets, None if partition_by else df.schema, bucket_by)
            for old in list(before)[:-1]:
                remove_folder(self.spark, self._folder(table, old))
        else:
            writer.saveAsTable(fresh)
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
            self.spark.sql(f"ALTER TABLE {fresh} RENAME TO {self.name(table)}")
            if partition_by:  # the catalog looks for them where they were written
                self.spark.sql(f"MSCK REPAIR TABLE {self.name(table)} SYNC PARTITIONS")
        return rows.get.get("rows", 0)

    def _folder(self, table: str, version: int) -> str:
        return f"{self.location}/{table}/{version}"

    def _versions(self, table: str) -> dict[int, int]:
        """Complete versions below the location, oldest first, and their number of buckets."""
        files, found = located(self.spark, f"{self.location}/{table}/*/{COMPLETE}*")
        marks = [mark.getPath() for mark in files.globStatus(found) or []]
        return dict(sorted((int(mark.getParent().getName()), int(mark.getName().removeprefix(COMPLETE))) for mark in marks))

    def _point(self, table: str, version: int, buckets: int = 0, schema: StructType | None = None, bucket_by: str | None = None) -> None:
        """Let the catalog's table be a version below the location; no data is dropped."""
        name, folder = self.name(table), self._folder(table, version)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        if buckets:
            columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
            spec = f"CLUSTERED BY ({bucket_by}) SORTED BY ({bucket_by}) INTO {buckets} BUCKETS"
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {spec} LOCATION '{folder}'")
            return
        self.spark.catalog.createTable(name, folder, "parquet", schema)
        if schema is None and any(column.isPartition for column in self.spark.catalog.listColumns(name)):
            self.spark.catalog.recoverPartitions(name)

    def _attach(self, table: str) -> bool:
        """Register a table that an earlier session wrote below the location."""
        versions = self._versions(table) if self.location else {}
        if versions:
            version, buckets = list(versions.items())[-1]
            schema = self.spark.read.parquet(self._folder(table, version)).schema if buckets else None
            self._point(table, version, buckets, schema, BUCKETED.get(table))
        return bool(versions)

    def has(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table)) or self._attach(table)

    def table(self, table: str) -> DataFrame:
        """A stored table; an error that names it if it was never built."""
        if not self.has(table):
            raise LookupError(f"table {self.name(table)} does not exist; build it first")
        return self.spark.table(self.name(table))

    def build_ods(self, csv_path: str, encoding: str = ENCODING, **options) -> int:
        """Load invoice-line files into the raw table; lines that options leave out go to a table of their own, with what is wrong."""
        with staging_job(self.spark):
            files = find_records(self.spark, csv_path, encoding)
            if "reject" in options.values():
                self.write(odd_lines_of(files).filter(left_out(**options)), REJECT_TABLE)
            return self.write(lines_of(files, **options), RAW_TABLE)

    def build_dwd(self, on_bad_date: str = "raise", dedup: bool = False, by_month: bool = False, sums: bool = True) -> int:
        """Clean the raw table into the detail table and store the sums that jobs start from, unless only lines are asked for.

        `by_month` partitions the detail table by month, for data with many gigabytes per month.
        """
        raw = self.table(RAW_TABLE)
        cleaned = clean_lines(raw, on_bad_date, dedup, date_format(raw))
        rows = self.write(cleaned, DETAIL_TABLE, partition_by="sale_month" if by_month else None)
        if sums:
            self.build_dws(FrameSource(raw, self.table(DETAIL_TABLE)))
        return rows

    def build_dws(self, lines: LineSource, *invoice_columns: str) -> LineSource:
        """Store sums per invoice, per customer and month, and each customer's measures and scores; lines with these tables as source.

        Of the invoice attributes only the named ones are stored, all if none is named.
        """
        self.write(lines.spend_by(*(invoice_columns or INVOICE_COLUMNS)), INVOICE_TABLE)
        sums = StoredSource(lines, self.table(INVOICE_TABLE))
        # A customer has a row for each month at most, so that no bucket has a hot key.
        self.write(sums.spend_by(*CUSTOMER_MONTH), CUSTOMER_MONTH_TABLE, bucket_by=BUCKETED[CUSTOMER_MONTH_TABLE])
        with staging_job(self.spark):
            self.write(scored_customers(sums), CUSTOMER_TABLE)
        return self._stored(lines)

    def _stored(self, lines: LineSource) -> LineSource:
        found = [self.table(name) if self.has(name) else None for name in (CUSTOMER_MONTH_TABLE, CUSTOMER_TABLE)]
        return StoredSource(lines, self.table(INVOICE_TABLE), *found)

    def source(self) -> LineSource:
        """The stored layers as input for the jobs."""
        lines = FrameSource(self.table(RAW_TABLE), self.table(DETAIL_TABLE))
        return self._stored(lines) if self.has(INVOICE_TABLE) else lines

    def build_ads(self, source: LineSource | None = None, jobs: Mapping[str, Job] = RESULT_TABLES) -> dict[str, int]:
        """Run every job, replace its result table, and report the rows of each. Some jobs run at the same time."""
        source = source or self.source()

        def build(table: str) -> int:
            with staging_job(self.spark):
                return self.write(jobs[table](source).select(RESULT_COLUMNS[table]), table)

        with ThreadPoolExecutor(AT_ONCE) as pool:
            return dict(zip(jobs, pool.map(build, jobs), strict=True))

    def result(self, name: str) -> DataFrame:
        """A built result table in its order, or one of `STORED_RESULTS`, made from a built table without reading any line."""
        if name in STORED_RESULTS:
            table, made = STORED_RESULTS[name]
            return made(self.table(table))
        order = [F.desc(column[1:]) if column[0] == "-" else F.asc(column) for column in RESULT_ORDER[name]]
        return self.table(name).orderBy(*order)

    def register_views(self, raw_view: str, detail_view: str) -> None:
        """Temporary views of both layers under the column names of the source file, for SQL of one's own."""
        published(self.table(RAW_TABLE)).createOrReplaceTempView(raw_view)
        published(self.table(DETAIL_TABLE)).createOrReplaceTempView(detail_view)

    def tables(self, prefix: str = "") -> DataFrame:
        """Table names in order, optionally only those with a prefix."""
        listed = self.spark.sql(f"SHOW TABLES IN {self.database}").filter(~F.col("isTemporary"))
        return listed.select(F.col("tableName").alias("name")).filter(F.col("name").startswith(prefix)).orderBy("name")

    def result_tables(self) -> DataFrame:
        return self.tables(RESULT_PREFIX)
