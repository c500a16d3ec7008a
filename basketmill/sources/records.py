"""Records of delimited text files, whose quoted fields may hold line breaks, though files are split between tasks.

A line's effect on "inside a quoted field" is a function of whether it begins inside one: it keeps, swaps or fixes that. These functions are
composed along the lines of each part of a file that a task reads, then along the parts of each file, and so tell of every line
whether it begins inside a quoted field. Only files in which a line ends inside one go through this.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketmill.operators.staging import stage, unstage

#: What ends a quoted field that has begun: its text with doubled quotes, the quote, and what is left before the comma.
_QUOTED_REST = r'[^"]*+(?:""[^"]*+)*+"[^,]*+'
#: Fields that begin and end in the line. A quote mark counts only where it is a field's first character, so that what has none is passed
#: over at once, whatever fields it is.
_FIELDS = rf'(?:[^"]*+(?:(?<![^,])"{_QUOTED_REST}|(?<=[^,])"[^,]*+))*+[^"]*+\z'
ENDS_CLOSED = rf"^{_FIELDS}"
CLOSES = rf"^{_QUOTED_REST}{_FIELDS}"
#: Torn files by name up to this number: files are then left out before they are read.
FEW_FILES = 1000


@dataclass(frozen=True)
class Records:
    """The header line, and a frame of the other records in the column `record`."""

    header: str
    frame: DataFrame


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Every line with its file, the start of the part of the file that it was read in, and a number that rises in such a part."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("id"),
        F.decode(F.col("value").cast("binary"), encoding).alias("line"),
    )


def _has_quote() -> Column:
    return F.contains("line", F.lit('"'))


def _ends_open() -> Column:
    """Whether a line that begins outside of quotes ends inside."""
    return _has_quote() & ~F.col("line").rlike(ENDS_CLOSED)


def _stays_open() -> Column:
    """Whether a line that begins inside of quotes ends inside."""
    return ~_has_quote() | ~F.col("line").rlike(CLOSES)


def read_records(spark: SparkSession, path: str, encoding: str) -> Records:
    """All records but blank ones of one or more files with the same header line.

    A file without that line, or with it a second time, is refused, and so is a file that ends inside a quoted field. A line break in a
    quoted field is a line feed in the record, however it was written.
    """
    lines = _lines(spark, path, encoding)
    first = lines.filter("part = 0").select("line").first()
    if first is None:
        return Records("", _filled(lines.select(F.col("line").alias("record"))))
    header = first["line"]
    is_header = F.col("line") == F.lit(header)
    counts = {"headers": F.count_if(is_header), "open_lines": F.count_if(_ends_open())}
    files = stage(lines.groupBy("file").agg(*[value.alias(name) for name, value in counts.items()]), "files")
    for wrong, message in (("headers = 0", "header does not conform to that of the other files"), ("headers > 1", "header is repeated")):
        refused = files.filter(wrong).select("file").first()
        if refused:
            raise ValueError(f"{refused['file']}: {message}")
    torn = files.filter("open_lines > 0").select("file")
    names = [row["file"] for row in torn.limit(FEW_FILES + 1).collect()]
    if not names:
        unstage(files)
        return Records(header, _filled(lines.filter(~is_header).select(F.col("line").alias("record"))))
    if len(names) <= FEW_FILES:
        in_torn = F.col("file").isin(names)
        whole, others = lines.filter(~in_torn), lines.filter(in_torn)
    else:
        whole, others = lines.join(torn, "file", "left_anti"), lines.join(torn, "file", "left_semi")
    rejoined = _rejoined(others.filter(~is_header))
    return Records(header, _filled(whole.filter(~is_header).select(F.col("line").alias("record")).unionByName(rejoined)))


def _filled(records: DataFrame) -> DataFrame:
    return records.filter(F.trim("record") != "")


def _rejoined(lines: DataFrame) -> DataFrame:
    """Records of files of which some lines end inside a quoted field."""
    # Written, so that the numbers of the lines are the same in all that follows.
    lines = stage(lines.withColumns({"from_outside": _ends_open().cast("int"), "from_inside": _stays_open().cast("int")}), "torn-files")
    along = Window.partitionBy("file", "part").orderBy("id")
    swaps = (F.col("from_outside") == 1) & (F.col("from_inside") == 0)
    fixes = F.col("from_outside") == F.col("from_inside")
    walked = lines.withColumn("swaps", F.sum(swaps.cast("int")).over(along) % 2)
    # The state that a line fixes, less the swaps before it: with the swaps up to a later line it is the state there.
    fixed = F.when(fixes, F.col("from_outside").bitwiseXOR(F.col("swaps").cast("int")))
    walked = walked.withColumn("fixed", F.last(fixed, ignorenulls=True).over(along))

    # The same along the parts of each file.
    along_file = Window.partitionBy("file").orderBy("part")
    parts = walked.groupBy("file", "part").agg(F.max_by("swaps", "id").alias("swaps"), F.max_by("fixed", "id").alias("fixed"))
    parts = parts.withColumn("all_swaps", F.sum("swaps").over(along_file) % 2)
    of_part = F.when(F.col("fixed").isNotNull(), _xor(F.col("fixed"), F.col("swaps"), F.col("all_swaps")))
    state = _xor(F.coalesce(F.last(of_part, ignorenulls=True).over(along_file), F.lit(0)), F.col("all_swaps"))
    parts = parts.withColumn("after", state).withColumn("incoming", F.lag("after", 1, 0).over(along_file))
    parts = stage(parts.select("file", "part", "incoming", "after"), "torn-parts")
    endless = parts.groupBy("file").agg(F.max_by("after", "part").alias("after")).filter("after = 1").first()
    if endless:
        raise ValueError(f"{endless['file']}: a quoted field has no end")

    walked = walked.join(parts.drop("after"), ["file", "part"])
    walked = walked.withColumn("after", _xor(F.coalesce("fixed", "incoming"), F.col("swaps")))
    walked = walked.withColumn("before", F.coalesce(F.lag("after").over(along), "incoming"))
    # A record is told by the part it begins in and its number there; lines before a part's first one belong to an earlier part's last.
    walked = walked.withColumn("number", F.sum((F.col("before") == 0).cast("bigint")).over(along))
    walked = walked.select("file", "part", "id", "line", "number", ((F.col("before") == 1) | (F.col("after") == 1)).alias("torn"))
    walked = stage(walked, "torn-lines", lines)
    begun = walked.groupBy("file", "part").agg(F.max("number").alias("begun"))
    earlier = along_file.rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("begun") > 0, F.struct(F.col("part").alias("part"), F.col("begun").alias("number"))), ignorenulls=True)
    begun = begun.withColumn("earlier", last.over(earlier)).drop("begun")
    own = F.struct("part", "number")
    keyed = walked.filter("torn").join(begun, ["file", "part"])
    keyed = keyed.withColumn("record_key", F.when(F.col("number") > 0, own).otherwise(F.col("earlier")))
    joined = keyed.groupBy("file", "record_key").agg(F.sort_array(F.collect_list(F.struct("part", "id", "line"))).alias("lines"))
    torn = joined.select(F.array_join("lines.line", "\n").alias("record"))
    return walked.filter("NOT torn").select(F.col("line").alias("record")).unionByName(torn)


def _xor(first: Column, *others: Column) -> Column:
    found = first.cast("int")
    for other in others:
        found = found.bitwiseXOR(other.cast("int"))
    return found
