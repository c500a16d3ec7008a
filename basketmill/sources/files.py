"""Invoice-line files."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketmill.functions.text import MISSING_TEXTS, null_if_missing
from basketmill.schema import FILE_COLUMNS, RAW_SCHEMA
from basketmill.sources.records import read_records

ENCODING = "ISO-8859-1"
RECORD = "_record"
READ = "_read"
PROBLEM = "_problem"
TOO_MANY = "too many fields"
TOO_FEW = "too few fields"
NO_NUMBER = "not a number"
NOT_WHOLE = "not a whole number"
TOO_FINE = "more decimals than are kept"
TOO_LARGE = "a number out of range"
#: What a job that fails says of a record with one of these problems.
MESSAGES = {TOO_MANY: "line with more fields than the header", TOO_FEW: "line with another number of fields than the header"}

#: Columns of numbers, and the decimals that each keeps.
DECIMALS = {"CustomerID": 0, "Quantity": 0, "UnitPrice": 4}
#: Holds every number in range exactly as it is written, if it has no more decimals than this.
WIDE = "decimal(38, 18)"
PLAIN = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)\s*$"
SCIENTIFIC = r"^\s*[+-]?(?:\d+\.?(\d*)|\.(\d+))[eE]([+-]?\d{1,3})\s*$"
#: A field that no file has, by which the fields before it are counted.
END = "\u0001"


def _common(name: str) -> str:
    """Pattern of nearly all numbers of a column; all of them are in range."""
    return rf"[+-]?\d{{1,8}}(?:\.\d{{0,{DECIMALS[name]}}}0{{0,8}})?"


def _number_problem(name: str) -> Column:
    """What keeps a column's text from being exactly a number of its type; NULL if nothing does."""
    text = null_if_missing(F.col(name))
    decimals = DECIMALS[name]
    plain, scientific = text.rlike(PLAIN), text.rlike(SCIENTIFIC)
    wide = text.try_cast(WIDE)
    value = wide.try_cast(RAW_SCHEMA[FILE_COLUMNS[name]].dataType)
    # Decided on the text, as a cast rounds. With an exponent, decimals are those written less the exponent.
    written = F.length(F.concat(F.regexp_extract(text, SCIENTIFIC, 1), F.regexp_extract(text, SCIENTIFIC, 2)))
    fits = written - F.regexp_extract(text, SCIENTIFIC, 3).try_cast("int") <= 18
    exact = F.when(plain, text.rlike(rf"^\s*[+-]?\d*\.?\d{{0,{decimals}}}0*\s*$")).otherwise(fits & (value == wide))
    common = text.rlike(rf"^{_common(name)}\z")
    fine = TOO_FINE if decimals else NOT_WHOLE
    problem = (
        F.when(~plain & ~scientific, NO_NUMBER)
        .when(~F.coalesce(exact, F.lit(False)), fine)
        .when(value.isNull(), TOO_LARGE)
    )
    return F.when(text.isNotNull() & ~F.coalesce(common, F.lit(False)), F.concat(problem, F.lit(f" in {name}")))


def _plain(header: list[str]) -> str:
    """Pattern of records that surely have no problem: the header's number of fields, and common numbers in their places."""
    end = r"(?=,|\z)"
    missing = "|".join(map(re.escape, MISSING_TEXTS))
    fields = []
    for name in header:
        if name in DECIMALS:
            number = rf"(?:{_common(name)}|{missing})"
            fields.append(rf'(?:{number}{end}|"{number}"{end})')
        else:
            fields.append(rf'(?:"[^"]*+(?:""[^"]*+)*+"{end}|[^",]*+{end})')
    return rf"^{','.join(fields)}\z"


@dataclass(frozen=True)
class Files:
    """The names in the header, and a frame of the other records in the column `record`."""

    header: list[str]
    records: DataFrame


def find_records(spark: SparkSession, path: str, encoding: str = ENCODING) -> Files:
    """Records of files. Both `lines_of` and `odd_lines_of` take them, so that files are looked through for torn records once."""
    records = read_records(spark, path, encoding)
    reader = spark.read.option("header", True).option("encoding", encoding).option("escape", '"')
    return Files(reader.csv(path).schema.names, records.frame)


def _parsed(header: list[str], records: DataFrame) -> DataFrame:
    """The columns of the header as text, the record as it is written, and the first problem with it."""
    options = {"escape": '"', "columnNameOfCorruptRecord": RECORD}

    def as_struct(record: Column, names: list[str]) -> Column:
        quoted = [f"`{name.replace('`', '``')}` STRING" for name in names]
        return F.from_csv(record, ", ".join(quoted), options)

    # The parser itself tells records that have another number of fields than the header.
    found = records.select("record", as_struct(F.col("record"), [*header, RECORD]).alias("fields"))
    found = found.select("fields.*", F.col("record").alias("_text"))
    # And of those, whether the end that is put behind them comes among the header's columns.
    places = [f"c{at}" for at in range(len(header) + 1)]
    counted = as_struct(F.concat(F.col("_text"), F.lit("," + END)), [*places, RECORD])
    ended = F.exists(F.array(*[counted[place] for place in places[:-1]]), lambda field: field == END)
    of_count = F.when(F.col(RECORD).isNotNull(), F.when(F.coalesce(ended, F.lit(False)), TOO_FEW).otherwise(TOO_MANY))
    # A number's problem is the graver one: a record with too few fields is filled up.
    of_numbers = [_number_problem(name) for name in DECIMALS if name in header]
    graver = F.when(of_count == TOO_MANY, of_count)
    found = found.withColumn(PROBLEM, F.coalesce(graver, *of_numbers, of_count))
    # No filter is moved below a number that is given out here, so each record is parsed once, and one that fails the job sees records only.
    return found.withColumn(READ, F.monotonically_increasing_id())


def _typed(name: str) -> Column:
    """A column in its type."""
    text = null_if_missing(F.col(name))
    target = RAW_SCHEMA[FILE_COLUMNS[name]].dataType
    value = text.try_cast(WIDE).cast(target) if name in DECIMALS else text.cast(target)
    return value.alias(FILE_COLUMNS[name])


def lines_of(
    files: Files,
    strict: bool = False,
    on_extra_fields: str = "raise",
    on_fine_price: str = "raise",
    on_bad_number: str = "raise",
) -> DataFrame:
    """Raw lines of one or more CSV files with a header row, from what `find_records` gives.

    Columns are found by name, whatever their order; files whose headers differ are refused. Columns beside the known ones follow
    as text, under the name they have in the file, with "_in_file" behind one that a known column has inside the engine.
    Quoted fields may hold line breaks, and files are split between tasks all the same.

    A line with too many fields fails the job, or is left out with `on_extra_fields="reject"`; one with too few is filled up
    with NULL, or fails the job if `strict`. Ids and quantities must be whole numbers, and a price may have four decimals; a line
    with another one fails the job or is left out with `on_bad_number="reject"`, and `on_fine_price="round"` rounds finer prices.
    `odd_lines` lists all such lines. This holds whichever columns are selected later.
    """
    lines = _parsed(files.header, files.records)
    problem = F.col(PROBLEM)
    if on_fine_price == "round":
        problem = F.when(~problem.startswith(TOO_FINE), problem)
    bad_number = problem.isNotNull() & ~problem.isin(TOO_MANY, TOO_FEW)
    refused = (problem == TOO_MANY) if on_extra_fields == "raise" or strict else F.lit(False)
    refused = refused | (bad_number if on_bad_number == "raise" else F.lit(False))
    # A record with too few fields and a bad number has the number's problem.
    refused = refused | (F.col(RECORD).isNotNull() if strict else F.lit(False))
    left_out = (problem == TOO_MANY) | bad_number
    says = F.when(F.lit(strict) & F.col(RECORD).isNotNull(), MESSAGES[TOO_FEW])
    for name, message in MESSAGES.items():
        says = says.when(problem == name, message)
    failure = F.raise_error(F.concat(says.otherwise(problem), F.lit(": "), F.col("_text"))).cast("boolean")
    kept = lines.filter((F.col(READ) >= 0) & F.when(F.coalesce(refused, F.lit(False)), failure).otherwise(~F.coalesce(left_out, F.lit(False))))
    known = set(FILE_COLUMNS.values())
    extra = [name for name in lines.columns if name not in FILE_COLUMNS and name not in (RECORD, PROBLEM, READ, "_text")]
    others = [null_if_missing(F.col(f"`{name}`")).alias(f"{name}_in_file" if name.lower() in known else name) for name in extra]
    return kept.select([_typed(name) for name in FILE_COLUMNS] + others)


def left_out(on_extra_fields: str = "raise", on_fine_price: str = "raise", on_bad_number: str = "raise", **_: object) -> Column:
    """Which of `odd_lines` are left out of what `read_invoice_csv` gives with the same options."""
    problem = F.col("problem")
    bad_number = ~problem.isin(TOO_MANY, TOO_FEW)
    if on_fine_price == "round":
        bad_number = bad_number & ~problem.startswith(TOO_FINE)
    found = (problem == TOO_MANY) if on_extra_fields == "reject" else F.lit(False)
    return found | bad_number if on_bad_number == "reject" else found


def odd_lines_of(files: Files) -> DataFrame:
    """(problem, record) of the lines that have more or fewer fields than the header, or a number that isn't kept exactly.

    One look at a record tells of nearly all that they are none of these; the parser decides on the others.
    """
    plain = F.col("record").rlike(_plain(files.header)) & ~F.contains("record", F.lit("\0"))
    lines = _parsed(files.header, files.records.filter(~plain))
    odd = lines.filter(F.col(PROBLEM).isNotNull() & (F.col(READ) >= 0))
    return odd.select(F.col(PROBLEM).alias("problem"), F.col("_text").alias("record"))


def read_invoice_csv(spark: SparkSession, path: str, encoding: str = ENCODING, **options) -> DataFrame:
    """`lines_of` files."""
    return lines_of(find_records(spark, path, encoding), **options)


def odd_lines(spark: SparkSession, path: str, encoding: str = ENCODING) -> DataFrame:
    """`odd_lines_of` files."""
    return odd_lines_of(find_records(spark, path, encoding))
