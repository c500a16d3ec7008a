"""File reading and cleaning rules."""

from __future__ import annotations

import random
from csv import reader as csv_reader
from csv import writer as csv_writer
from datetime import date, datetime
from decimal import Decimal

import pytest
from lines import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from basketmill.functions.calendar import DateFormat, date_format_of, parse_invoice_ts
from basketmill.functions.text import MISSING_TEXTS, normalise_product, null_if_missing
from basketmill.operators.cleaning import bad_date_lines, clean_lines, date_format
from basketmill.schema import DETAIL_SCHEMA, RAW_SCHEMA
from basketmill.sources import files, records
from basketmill.sources.files import odd_lines, read_invoice_csv

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
LINES = [
    "536365,85123A, white  mug ,6,12/1/2010 8:26,2.55,17850.0,France",
    "536366,22633,£5 caf\xe9 cup\xa0,2,1/9/2011 14:05,1.85,13047,NA",
    'C536367,22634,"say ""hi"", cup",-1,2/28/2011 0:00,4.25,13047,EIRE',
    "536368,22635,null,3,3/1/2011 23:59,0,13047,EIRE",
    "536369,22636,no customer,3,3/1/2011 23:59,1.00,,EIRE",
    "536370,22637,,1,,0.001,13047,EIRE",
]


def csv(tmp_path, lines):
    path = tmp_path / "lines.csv"
    path.write_bytes((HEADER + "\n".join(lines) + "\n").encode("latin-1"))
    return str(path)


def test_csv_types_missing_values_and_encoding(spark, tmp_path):
    raw = read_invoice_csv(spark, csv(tmp_path, LINES))
    assert [(f.name, f.dataType) for f in raw.schema] == [(f.name, f.dataType) for f in RAW_SCHEMA]
    found = {row["invoice_no"]: row for row in raw.collect()}
    assert found["536365"]["customer_id"] == 17850
    assert found["536366"]["description"] == "£5 café cup\xa0"
    assert found["536366"]["country"] is None
    assert found["C536367"]["description"] == 'say "hi", cup'
    assert found["C536367"]["quantity"] == -1
    assert found["536368"]["description"] is None
    assert found["536369"]["customer_id"] is None
    assert found["536370"]["invoice_date"] is None
    assert found["536370"]["unit_price"] == Decimal("0.0010")


def test_csv_columns_are_found_by_name(spark, tmp_path):
    swapped = HEADER.replace("Quantity,InvoiceDate", "InvoiceDate,Quantity")
    (tmp_path / "a.csv").write_text(swapped + "1,1,cup,12/1/2010 8:26,6,2.55,17850,France\n")
    assert read_invoice_csv(spark, str(tmp_path / "a.csv")).select("quantity").collect() == [(6,)]
    (tmp_path / "b.csv").write_text(HEADER + "2,1,cup,6,12/1/2010 8:26,2.55,17850,France\n")
    with pytest.raises(Exception, match="header does not conform"):
        read_invoice_csv(spark, str(tmp_path)).collect()


SHORT = "1,1,cup,6,12/1/2010 8:26,2.55,17850"
EXTRA = '1,1,"cup, ""big""",6,12/1/2010 8:26,2.55,17850,France,x'


def test_lines_with_too_few_fields_are_filled_and_listed(spark, tmp_path):
    path = csv(tmp_path, [LINES[0], SHORT])
    assert read_invoice_csv(spark, path).count() == 2
    assert read_invoice_csv(spark, path).filter("quantity = 6 AND customer_id = 17850").count() == 2
    assert rows(odd_lines(spark, path)) == [("too few fields", SHORT)]
    for columns in (["country"], ["quantity"], []):
        with pytest.raises(Exception, match="another number of fields"):
            read_invoice_csv(spark, path, strict=True).select(columns).collect()


def test_lines_with_too_many_fields_are_refused(spark, tmp_path):
    path = csv(tmp_path, [LINES[0], EXTRA, LINES[2]])
    for columns in (["country"], ["quantity"], []):
        with pytest.raises(Exception, match="more fields than the header"):
            read_invoice_csv(spark, path).select(columns).collect()
    with pytest.raises(Exception, match="more fields than the header"):
        read_invoice_csv(spark, path).count()
    kept = read_invoice_csv(spark, path, on_extra_fields="reject")
    assert sorted(row["invoice_no"] for row in kept.select("invoice_no").collect()) == ["536365", "C536367"]
    assert kept.count() == 2
    assert rows(odd_lines(spark, path)) == [("too many fields", EXTRA)]


def test_numbers_are_exact(spark, tmp_path):
    path = csv(tmp_path, ["1,1,cup,6.0,12/1/2010 8:26,2.55,9007199254740993,France"])
    row = read_invoice_csv(spark, path).collect()[0]
    assert (row["quantity"], row["customer_id"]) == (6, 9007199254740993)
    for line in ("1,1,cup,6.5,12/1/2010 8:26,2.55,1,France", "1,1,cup,6,12/1/2010 8:26,2.55,1.5,France"):
        with pytest.raises(Exception, match="not a whole number"):
            read_invoice_csv(spark, csv(tmp_path, [line])).collect()
    path = csv(tmp_path, ["1,1,cup,6,12/1/2010 8:26,0.00004,1,France"])
    with pytest.raises(Exception, match="more decimals"):
        read_invoice_csv(spark, path).collect()
    assert read_invoice_csv(spark, path, on_fine_price="round").collect()[0]["unit_price"] == Decimal("0.0000")


def test_clean_lines(spark, tmp_path):
    cleaned = clean_lines(read_invoice_csv(spark, csv(tmp_path, LINES)))
    assert [(f.name, f.dataType) for f in cleaned.schema] == [(f.name, f.dataType) for f in DETAIL_SCHEMA]
    found = {row["invoice_no"]: row for row in cleaned.collect()}
    assert set(found) == {"536365", "536366", "536370"}
    first = found["536365"]
    assert first["description"] == "WHITE  MUG"
    assert first["invoice_ts"] == datetime(2010, 12, 1, 8, 26)
    assert (first["invoice_date"], first["sale_month"], first["sale_hour"]) == (date(2010, 12, 1), date(2010, 12, 1), 8)
    assert first["line_amount"] == Decimal("15.3000")
    assert found["536366"]["description"] == "£5 CAFÉ CUP"
    assert found["536366"]["sale_month"] == date(2011, 1, 1)
    undated = found["536370"]
    assert (undated["description"], undated["invoice_date"], undated["sale_month"]) == (None, None, None)


def test_bad_dates(spark, tmp_path):
    bad = [*LINES, "536371,22637,cup,1,13/45/2011 9:00,1.00,13047,EIRE", "536372,22637,cup,1,soon,1.00,13047,EIRE"]
    raw = read_invoice_csv(spark, csv(tmp_path, bad))
    with pytest.raises(PySparkException, match="not a date"):
        clean_lines(raw).collect()
    lenient = clean_lines(raw, on_bad_date="null")
    assert lenient.count() == 5
    assert lenient.filter("invoice_date IS NULL").count() == 3
    assert {row["invoice_no"] for row in bad_date_lines(raw).collect()} == {"536371", "536372"}


def test_dedup_is_off_by_default(spark, tmp_path):
    raw = read_invoice_csv(spark, csv(tmp_path, [LINES[0], LINES[0]]))
    assert clean_lines(raw).count() == 2
    assert clean_lines(raw, dedup=True).count() == 1


def test_text_rules(spark):
    texts = ["\t a b \n", "\xa0x　", "\x1cy\x85", "straße", "", None]
    df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, t string")
    found = [row[0] for row in df.orderBy("i").select(normalise_product(F.col("t"))).collect()]
    assert found == [text.strip().upper() if text is not None else None for text in texts]
    missing = spark.createDataFrame([(text,) for text in MISSING_TEXTS], "t string")
    assert rows(missing.select(null_if_missing(F.col("t"))).distinct()) == [(None,)]
    kept = spark.createDataFrame([("na",), ("NA ",), ("0",)], "t string")
    assert rows(kept.select(null_if_missing(F.col("t")))) == [("na",), ("NA ",), ("0",)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("12/1/2010 8:26", datetime(2010, 12, 1, 8, 26)),
        ("1/9/2011 14:05", datetime(2011, 1, 9, 14, 5)),
        ("1/9/2011 14:05:07", datetime(2011, 1, 9, 14, 5, 7)),
        ("01/09/2011", datetime(2011, 1, 9)),
        ("2011-01-09 14:05:07", datetime(2011, 1, 9, 14, 5, 7)),
        ("2011-01-09", datetime(2011, 1, 9)),
        ("31/1/2011 9:00", None),
        ("soon", None),
        (None, None),
    ],
)
def test_parse_invoice_ts(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_invoice_ts(F.col("t"))).collect()[0][0] == expected


def test_times_do_not_depend_on_the_session_zone(spark, tmp_path):
    # 02:30 did not exist on this day in New York.
    lines = ["1,1,cup,1,3/13/2011 2:30,1.00,1,USA"]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = clean_lines(read_invoice_csv(spark, csv(tmp_path, lines))).select("invoice_date", "sale_hour").collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == (date(2011, 3, 13), 2)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("1/2/2011 8:26:30 PM", datetime(2011, 1, 2, 20, 26, 30)),
        ("1/2/2011 12:05 am", datetime(2011, 1, 2, 0, 5)),
        ("13/2/2011 12:05 p.m.", datetime(2011, 2, 13, 12, 5)),
        ("1/2/2011 13:05 PM", None),
        ("1/2/2011 0:05 PM", None),
        ("31.12.2010 23:59", datetime(2010, 12, 31, 23, 59)),
        ("31/1/11", datetime(2011, 1, 31)),
        ("1/31/69", datetime(1969, 1, 31)),
        ("1/31/68 9:00 AM", datetime(2068, 1, 31, 9)),
        ("1-31/2011", None),
        ("2011/1/9 14:05:07.250", datetime(2011, 1, 9, 14, 5, 7, 250000)),
        ("2011-01-09T14:05:07", datetime(2011, 1, 9, 14, 5, 7)),
        ("9 Jan 2011 2:05 PM", datetime(2011, 1, 9, 14, 5)),
        ("9-SEPT-2011", datetime(2011, 9, 9)),
        ("Sunday, January 9, 2011 8:00", datetime(2011, 1, 9, 8)),
        ("Smarch 9, 2011", None),
        ("2/29/2011", None),
    ],
)
def test_date_formats(spark, text, expected):
    """Each text in the format that it has itself."""
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_invoice_ts(F.col("t"), date_format_of([text]))).collect()[0][0] == expected


def test_one_date_format_is_told_by_a_sample_and_checked_on_all_lines(spark, tmp_path):
    line = "{0},1,cup,1,{1},1.00,1,USA"
    cases = {
        DateFormat(twelve_hours=True): ["1/2/2011 8:26:30 PM", "1/3/2011 9:00:00 AM"],
        DateFormat("day first"): ["1/2/2011 9:00", "13/2/2011 9:00", "28/2/2011 9:00"],
        DateFormat("named month"): ["1 Feb 2011", "Wed, 2 March 2011 9:00"],
    }
    for expected, dates in cases.items():
        raw = read_invoice_csv(spark, csv(tmp_path, [line.format(at, f'"{date}"') for at, date in enumerate(dates)]))
        told = date_format(raw)
        assert told == expected
        assert clean_lines(raw, format_=told).filter("invoice_ts IS NULL").count() == 0
    mixed = ["1/2/2011 9:00", "13/2/2011 9:00", "28/2/2011 9:00", "2/13/2011"]
    mixed = read_invoice_csv(spark, csv(tmp_path, [line.format(at, date) for at, date in enumerate(mixed)]))
    with pytest.raises(PySparkException, match="not a date: 2/13/2011"):
        clean_lines(mixed, format_=date_format(mixed)).collect()
    assert rows(bad_date_lines(mixed, date_format(mixed)).select("invoice_no")) == [("3",)]


LOST = '1,S,PLATE 12" A,6,1/2/2011 8:26,2.5,17850,UK 5",LOST'
FINE = "1,S,cup,6,1/2/2011 8:26,0.00000000004,17850,UK"
PARTLY = "1,S,cup,6.00000000004,1/2/2011 8:26,2.5,17850,UK"


@pytest.mark.parametrize(
    ("line", "problem"),
    [
        (LOST, "too many fields"),
        (LINES[0] + ",", "too many fields"),
        (LINES[0] + ",,,", "too many fields"),
        ('1,S,"a ""b"", c",6,1/2/2011 8:26,2.5,17850,UK,"x,y"', "too many fields"),
        (FINE, "more decimals than are kept in UnitPrice"),
        ("1,S,cup,6,1/2/2011 8:26,4e-11,17850,UK", "more decimals than are kept in UnitPrice"),
        ("1,S,cup,6,1/2/2011 8:26,4e-30,17850,UK", "more decimals than are kept in UnitPrice"),
        (PARTLY, "not a whole number in Quantity"),
        ("1,S,cup,six,1/2/2011 8:26,2.5,17850,UK", "not a number in Quantity"),
        ("1,S,cup,3000000000,1/2/2011 8:26,2.5,17850,UK", "a number out of range in Quantity"),
        ("1,S,cup,6,1/2/2011 8:26,2.5,17850." + "0" * 20 + "1,UK", "not a whole number in CustomerID"),
        ("1,S,cup", "too few fields"),
        ('1,"S,cup', None),  # joined with what follows
    ],
)
def test_nothing_is_cut_or_rounded_silently(spark, tmp_path, line, problem):
    if problem is None:
        with pytest.raises(ValueError, match="quoted field has no end"):
            read_invoice_csv(spark, csv(tmp_path, [LINES[0], line]))
        return
    path = csv(tmp_path, [LINES[0], line, LINES[2]])
    assert rows(odd_lines(spark, path)) == [(problem, line)]
    if problem == "too few fields":
        assert read_invoice_csv(spark, path).count() == 3
        return
    for columns in (["country"], ["quantity"], []):
        with pytest.raises(PySparkException, match="more fields than" if "fields" in problem else problem):
            read_invoice_csv(spark, path).select(columns).collect()
    kept = read_invoice_csv(spark, path, on_extra_fields="reject", on_bad_number="reject")
    assert sorted(row["invoice_no"] for row in kept.collect()) == ["536365", "C536367"]


def test_long_prices_are_out_of_range(spark, tmp_path):
    """Digits beyond the eighth before the point, without a point, are no decimals."""
    line = "1,S,cup,6,1/2/2011 8:26,123456781234,17850,UK"
    path = csv(tmp_path, [LINES[0], line])
    assert rows(odd_lines(spark, path)) == [("a number out of range in UnitPrice", line)]
    assert read_invoice_csv(spark, path, on_bad_number="reject").count() == 1


def test_only_records_that_may_be_odd_are_parsed_for_odd_lines(spark, tmp_path):
    plan = odd_lines(spark, csv(tmp_path, LINES))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan.split("from_csv")[-1]  # the scan's side


def test_plain_records_have_no_problem(spark):
    rng = random.Random(5)
    header = HEADER.strip().split(",")
    odd = ['"', ",", "", "a", '"a"', '""', '"a""b, c"', '"a"b', 'a"b"', "NA", "6", '"6.0"', "6.00", "1.23456", "+7", "-1.#IND", "1e3", "\t", "\0", "\\", '"\\"']
    odd += [" 6", "123456789", "12345678", "12345678.1234", "123456781234", "6.", ".5", "#x", '"\n"', "\u00a0"]
    drawn = {",".join(rng.choices(odd, k=rng.choice([8, 8, 8, 7, 9]))) for _ in range(4000)}
    sure = ["1", "S", '"a ""b"", c"', "6.0", "1/2/2011 8:26", "2.50", "NA", "UK"]
    for _ in range(4000):
        fields = list(sure)
        for at in rng.sample(range(8), rng.randint(0, 2)):
            fields[at] = rng.choice(odd)
        drawn.add(",".join(fields))
    frame = spark.createDataFrame([(record,) for record in sorted(drawn) if record.strip()], "record string")
    plain = F.col("_text").rlike(files._plain(header)) & ~F.contains("_text", F.lit("\0"))
    found = rows(files._parsed(header, frame).select(plain, files.PROBLEM, "_text"))
    assert [row for row in found if row[0] and row[1]] == []
    assert sum(row[0] for row in found) > 500


@pytest.mark.parametrize("half", ["AM", "pm", "P.M."])
def test_hours_of_half_days(spark, half):
    late = 12 * half.lower().startswith("p")
    texts = [f"1/2/2011 {hour}:05:09 {half}" for hour in range(14)] + [f"1/2/2011 08:05:09{half}", "1/2/2011 8:05:09", f"1/2/2011\u00018:05 {half}", "1/2/2011 8:05:09\u0001p"]
    expected = [None if hour in (0, 13) else datetime(2011, 1, 2, hour % 12 + late, 5, 9) for hour in range(14)]
    df = spark.createDataFrame([(at, text) for at, text in enumerate(texts)], "at int, t string")
    found = df.select("at", parse_invoice_ts(F.col("t"), DateFormat(twelve_hours=True))).orderBy("at")
    assert [row[1] for row in found.collect()] == [*expected, datetime(2011, 1, 2, 8 + late, 5, 9), None, None, None]


def test_patterns_of_dates_are_few(spark, tmp_path):
    """The pattern of half days is looked for in one place, but for what the engine finds to be the same."""
    raw = read_invoice_csv(spark, csv(tmp_path, LINES))
    plan = clean_lines(raw, format_=DateFormat(twelve_hours=True))._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("0?[1-9]|1[0-2]") <= 4


def test_numbers_as_they_may_be_written(spark, tmp_path):
    path = csv(tmp_path, ["1,S,cup, +6. ,1/2/2011 8:26,.5,1.785e4,UK", "2,S,cup,6e0,1/2/2011 8:26,25000E-4,17850.000,UK"])
    found = read_invoice_csv(spark, path).orderBy("invoice_no").select("quantity", "unit_price", "customer_id")
    assert rows(found) == [(6, Decimal("0.5000"), 17850), (6, Decimal("2.5000"), 17850)]


def test_columns_beside_the_known_ones_are_kept(spark, tmp_path):
    header = HEADER.strip() + ",Channel,quantity_,invoice_no\n"
    (tmp_path / "more.csv").write_text(header + LINES[0] + ",web,NA,x\n")
    raw = read_invoice_csv(spark, str(tmp_path / "more.csv"))
    assert raw.columns == [*RAW_SCHEMA.names, "Channel", "quantity_", "invoice_no_in_file"]
    row = clean_lines(raw).first()
    assert (row["Channel"], row["quantity_"], row["invoice_no_in_file"], row["invoice_no"]) == ("web", None, "x", "536365")


@pytest.fixture
def small_parts(spark):
    """Files are split into parts of a few lines."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quoted_line_breaks_in_split_files(spark, tmp_path, small_parts):
    """Texts with quotes, commas and line breaks, some longer than several parts of the file, against the standard reader."""
    rng = random.Random(4)
    pieces = ["cup", "\n", '"', ",", "\n\n", "12\" plate", " ", "x" * 30, "\n".join("abc,\"d" for _ in range(100))]
    texts = ["".join(rng.choices(pieces, weights=[4, 3, 2, 2, 1, 1, 2, 1, 0.3], k=rng.randint(1, 6))) for _ in range(60)]
    for name, share in (("a.csv", texts[:50]), ("b.csv", texts[50:]), ("c.csv", ["plain"] * 5)):
        with (tmp_path / name).open("w", newline="") as file:
            writer = csv_writer(file, lineterminator="\n")
            writer.writerow(HEADER.strip().split(","))
            writer.writerows([f"{name}{at}", "S", text, 1, "1/2/2011 8:26", "2.5", 1, "UK"] for at, text in enumerate(share))
    raw = read_invoice_csv(spark, str(tmp_path))
    assert raw.rdd.getNumPartitions() > 4
    found = dict(rows(raw.select("invoice_no", "description")))
    expected = {}
    for name in ("a.csv", "b.csv", "c.csv"):
        with (tmp_path / name).open(newline="") as file:
            expected |= {row[0]: row[2] for row in list(csv_reader(file))[1:]}
    assert found == expected
    assert raw.count() == len(expected) and odd_lines(spark, str(tmp_path)).count() == 0


def test_few_torn_files_are_left_out_by_name(spark, tmp_path, monkeypatch):
    """Whole files and torn ones are told apart before they are read, and by a join where there are very many."""
    (tmp_path / "whole.csv").write_text(HEADER + "1,S,cup,6,1/2/2011 8:26,2.5,1,UK\n")
    (tmp_path / "torn.csv").write_text(HEADER + '2,S,"a\nb",6,1/2/2011 8:26,2.5,1,UK\n')
    for few in (records.FEW_FILES, 0):
        monkeypatch.setattr("basketmill.sources.records.FEW_FILES", few)
        raw = read_invoice_csv(spark, str(tmp_path))
        assert sorted(rows(raw.select("invoice_no", "description"))) == [("1", "cup"), ("2", "a\nb")]
        # The other join is that of the parts of torn files.
        assert ("LeftAnti" in raw._jdf.queryExecution().optimizedPlan().toString()) == (few == 0)


def test_headers_of_all_files_are_checked(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + LINES[0] + "\n" + HEADER + LINES[0] + "\n")
    with pytest.raises(ValueError, match="header is repeated"):
        read_invoice_csv(spark, str(tmp_path))
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "a.csv").write_text(HEADER + "\n  \n")
    assert read_invoice_csv(spark, str(tmp_path)).count() == 0
