"""Raw invoice lines -> cleaned invoice lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmill.functions.calendar import DateFormat, date_format_of, parse_invoice_ts
from basketmill.functions.text import normalise_product
from basketmill.schema import DETAIL_COLUMNS

HAS_CUSTOMER = "customer_id IS NOT NULL"
HAS_POSITIVE_MEASURES = "quantity > 0 AND unit_price > 0"
IS_KEPT = f"{HAS_CUSTOMER} AND {HAS_POSITIVE_MEASURES}"
LINE_AMOUNT = "quantity * unit_price"

# The date, the first day of its month (a month key that sorts, groups and subtracts as a plain
# date), and the hour of day. None of them depends on the session time zone.
DATE_COLUMNS = {
    "invoice_date": "CAST(invoice_ts AS DATE)",
    "sale_month": "trunc(CAST(invoice_ts AS DATE), 'month')",
    "sale_hour": "hour(invoice_ts)",
}


#: Dates by which their format is told.
DATE_SAMPLE = 1000


def date_format(raw: DataFrame, sample: int = DATE_SAMPLE) -> DateFormat:
    """The one format of the dates, told by a bounded sample of the lines that are kept; all lines are held against it later."""
    dates = raw.filter(IS_KEPT).filter("invoice_date IS NOT NULL").select("invoice_date").limit(sample)
    return date_format_of([row["invoice_date"] for row in dates.collect()])


def with_invoice_ts(raw: DataFrame, on_bad_date: str = "raise", format_: DateFormat = DateFormat()) -> DataFrame:
    """Parse the date text of a raw line.

    A text that is no date in the given format fails the job ("raise"), or keeps the line with a NULL date ("null").
    A missing text is always a NULL date.
    """
    text = F.col("invoice_date")
    ts = parse_invoice_ts(text, format_)
    if on_bad_date == "raise":
        failure = F.raise_error(F.concat(F.lit("not a date: "), text)).cast("timestamp_ntz")
        ts = F.coalesce(ts, F.when(text.isNotNull(), failure))  # the date is parsed in one place
    return raw.withColumn("invoice_ts", ts)


def clean_lines(
    raw: DataFrame, on_bad_date: str = "raise", dedup: bool = False, format_: DateFormat = DateFormat()
) -> DataFrame:
    """Lines with a customer and a positive quantity and price, with normalised and derived columns; columns of the file's own follow."""
    derived = {name: F.expr(value) for name, value in DATE_COLUMNS.items()} | {
        "description": normalise_product(F.col("description")),
        "line_amount": F.expr(LINE_AMOUNT),
    }
    extra = [name for name in raw.columns if name not in DETAIL_COLUMNS]
    cleaned = with_invoice_ts(raw.filter(IS_KEPT), on_bad_date, format_).withColumns(derived)
    cleaned = cleaned.select(*DETAIL_COLUMNS, *[F.col(f"`{name}`") for name in extra])
    return cleaned.dropDuplicates() if dedup else cleaned


def bad_date_lines(raw: DataFrame, format_: DateFormat = DateFormat()) -> DataFrame:
    """Kept lines of a raw file whose date text is present but is no date in the given format."""
    text = F.col("invoice_date")
    return raw.filter(IS_KEPT).filter(text.isNotNull() & parse_invoice_ts(text, format_).isNull())
