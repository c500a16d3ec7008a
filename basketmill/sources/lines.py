"""The relations every job starts from."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmill.operators.cleaning import clean_lines

#: Name -> aggregate that can be combined from parts (sum, min, max), and the expression over line attributes that it is of.
Measures = Mapping[str, tuple[Callable[[Column], Column], Column]]
Keys = Mapping[str, Column]


def measured(lines: DataFrame, measures: Measures, keys: Keys) -> DataFrame:
    """Aggregates of expressions, per distinct values of the keys' expressions."""
    grouped = lines.groupBy(*[key.alias(name) for name, key in keys.items()])
    return grouped.agg(*[combine(value).alias(name) for name, (combine, value) in measures.items()])


def combined(parts: DataFrame, measures: Measures, keys: Keys) -> DataFrame:
    """Aggregates of parts that `measured` gave, per distinct values of the keys' expressions."""
    return measured(parts, {name: (combine, F.col(name)) for name, (combine, _) in measures.items()}, keys)


def summed_lines(detail: DataFrame, *keys: str) -> DataFrame:
    """Sum, number and last date of cleaned lines per distinct `keys`."""
    return detail.groupBy(*keys).agg(
        F.expr("sum(line_amount) AS spend"), F.expr("count(*) AS line_count"), F.expr("max(invoice_date) AS last_date")
    )


def added_up(sums: DataFrame, *keys: str) -> DataFrame:
    """Sums per finer keys, added up to `keys`."""
    return sums.groupBy(*keys).agg(
        F.expr("sum(spend) AS spend"), F.expr("sum(line_count) AS line_count"), F.expr("max(last_date) AS last_date")
    )


class LineSource:
    """Raw lines, cleaned lines, and sums of cleaned lines.

    Jobs name the columns they need, so that a source can leave out joins nobody asked for.
    """

    #: Whether all lines of an invoice number have the same invoice attributes.
    invoice_is_key = False

    def raw(self, *columns: str) -> DataFrame:
        raise NotImplementedError

    def detail(self, *columns: str) -> DataFrame:
        raise NotImplementedError

    def raw_by(self, measures: Measures, keys: Keys, *columns: str) -> DataFrame:
        """Aggregates of raw lines by expressions over invoice attributes; `columns` are those that either needs."""
        return measured(self.raw(*columns), measures, keys)

    def detail_by(self, measures: Measures, keys: Keys, *columns: str) -> DataFrame:
        """Aggregates of cleaned lines by expressions over invoice attributes; `columns` are those that either needs."""
        return measured(self.detail(*columns), measures, keys)

    def spend_by(self, *keys: str) -> DataFrame:
        """One row per distinct `keys` with `spend`, `line_count` and `last_date`; no keys: one row."""
        return summed_lines(self.detail(*keys, "line_amount", "invoice_date"), *keys)

    def product_lines(self, *columns: str) -> DataFrame:
        """product_key and other columns of the cleaned lines; the key is equal where the product texts are."""
        return self.detail("description", *columns).withColumnRenamed("description", "product_key")

    def product_invoices(self) -> DataFrame:
        """Every product_key on every invoice_no once."""
        return self.product_lines("invoice_no").distinct()

    def with_product(self, rows: DataFrame, name: str) -> DataFrame:
        """The product text in place of product_key, which stands for it before."""
        return rows.withColumnRenamed("product_key", name)

    def scored(self) -> DataFrame | None:
        """Stored measures and scores of the customers, if there are any."""
        return None


class FrameSource(LineSource):
    """Raw lines held in one frame; cleaned lines are derived from it unless given."""

    def __init__(self, raw: DataFrame, detail: DataFrame | None = None):
        self._raw = raw
        self._detail = clean_lines(raw) if detail is None else detail

    def raw(self, *columns: str) -> DataFrame:
        return self._raw.select(*columns)

    def detail(self, *columns: str) -> DataFrame:
        return self._detail.select(*dict.fromkeys(columns))
