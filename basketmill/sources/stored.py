"""Lines whose sums were written as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketmill.operators.staging import stage
from basketmill.schema import INVOICE_COLUMNS
from basketmill.sources.lines import Keys, LineSource, Measures, added_up

CUSTOMER_MONTH = ("customer_id", "sale_month")
SUMS = ("spend", "line_count", "last_date")


class StoredSource(LineSource):
    """Starts sums from the smallest stored table that holds their keys, instead of from lines.

    `customer_months` has sums per customer and month, `customers` what `rfm.scored_customers` gives.
    """

    def __init__(
        self, lines: LineSource, invoices: DataFrame, customer_months: DataFrame | None = None, customers: DataFrame | None = None
    ):
        self._lines = lines
        self._invoices = invoices
        self._customer_months = customer_months
        self._customers = customers

    def raw(self, *columns: str) -> DataFrame:
        return self._lines.raw(*columns)

    def detail(self, *columns: str) -> DataFrame:
        return self._lines.detail(*columns)

    def raw_by(self, measures: Measures, keys: Keys, *columns: str) -> DataFrame:
        return self._lines.raw_by(measures, keys, *columns)

    def detail_by(self, measures: Measures, keys: Keys, *columns: str) -> DataFrame:
        return self._lines.detail_by(measures, keys, *columns)

    def spend_by(self, *keys: str) -> DataFrame:
        if self._customer_months is not None and set(keys) <= set(CUSTOMER_MONTH):
            if set(keys) == set(CUSTOMER_MONTH):
                return self._customer_months.select(*keys, *SUMS)
            return added_up(self._customer_months, *keys)
        if not set(keys) <= set(INVOICE_COLUMNS) & set(self._invoices.columns):
            return self._lines.spend_by(*keys)
        if "invoice_no" in keys and self._lines.invoice_is_key:
            return self._invoices.select(*keys, *SUMS)
        return added_up(self._invoices, *keys)

    def product_lines(self, *columns: str) -> DataFrame:
        return self._lines.product_lines(*columns)

    def product_invoices(self) -> DataFrame:
        return self._lines.product_invoices()

    def with_product(self, rows: DataFrame, name: str) -> DataFrame:
        return self._lines.with_product(rows, name)

    def scored(self) -> DataFrame | None:
        return self._customers


def with_staged_invoices(lines: LineSource, *columns: str) -> StoredSource:
    """Write the invoice sums of a source once, for running many jobs over it.

    Of the invoice attributes only the named ones are written, all if none is named.
    """
    return StoredSource(lines, stage(lines.spend_by(*(columns or INVOICE_COLUMNS)), "invoices"))
