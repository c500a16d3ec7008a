"""Invoice lines assembled from the star schema lineitem, orders, part, customer and nation.

The mapping adds the kinds of bad rows the cleaning step is there for: returns with a negative
quantity, lines without a price, invoices without a customer and untrimmed product texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketmill.functions.text import normalise_product
from basketmill.operators.cleaning import DATE_COLUMNS, HAS_CUSTOMER, HAS_POSITIVE_MEASURES, LINE_AMOUNT
from basketmill.schema import INVOICE_COLUMNS, PRICE_TYPE
from basketmill.sources.lines import Keys, LineSource, Measures, added_up, combined, measured

# Columns read from each table. Stating them saves the job that would look them up in the files.
TABLE_COLUMNS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_returnflag string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_retailprice double",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint",
}

# Line items; a return has a negative quantity.
ITEMS = [
    "l_orderkey AS order_key",
    "l_partkey AS part_key",
    "coalesce(l_returnflag = 'R', false) AS returned",
    "CAST(if(l_returnflag = 'R', -abs(l_quantity), l_quantity) AS INT) AS quantity",
]
# Products; every 97th has no price. The scaling spreads invoices over all price bands.
PRICE = f"CAST(if(p_partkey % 97 = 0, 0, CAST(p_retailprice AS DECIMAL(12, 2)) * 0.01BD) AS {PRICE_TYPE.simpleString()})"
PARTS = ["p_partkey AS part_key", "concat('  ', p_name, ' ') AS description", f"{PRICE} AS unit_price"]
# Invoice headers; every 7th has no customer.
HEADERS = [
    "o_orderkey AS order_key",
    "o_custkey AS cust_key",
    "if(o_orderkey % 7 = 0, NULL, o_custkey) AS customer_id",
    "o_orderdate AS invoice_ts",
]
LINE_KEYS = {
    "invoice_no": "if(returned, concat('C', order_key), CAST(order_key AS STRING)) AS invoice_no",
    "stock_code": "CAST(part_key AS STRING) AS stock_code",
}

# What kept lines and headers have in common, as filters that the files' statistics can be held against.
KEPT_ITEMS = "l_quantity > 0 AND (l_returnflag IS NULL OR l_returnflag <> 'R')"
KEPT_PARTS = "p_retailprice > 0"
KEPT_ORDERS = "o_custkey IS NOT NULL"

PRODUCT_COLUMNS = {"description", "unit_price"}
HEADER_COLUMNS = {"customer_id", "country", "invoice_ts", "invoice_date"}


def _measured_orders(items: DataFrame, measures: Measures, columns: set[str]) -> DataFrame:
    lines = items.selectExpr("order_key", *[LINE_KEYS.get(name, name) for name in sorted(columns - HEADER_COLUMNS)])
    return measured(lines, measures, {"order_key": F.col("order_key")})


class StarSource(LineSource):
    """Joins only the tables that the requested columns need.

    Dimension keys are unique, so a left join neither drops nor repeats lines, and leaving out
    an unneeded one changes nothing. No join has a broadcast hint: table sizes decide.
    """

    invoice_is_key = True

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLE_COLUMNS[name]).parquet(f"{self.folder}/{name}.parquet")

    def _with_country(self, df: DataFrame) -> DataFrame:
        customers = self.table("customer").selectExpr("c_custkey AS cust_key", "c_nationkey")
        nations = self.table("nation").selectExpr("n_nationkey AS c_nationkey", "n_name AS country")
        return df.join(customers, "cust_key", "left").join(nations, "c_nationkey", "left")

    def _headers(self, columns: set[str], kept: str = "true") -> DataFrame:
        headers = self.table("orders").filter(kept).selectExpr(HEADERS)
        return self._with_country(headers) if "country" in columns else headers

    def raw(self, *columns: str) -> DataFrame:
        wanted = set(columns)
        lines = self._raw_items(wanted)
        if wanted & HEADER_COLUMNS:
            lines = lines.join(self._headers(wanted), "order_key", "left")
        # Raw dates are text, as in a file.
        derived = LINE_KEYS | {"invoice_date": "CAST(invoice_ts AS STRING) AS invoice_date"}
        return lines.selectExpr([derived.get(name, name) for name in columns])

    def _raw_items(self, columns: set[str]) -> DataFrame:
        items = self.table("lineitem").selectExpr(ITEMS)
        return items.join(self.table("part").selectExpr(PARTS), "part_key", "left") if columns & PRODUCT_COLUMNS else items

    def _kept_items(self, columns: set[str]) -> DataFrame:
        """Items with a positive quantity and price. Product texts are normalised once per product."""
        parts = self.table("part").filter(KEPT_PARTS).selectExpr(PARTS)
        if columns & {"description", "product_key"}:
            parts = parts.withColumn("description", normalise_product(F.col("description")))
        if "product_key" in columns:
            # Products whose texts are the same are one; its key goes through the joins instead of the text.
            parts = parts.withColumn("product_key", F.min("part_key").over(Window.partitionBy("description")))
            parts = parts.select("part_key", "product_key", "unit_price")
        return self.table("lineitem").filter(KEPT_ITEMS).selectExpr(ITEMS).join(parts, "part_key").filter(HAS_POSITIVE_MEASURES)

    def _kept_headers(self, columns: set[str]) -> DataFrame:
        dates = [f"{value} AS {name}" for name, value in DATE_COLUMNS.items()]
        return self._headers(columns, KEPT_ORDERS).filter(HAS_CUSTOMER).selectExpr("*", *dates)

    def detail(self, *columns: str) -> DataFrame:
        return self._kept_lines(*columns)

    def _kept_lines(self, *columns: str) -> DataFrame:
        wanted = dict.fromkeys(columns)
        lines = self._kept_items(set(wanted)).join(self._kept_headers(set(wanted)), "order_key")
        derived = LINE_KEYS | {"line_amount": f"{LINE_AMOUNT} AS line_amount"}
        return lines.selectExpr([derived.get(name, name) for name in wanted])

    def raw_by(self, measures: Measures, keys: Keys, *columns: str) -> DataFrame:
        """One row per order goes to the join with the headers."""
        wanted = set(columns)
        parts = _measured_orders(self._raw_items(wanted), measures, wanted)
        return combined(parts.join(self._headers(wanted), "order_key", "left"), measures, keys)

    def detail_by(self, measures: Measures, keys: Keys, *columns: str) -> DataFrame:
        """One row per order goes to the join with the headers, and one per customer and other key to that with the countries."""
        wanted = set(columns)
        parts = _measured_orders(self._kept_items(wanted), measures, wanted)
        parts = parts.join(self._kept_headers(wanted - {"country"}), "order_key")
        if "country" in wanted:
            others = {name: F.col(name) for name in ["cust_key", *sorted(wanted & HEADER_COLUMNS - {"country"})]}
            parts = self._with_country(combined(parts, measures, others))
        return combined(parts, measures, keys)

    def product_lines(self, *columns: str) -> DataFrame:
        """No product text goes through the join with the headers."""
        return self._kept_lines("product_key", *columns)

    def product_invoices(self) -> DataFrame:
        """Lines of one order and product are one before the join with the header."""
        items = self._kept_items({"product_key"}).select("order_key", "product_key").distinct()
        return items.join(self._kept_headers(set()), "order_key").select("product_key", F.col("order_key").alias("invoice_no"))

    def with_product(self, rows: DataFrame, name: str) -> DataFrame:
        parts = self.table("part").selectExpr(PARTS)
        texts = parts.select(F.col("part_key").alias("product_key"), normalise_product(F.col("description")).alias(name))
        return rows.join(texts, "product_key").drop("product_key")

    def spend_by(self, *keys: str) -> DataFrame:
        """Sums over invoice attributes add up each order's lines before the join with its header.

        That join then moves one row per order instead of one per line, however many lines one
        order has. A kept line is never a return, so an order is one invoice.
        """
        wanted = set(keys)
        if not wanted <= set(INVOICE_COLUMNS):
            return super().spend_by(*keys)
        # Within one order, whole ten-thousandths add up as plain integers.
        orders = (
            self._kept_items(set())
            .selectExpr("order_key", "quantity * CAST(unit_price * 10000 AS BIGINT) AS parts")
            .groupBy("order_key")
            .agg(F.expr("CAST(sum(parts) AS DECIMAL(20, 0)) * 0.0001BD AS spend"), F.expr("count(*) AS line_count"))
        )
        per_invoice = "invoice_no" in wanted
        headers = self._kept_headers(wanted if per_invoice else set())
        invoices = orders.join(headers, "order_key").selectExpr(
            "*", "CAST(order_key AS STRING) AS invoice_no", "invoice_date AS last_date"
        )
        if per_invoice:
            return invoices.select(*keys, "spend", "line_count", "last_date")
        if "country" in wanted:
            # The country hangs on the customer: add up per customer before looking it up.
            others = [name for name in keys if name != "country"]
            invoices = self._with_country(added_up(invoices, "cust_key", *others))
        return added_up(invoices, *keys)
