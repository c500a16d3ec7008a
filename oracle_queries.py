"""The same results as the jobs, as SQL over the star-schema tables, for an independent engine.

Written from the metric definitions rather than from the jobs: at line grain, with joins and
built-in window functions, where the jobs work from pre-added sums.
"""

from __future__ import annotations

from basketmill.schema import RESULT_COLUMNS

RAW = """raw AS (
  SELECT
    CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS invoice_no,
    CAST(l_partkey AS VARCHAR) AS stock_code,
    '  ' || p_name || ' ' AS description,
    CAST(CASE WHEN l_returnflag = 'R' THEN -abs(l_quantity) ELSE l_quantity END AS INTEGER) AS quantity,
    o_orderdate AS ts,
    CAST(CASE WHEN l_partkey % 97 = 0 THEN 0
         ELSE CAST(p_retailprice AS DECIMAL(12, 2)) * CAST(0.01 AS DECIMAL(4, 2)) END AS DECIMAL(12, 4)) AS unit_price,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS customer_id,
    n_name AS country
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN part ON p_partkey = l_partkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
)"""

SALES = (
    RAW
    + """, sales AS (
  SELECT invoice_no, stock_code, upper(trim(description)) AS product, quantity, ts,
         CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m') AS month, unit_price, customer_id, country,
         CAST(quantity AS DECIMAL(10, 0)) * unit_price AS amount
  FROM raw
  WHERE customer_id IS NOT NULL AND quantity > 0 AND unit_price > 0
)"""
)


def _half_up(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38, 8)), {digits}) AS DOUBLE)"


def _percent(part: str, total: str, digits: int) -> str:
    return _half_up(f"CAST({part} AS DOUBLE) * 100.0::DOUBLE / nullif(CAST({total} AS DOUBLE), 0)", digits)


def _mean(total: str, count: str, digits: int) -> str:
    return _half_up(f"CAST({total} AS DOUBLE) / nullif(CAST({count} AS DOUBLE), 0)", digits)


def _on_sales(body: str, *stages: str) -> str:
    return "WITH " + ",\n".join([SALES, *stages]) + "\n" + body


def _on_raw(body: str) -> str:
    return f"WITH {RAW}\n{body}"


TOP3 = """top3 AS (
  SELECT month AS sale_month,
         CAST(row_number() OVER (PARTITION BY month ORDER BY sum(amount) DESC, product NULLS FIRST) AS INTEGER)
           AS rank_in_month,
         product AS product_name,
         CAST(round(sum(amount), 2) AS DOUBLE) AS monthly_revenue
  FROM sales GROUP BY month, product
  QUALIFY rank_in_month <= 3
)"""

MOM = f"""mom AS (
  SELECT m.month AS sale_month, CAST(m.gmv AS DOUBLE) AS current_gmv, CAST(p.gmv AS DOUBLE) AS prev_month_gmv,
         {_half_up("(CAST(m.gmv AS DOUBLE) - CAST(p.gmv AS DOUBLE)) * 100.0::DOUBLE / nullif(CAST(p.gmv AS DOUBLE), 0)", 2)}
           AS mom_growth_pct
  FROM (SELECT month, round(sum(amount), 2) AS gmv, row_number() OVER (ORDER BY month) AS n FROM sales GROUP BY month) m
  LEFT JOIN
       (SELECT month, round(sum(amount), 2) AS gmv, row_number() OVER (ORDER BY month) AS n FROM sales GROUP BY month) p
  ON p.n = m.n - 1
)"""

RFM = f"""measures AS (
  SELECT customer_id,
         CAST(date_diff('day', max(day), (SELECT max(day) + 1 FROM sales)) AS INTEGER) AS recency_days,
         count(DISTINCT invoice_no) AS frequency,
         round(sum(amount), 2) AS monetary
  FROM sales GROUP BY customer_id
), scores AS (
  SELECT *,
         CAST(ntile(5) OVER (ORDER BY recency_days DESC, customer_id) AS INTEGER) AS r_score,
         CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f_score,
         CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS m_score
  FROM measures
), rfm AS (
  SELECT customer_id AS "CustomerID", recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary,
         r_score, f_score, m_score,
         {_half_up("(30 * r_score + 35 * f_score + 35 * m_score) / 100.0::DOUBLE", 2)} AS rfm_score,
         -- Fixed values: the segments' thresholds and names.
         CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN '高价值用户'
              WHEN r_score >= 3 AND f_score >= 3 THEN '忠诚用户'
              WHEN r_score >= 4 AND f_score <= 2 THEN '新客户'
              WHEN r_score <= 2 AND f_score >= 3 AND m_score >= 3 THEN '流失高价值用户'
              WHEN r_score <= 2 AND f_score <= 2 THEN '沉睡用户'
              ELSE '潜力用户' END AS user_segment,
         monetary AS exact_monetary
  FROM scores
), segments AS (
  SELECT user_segment, count(*) AS user_count,
         {_percent("count(*)", "(SELECT count(*) FROM rfm)", 1)} AS user_pct,
         CAST(sum(exact_monetary) AS DOUBLE) AS segment_gmv,
         {_percent("sum(exact_monetary)", "(SELECT sum(exact_monetary) FROM rfm)", 1)} AS gmv_pct,
         {_mean("sum(exact_monetary)", "count(*)", 2)} AS avg_monetary,
         {_mean("sum(frequency)", "count(*)", 1)} AS avg_frequency,
         {_mean("sum(recency_days)", "count(*)", 0)} AS avg_recency_days
  FROM rfm GROUP BY user_segment
)"""

MEAN_MONTHS = "CAST(trunc(date_diff('day', f.d, a.d) / 30.44::DOUBLE) AS INTEGER)"
CALENDAR_MONTHS = "CAST(date_diff('month', f.d, a.d) AS INTEGER)"


def _retention(offset: str) -> str:
    return f"""activity AS (
  SELECT DISTINCT customer_id, date_trunc('month', day)::DATE AS d FROM sales
), spans AS (
  SELECT strftime(f.d, '%Y-%m') AS cohort_month, {offset} AS month_offset
  FROM activity a JOIN (SELECT customer_id, min(d) AS d FROM activity GROUP BY customer_id) f USING (customer_id)
), retention AS (
  SELECT cohort_month, month_offset, count(*) AS active_users, max(cohort_size) AS cohort_size,
         {_percent("count(*)", "max(cohort_size)", 1)} AS retention_rate
  FROM spans
  JOIN (SELECT cohort_month, count(*) AS cohort_size FROM spans WHERE month_offset = 0 GROUP BY 1) USING (cohort_month)
  WHERE month_offset >= 0
  GROUP BY cohort_month, month_offset
)"""


RETENTION = _retention(MEAN_MONTHS)

BANDS = """(0, 0, 10, '< £10'), (1, 10, 50, '£10 - £50'), (2, 50, 100, '£50 - £100'),
       (3, 100, 500, '£100 - £500'), (4, 500, NULL, '>= £500')"""
INVOICES = """invoices AS (SELECT invoice_no, round(sum(amount), 2) AS total FROM sales GROUP BY invoice_no)"""

TOP_CUSTOMERS = """top_customers AS (
  SELECT customer_id AS "CustomerID", count(DISTINCT invoice_no) AS "OrderCount",
         CAST(sum(amount) AS DOUBLE) AS "TotalSpent"
  FROM sales GROUP BY customer_id ORDER BY sum(amount) DESC, customer_id LIMIT 10
)"""
HOURS = """hours AS (
  SELECT strftime(ts, '%H') AS "Hour", count(DISTINCT invoice_no) AS "OrderVolume" FROM sales GROUP BY 1
)"""


def _missing_profile() -> str:
    columns = {
        "invoice_no": "invoice_no", "stock_code": "stock_code", "description": "product",
        "invoice_date": "day", "customer_id": "customer_id", "country": "country",
    }
    counts = [f"count(*) - count({column}) AS miss_{name}" for name, column in columns.items()]
    shares = [
        f"coalesce({_percent(f'count(*) - count({column})', 'count(*)', 2)}, 0.0::DOUBLE) AS miss_{name}_pct"
        for name, column in columns.items()
    ]
    return "SELECT " + ", ".join(counts + shares) + " FROM sales"


def _quality_figures() -> str:
    """Every figure of four reports, each counted for itself."""
    kept = {"ods_rows": "SELECT count(*) FROM lineitem", "dwd_rows": "SELECT count(*) FROM sales"}
    kept["kept_pct"] = f"SELECT {_percent(f'({kept["dwd_rows"]})', f'({kept["ods_rows"]})', 2)}"
    ranges = {
        "min_invoice_date": "min(day) - DATE '1970-01-01'", "max_invoice_date": "max(day) - DATE '1970-01-01'",
        "min_quantity": "min(quantity)", "max_quantity": "max(quantity)",
        "min_unit_price": "min(unit_price)", "max_unit_price": "max(unit_price)", "gmv": "round(sum(amount), 2)",
    }
    columns = {
        "invoice_no": "invoice_no", "stock_code": "stock_code", "description": "product",
        "invoice_date": "day", "customer_id": "customer_id", "country": "country",
    }
    figures = [("kept_ratio", name, value) for name, value in kept.items()]
    figures += [("dwd_value_ranges", name, f"SELECT {value} FROM sales") for name, value in ranges.items()]
    for name, column in columns.items():
        missing = f"count(*) - count({column})"
        share = f"coalesce({_percent(missing, 'count(*)', 2)}, 0)"
        figures += [("dwd_missing_profile", f"miss_{name}", f"SELECT {missing} FROM sales")]
        figures += [("dwd_missing_profile", f"miss_{name}_pct", f"SELECT {share} FROM sales")]
    rows = [f"SELECT '{report}' AS report, '{name}' AS figure, CAST(({value}) AS DOUBLE) AS value" for report, name, value in figures]
    reasons = """SELECT 'ods_filter_reasons', CASE WHEN customer_id IS NULL THEN 'drop:CustomerID_is_null'
    WHEN quantity <= 0 THEN 'drop:Quantity_non_positive' WHEN unit_price <= 0 THEN 'drop:UnitPrice_non_positive'
    ELSE 'keep:DWD' END, CAST(count(*) AS DOUBLE) FROM raw GROUP BY ALL"""
    return "\nUNION ALL ".join([*rows, reasons])


def _pivot6() -> str:
    columns = ", ".join(f'max(retention_rate) FILTER (month_offset = {n}) AS "M{n}_%"' for n in range(6))
    return f"SELECT cohort_month, max(cohort_size) AS cohort_size, {columns} FROM retention GROUP BY cohort_month"


def _contents(name: str, relation: str, columns: list[str], texts: set[str]) -> str:
    values = [f'"{c}"' if c in texts else f'CAST(CAST("{c}" AS DECIMAL(38, 4)) AS VARCHAR)' for c in columns]
    line = " || '|' || ".join(f"coalesce({value}, '-')" for value in values)
    part = f"CAST(('0x' || substr(md5({line}), 1, 8)) AS BIGINT)"
    return f"SELECT '{name}' AS table_name, count(*) AS row_count, CAST(sum({part}) AS BIGINT) AS contents FROM {relation}"


def _all_contents(relations: dict[str, str]) -> str:
    texts = {"sale_month", "product_name", "user_segment", "cohort_month", "Hour"}
    parts = [_contents(name, relation, RESULT_COLUMNS[name], texts) for name, relation in relations.items()]
    return " UNION ALL ".join(parts)


DETAIL = """SELECT invoice_no AS "InvoiceNo", stock_code AS "StockCode", product AS "Description",
       quantity AS "Quantity", CAST(day AS VARCHAR) AS "InvoiceDate", CAST(unit_price AS DOUBLE) AS "UnitPrice",
       customer_id AS "CustomerID", country AS "Country", CAST(amount AS DOUBLE) AS "TotalLineItemAmount" FROM sales"""


#: Queries that read a stored result back -> the query whose result that is.
STORED = {
    "stored_monthly_top3": "monthly_top3_products",
    "stored_latest_month_top3": "latest_month_top3",
    "stored_segment_labels": "rfm_segment_labels",
    "stored_retention_matrix": "cohort_retention_matrix",
    "stored_rfm_segments": "rfm_segments",
    "stored_rfm_customers": "rfm_customers",
    "stored_cohort_retention": "cohort_retention",
    "stored_running_spend": "customer_running_spend",
}


def all_queries() -> dict[str, str]:
    found = _queries()
    return found | {name: found[same] for name, same in STORED.items()}


def _queries() -> dict[str, str]:
    return {
        "build_ods": _on_raw(
            """SELECT invoice_no AS "InvoiceNo", stock_code AS "StockCode", description AS "Description",
       quantity AS "Quantity", CAST(ts AS VARCHAR) AS "InvoiceDate", CAST(unit_price AS DOUBLE) AS "UnitPrice",
       customer_id AS "CustomerID", country AS "Country" FROM raw"""
        ),
        "build_dwd": _on_sales(DETAIL),
        "stored_detail": _on_sales(DETAIL),
        "monthly_top3_products": _on_sales("SELECT * FROM top3 ORDER BY sale_month, rank_in_month", TOP3),
        "monthly_gmv_mom": _on_sales("SELECT * FROM mom ORDER BY sale_month", MOM),
        "customer_running_spend": _on_sales(
            """SELECT customer_id AS "CustomerID", month AS order_month, CAST(round(sum(amount), 2) AS DOUBLE) AS monthly_spend,
       CAST(sum(round(sum(amount), 2)) OVER (PARTITION BY customer_id ORDER BY month) AS DOUBLE) AS cumulative_spend
FROM sales GROUP BY customer_id, month"""
        ),
        "rfm_segments": _on_sales("SELECT * FROM segments ORDER BY segment_gmv DESC", RFM),
        "rfm_customers": _on_sales("SELECT * EXCLUDE (exact_monetary) FROM rfm", RFM),
        "rfm_customer_detail": _on_sales(
            'SELECT * EXCLUDE (exact_monetary) FROM rfm ORDER BY rfm_score DESC, "CustomerID" LIMIT 50', RFM
        ),
        "rfm_segment_labels": _on_sales(
            """SELECT segments.*, names.label AS user_segment_label
FROM segments JOIN (VALUES ('高价值用户', 'Champions'), ('忠诚用户', 'Loyal'), ('新客户', 'New'),
  ('流失高价值用户', 'At Risk'), ('沉睡用户', 'Hibernating'), ('潜力用户', 'Promising')) names(segment, label)
ON names.segment = user_segment""",
            RFM,
        ),
        "cohort_retention": _on_sales("SELECT * FROM retention ORDER BY cohort_month, month_offset", RETENTION),
        "cohort_retention_pivot6": _on_sales(_pivot6(), RETENTION),
        "cohort_retention_matrix": _on_sales(
            """SELECT cohort_month, month_offset, retention_rate
FROM (SELECT DISTINCT cohort_month FROM retention) cohorts
CROSS JOIN (SELECT DISTINCT month_offset FROM retention) offsets
LEFT JOIN retention USING (cohort_month, month_offset)""",
            RETENTION,
        ),
        "cohort_retention_calendar": _on_sales(
            "SELECT * FROM retention ORDER BY cohort_month, month_offset", _retention(CALENDAR_MONTHS)
        ),
        "repurchase_rate": _on_sales(
            f"""SELECT count(*) AS total_customers, count(*) FILTER (orders >= 2) AS repurchase_customers,
       {_percent("count(*) FILTER (orders >= 2)", "count(*)", 1)} AS repurchase_rate_pct
FROM (SELECT customer_id, count(DISTINCT invoice_no) AS orders FROM sales GROUP BY customer_id)"""
        ),
        "new_vs_returning_gmv": _on_sales(
            """SELECT s.month AS order_month, CASE WHEN s.month = f.month THEN '新客' ELSE '老客' END AS customer_type,
       CAST(round(sum(amount), 2) AS DOUBLE) AS gmv, count(DISTINCT customer_id) AS user_count
FROM sales s JOIN (SELECT customer_id, min(month) AS month FROM sales GROUP BY customer_id) f USING (customer_id)
GROUP BY 1, 2"""
        ),
        "product_repurchase_top10": _on_sales(
            f"""SELECT product, count(*) AS total_buyers, count(*) FILTER (orders >= 2) AS repurchase_buyers,
       {_percent("count(*) FILTER (orders >= 2)", "count(*)", 1)} AS repurchase_rate_pct
FROM (SELECT product, customer_id, count(DISTINCT invoice_no) AS orders FROM sales GROUP BY product, customer_id)
GROUP BY product HAVING count(*) >= 50
ORDER BY repurchase_rate_pct DESC, product NULLS FIRST LIMIT 10"""
        ),
        "order_value_buckets": _on_sales(
            f"""SELECT label AS price_bucket, count(*) AS order_count, CAST(sum(total) AS DOUBLE) AS bucket_gmv,
       {_mean("sum(total)", "count(*)", 2)} AS avg_order_value
FROM invoices JOIN (VALUES {BANDS}) bands(n, low, high, label)
  ON total >= low AND (high IS NULL OR total < high)
GROUP BY n, label ORDER BY n""",
            INVOICES,
        ),
        "average_order_value": _on_sales(
            f"""SELECT count(*) AS order_count, CAST(sum(total) AS DOUBLE) AS gmv,
       {_mean("sum(total)", "count(*)", 2)} AS avg_order_value FROM invoices""",
            INVOICES,
        ),
        "ods_filter_reasons": _on_raw(
            f"""SELECT reason, count(*) AS cnt, {_percent("count(*)", "(SELECT count(*) FROM lineitem)", 2)} AS pct
FROM (SELECT CASE WHEN customer_id IS NULL THEN 'drop:CustomerID_is_null'
                  WHEN quantity <= 0 THEN 'drop:Quantity_non_positive'
                  WHEN unit_price <= 0 THEN 'drop:UnitPrice_non_positive'
                  ELSE 'keep:DWD' END AS reason FROM raw)
GROUP BY reason"""
        ),
        "dwd_missing_profile": _on_sales(_missing_profile()),
        "quality_figures": _on_sales(_quality_figures()),
        "sql_on_layers": _on_sales(
            """SELECT country AS "Country", (SELECT count(*) FROM raw WHERE raw.country = sales.country) AS raw_lines,
       count(*) AS kept_lines, CAST(round(sum(amount), 2) AS DOUBLE) AS revenue FROM sales GROUP BY country"""
        ),
        "dwd_value_ranges": _on_sales(
            """SELECT CAST(min(day) AS VARCHAR) AS min_invoice_date, CAST(max(day) AS VARCHAR) AS max_invoice_date,
       min(quantity) AS min_quantity, max(quantity) AS max_quantity,
       CAST(min(unit_price) AS DOUBLE) AS min_unit_price, CAST(max(unit_price) AS DOUBLE) AS max_unit_price,
       CAST(round(sum(amount), 2) AS DOUBLE) AS gmv FROM sales"""
        ),
        "kept_ratio": _on_sales(
            f"""SELECT ods_rows, dwd_rows, {_percent("dwd_rows", "ods_rows", 2)} AS kept_pct
FROM (SELECT (SELECT count(*) FROM lineitem) AS ods_rows, (SELECT count(*) FROM sales) AS dwd_rows)"""
        ),
        "layer_row_counts": _on_sales(
            """SELECT 'ODS (Raw)' AS "Layer", (SELECT count(*) FROM lineitem) AS "Rows"
UNION ALL SELECT 'DWD (Clean)', (SELECT count(*) FROM sales)"""
        ),
        "top_countries": _on_sales(
            """SELECT country AS "Country", CAST(sum(amount) AS DOUBLE) AS "TotalRevenue" FROM sales
GROUP BY country ORDER BY sum(amount) DESC, country NULLS FIRST LIMIT 10"""
        ),
        "monthly_revenue": _on_sales(
            """SELECT month AS "Month", CAST(sum(amount) AS DOUBLE) AS "MonthlyRevenue" FROM sales GROUP BY month"""
        ),
        "hourly_order_volume": _on_sales("SELECT * FROM hours", HOURS),
        "top_customers": _on_sales("SELECT * FROM top_customers", TOP_CUSTOMERS),
        "hot_products": _on_sales(
            """SELECT product AS "Description", count(DISTINCT invoice_no) AS "OrderCount" FROM sales
GROUP BY product ORDER BY 2 DESC, product NULLS FIRST LIMIT 20"""
        ),
        "latest_month_top3": _on_sales(
            "SELECT * FROM top3 WHERE sale_month = (SELECT max(month) FROM sales) ORDER BY rank_in_month", TOP3
        ),
        "gmv_by_product": _on_sales(
            """SELECT product AS product_name, CAST(round(sum(amount), 2) AS DOUBLE) AS gmv FROM sales GROUP BY product"""
        ),
        "hourly_event_users": """SELECT strftime(ts, '%H') AS "Hour", count(DISTINCT user_id) AS "UserVolume"
FROM events GROUP BY 1""",
        "build_ads": _on_sales(
            _all_contents(
                {
                    "ads_monthly_top3_products": "top3",
                    "ads_monthly_gmv_mom": "mom",
                    "ads_rfm_segments": "segments",
                    "ads_cohort_retention": "retention",
                    "ads_top_customers": "top_customers",
                    "ads_hourly_sales": "hours",
                }
            ),
            TOP3, MOM, RFM, RETENTION, TOP_CUSTOMERS, HOURS,
        ),
    }
