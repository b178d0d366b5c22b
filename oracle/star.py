"""Common table expressions: the star, the star with the eight defects, and the load log."""

from __future__ import annotations

import re

AS_OF = "2026-04-29"


def money(cents: str) -> str:
    return f"CAST(CAST(floor({cents}) AS DECIMAL(10,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2))"


PRICE, COST = money("l_extendedprice * 100 / l_quantity"), money("l_extendedprice * 50 / l_quantity")
DISCOUNT = money("l_extendedprice * 100 * l_discount")
NATION = "JOIN nation ON {} = n_nationkey"


def day_key(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


CTES = {
    "dim_customer": f"""
SELECT c_custkey AS customer_key, 'CUS' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS customer_id,
  c_name AS customer_name,
  CASE WHEN c_custkey % 100 < 3 THEN NULL WHEN c_custkey % 100 < 5 THEN 'n/a'
       ELSE 'c' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email,
  n_name AS city, substr(n_name, 1, 2) AS state, CAST(10000 + c_custkey % 90000 AS INTEGER) AS zip_code,
  CASE WHEN c_custkey % 200 = 7 THEN 'Platnium' WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'Standard'
       WHEN c_mktsegment = 'MACHINERY' THEN 'Premium' ELSE 'Budget' END AS customer_segment,
  DATE '2020-01-01' AS effective_date, DATE '9999-12-31' AS expiry_date, true AS is_current
FROM customer {NATION.format('c_nationkey')}""",
    "dim_product": f"""
SELECT p_partkey AS product_key, 'PROD' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS product_id,
  p_name AS product_name, p_type AS category, p_name AS subcategory, p_brand AS brand,
  CASE WHEN p_partkey % 100 = 1 THEN CAST(0 AS DECIMAL(12,2)) ELSE {money('p_retailprice * 100')} END AS list_price,
  CAST({money('p_retailprice * 50')} + CASE WHEN p_partkey % 100 = 2 THEN 5000 ELSE 0 END AS DECIMAL(12,2))
    AS cost_price,
  p_size <= 45 AS is_active
FROM part""",
    "dim_store": f"""
SELECT s_suppkey AS store_key, 'STR' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS store_id, s_name AS store_name,
  n_name AS city, substr(n_name, 1, 2) AS state, r_name AS region,
  CASE WHEN s_suppkey % 10 < 6 THEN 'Standard' WHEN s_suppkey % 10 < 9 THEN 'Express' ELSE 'Flagship' END
    AS store_type,
  CASE WHEN s_suppkey % 50 = 9 THEN DATE '2099-01-01' ELSE DATE '2010-06-01' END AS opening_date
FROM supplier {NATION.format('s_nationkey')} JOIN region ON n_regionkey = r_regionkey""",
    "dim_date": f"""
SELECT {day_key('d')} AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year_number,
  CAST(quarter(d) AS INTEGER) AS quarter_number, CAST(month(d) AS INTEGER) AS month_number,
  monthname(d) AS month_name, CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
  isodow(d) >= 6 AS is_weekend, month(d) = 12 AND day(d) = 25 AS is_holiday
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "dated_sales": f"""
SELECT l_orderkey * 10 + l_linenumber AS sales_key, {day_key('o_orderdate')} AS date_key,
  CASE WHEN l_orderkey % 1000 = 3 THEN 999999999 ELSE o_custkey END AS customer_key, l_partkey AS product_key,
  l_suppkey AS store_key, 'ORD-' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS order_id,
  l_linenumber AS order_line_num, CAST(CASE WHEN l_orderkey % 500 = 4 THEN -1 ELSE l_quantity END AS INTEGER)
    AS quantity,
  {PRICE} AS unit_price, {COST} AS unit_cost, {DISCOUNT} AS discount_amount,
  CAST(CAST(l_quantity AS INTEGER) * {PRICE} - {DISCOUNT} AS DECIMAL(14,2)) AS net_revenue,
  CAST(CAST(l_quantity AS INTEGER) * ({PRICE} - {COST}) - {DISCOUNT} AS DECIMAL(14,2)) AS gross_profit,
  {money('l_extendedprice * 100 * l_tax')} AS tax_amount, CAST(o_orderdate AS DATE) AS load_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fact_sales": "SELECT * EXCLUDE (load_date) FROM dated_sales",
    # the same tables with the eight defects
    "x_customer_1": """
SELECT * REPLACE (CASE WHEN customer_key BETWEEN 1 AND 300 THEN NULL ELSE email END AS email) FROM dim_customer""",
    "x_dim_customer": f"""
SELECT * REPLACE (
  CASE WHEN customer_key BETWEEN 2001 AND 2200 THEN 'n/a' ELSE email END AS email,
  CASE WHEN customer_key BETWEEN 3001 AND 3050 THEN 'Platnium' ELSE customer_segment END AS customer_segment)
FROM (SELECT * FROM x_customer_1 UNION ALL
  SELECT customer_key + 100000, customer_id, customer_name || ' [DUP]', email, city, state, zip_code,
    customer_segment, DATE '{AS_OF}', DATE '9999-12-31', true
  FROM x_customer_1 WHERE customer_key BETWEEN 1001 AND 1010)""",
    "x_product_1": """
SELECT * REPLACE (CASE WHEN product_key BETWEEN 101 AND 115 THEN 0 ELSE list_price END AS list_price)
FROM dim_product""",
    "x_dim_product": """
SELECT * REPLACE (CAST(CASE WHEN product_key BETWEEN 201 AND 210 THEN list_price + 50 ELSE cost_price END
  AS DECIMAL(12,2)) AS cost_price) FROM x_product_1""",
    "x_dim_store": "SELECT * FROM dim_store",
    "x_dim_date": "SELECT * FROM dim_date",
    "x_fact_sales": """
SELECT * REPLACE (CAST(CASE WHEN sales_key IN (SELECT sales_key FROM fact_sales ORDER BY sales_key LIMIT 100)
  THEN -1 ELSE quantity END AS INTEGER) AS quantity)
FROM (SELECT * FROM fact_sales UNION ALL
  SELECT 900000000000 + g, 20240615, 999999, 500, 50, 'ORD-ORPHAN-' || lpad(CAST(g AS VARCHAR), 4, '0'), 1, 2,
    100.00, 60.00, 5.00, 195.00, 75.00, 15.60 FROM range(1, 51) t(g))""",
    # monitoring inputs derived from the event stream
    "load_log": """
SELECT CASE event_type WHEN 'click' THEN 'fact_sales' WHEN 'view' THEN 'dim_customer'
    WHEN 'purchase' THEN 'dim_product' WHEN 'signup' THEN 'dim_store' ELSE 'dim_date' END AS table_name,
  CASE WHEN day(CAST(ts AS DATE)) % 2 = 0 THEN min(ts) ELSE max(ts) END AS load_timestamp,
  CAST(ts AS DATE) AS load_date
FROM events GROUP BY event_type, CAST(ts AS DATE)""",
    "daily_load": """
SELECT event_id, event_type, CAST(ts AS DATE) AS load_date FROM events
  WHERE NOT (CAST(ts AS DATE) = DATE '2024-01-15' AND event_type <> 'click')
UNION ALL SELECT event_id, event_type, CAST(ts AS DATE) FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-02'
UNION ALL SELECT event_id, event_type, CAST(ts AS DATE) FROM events, range(2)
  WHERE CAST(ts AS DATE) = DATE '2024-01-24'""",
}


def referenced(text: str) -> list[str]:
    """The common table expressions a text needs, in the order of their definition."""
    needed: set[str] = set()
    pending = [text]
    while pending:
        part = pending.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", part):
                needed.add(name)
                pending.append(CTES[name])
    return [n for n in CTES if n in needed]


def with_star(body: str, extra: dict[str, str] | None = None) -> str:
    """A statement with every common table expression it mentions."""
    extra = extra or {}
    names = referenced(body + "\n" + "\n".join(extra.values()))
    ctes = [f"{n} AS MATERIALIZED ({CTES[n]})" for n in names] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def pct(part: str, whole: str, digits: int = 2) -> str:
    """Percentage rounded half up, in whole numbers."""
    scale = 10 ** digits
    return (f"CAST((CAST({part} AS HUGEINT) * {200 * scale} + {whole}) // nullif(CAST({whole} AS HUGEINT) * 2, 0) "
            f"AS DOUBLE) / {scale}")


def score(part: str, whole: str) -> str:
    """Share rounded half up to four decimals; 1 for an empty whole."""
    return (f"coalesce(CAST((CAST({part} AS HUGEINT) * 20000 + {whole}) // nullif(CAST({whole} AS HUGEINT) * 2, 0) "
            f"AS DOUBLE) / 10000, 1.0)")


def mean(score_expr: str) -> str:
    """Mean of scores with four decimals, rounded half up to eight, in whole numbers."""
    return (f"CAST((sum(CAST(round(({score_expr}) * 10000) AS HUGEINT)) * 20000 + count(*)) // (count(*) * 2) AS DOUBLE)"
            " / 100000000")
