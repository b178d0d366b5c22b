"""Oracles of the A queries."""

from __future__ import annotations

from oracle.data import CONTRACT, FIELDS, FULL
from oracle.star import AS_OF, with_star
from oracle.suites import results

WAREHOUSE = ("dim_customer", "dim_product", "dim_store", "dim_date", "fact_sales")


def columns(table: str) -> list[str]:
    return [f.name for f in FIELDS[table]]



SIZES = with_star(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, {len(columns(t))} AS column_count FROM {t}"
    for t in WAREHOUSE))
KEYS = {"date_key": "dim_date", "customer_key": "dim_customer", "product_key": "dim_product", "store_key": "dim_store"}


def orphans(column: str, table: str, fact: str = "fact_sales", dim: str | None = None) -> str:
    return (f"SELECT 'fact_sales -> {table}' AS check_name, count(*) AS orphan_count FROM {fact} f "
            f"WHERE NOT EXISTS (SELECT 1 FROM {dim or table} d WHERE d.{column} = f.{column})")


ORPHANS = " UNION ALL ".join(orphans(c, t) for c, t in KEYS.items())

def content(source: str, action: str) -> str:
    """Rows and hash totals of each year; a value is its length, a colon and its text."""
    values = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
                         for c in [*columns("fact_sales"), "load_date"])
    return f"""
SELECT 'p' || y AS period, count(*) AS rows, CAST(sum(CAST(h AS HUGEINT)) AS VARCHAR) AS hash_sum,
  CAST(bit_xor(h) AS BIGINT) AS hash_xor, true AS agrees, {action} AS action
FROM (SELECT year(load_date) AS y, CAST('0x' || substr(md5({values}), 1, 15) AS BIGINT) AS h FROM {source}) GROUP BY y"""


# The fact after a load: 2001 appended, 1996 removed, quantities of 1997 lost.
AFTER = """
SELECT * REPLACE (CASE WHEN year(load_date) = 1997 AND order_line_num = 1 THEN NULL ELSE quantity END AS quantity)
FROM dated_sales WHERE year(load_date) <> 1996"""

ORACLE = {
    "A4_snapshot_by_content": with_star(
        content("after_load", "CASE WHEN y IN (1997, 2001) THEN 'COPIED' ELSE 'KEPT' END") + "\nUNION ALL"
        + content("(SELECT * FROM dated_sales WHERE year(load_date) = 1996)", "'REMOVED'"), {"after_load": AFTER}),
    "A1_table_scan": SIZES,
    "A2_registry_views": with_star("SELECT region, store_type, count(*) AS stores FROM dim_store GROUP BY ALL"),
    "A3_head": with_star("SELECT * FROM dim_customer ORDER BY customer_key LIMIT 5"),
    "A4_snapshot": SIZES,
    "A6_validation_runs_sink": with_star(
        f"SELECT CAST(2 AS BIGINT) AS run_id, '06:30' AS run_time, DATE '{AS_OF}' AS load_date, table_name, dimension, "
        "count(*) AS metrics, "
        "CAST(sum(least(unexpected_count, evaluated_count)) AS BIGINT) AS fail_count FROM results "
        "GROUP BY table_name, dimension", {"results": results([FULL["dim_product"]])}),
    "A7_quarantine_table": with_star(f"""
SELECT customer_key, DATE '{AS_OF}' AS quarantined_on, count(*) AS rows, CAST(sum(net_revenue) AS DOUBLE) AS net_revenue
FROM fact_sales WHERE customer_key NOT IN (SELECT customer_key FROM dim_customer) GROUP BY customer_key"""),
    "A8_row_generator": with_star("""
SELECT false AS generated, count(*) AS rows, max(sales_key) AS max_sales_key, max(order_id) AS max_order_id,
  CAST(sum(net_revenue) AS DOUBLE) AS net_revenue FROM fact_sales
UNION ALL SELECT true, count(*), max(900000000000 + g), max('ORD-ORPHAN-' || lpad(CAST(g AS VARCHAR), 4, '0')),
  CAST(sum(195.00) AS DOUBLE) FROM range(1, 51) t(g)"""),
    "A9_contract_source": with_star(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {len(fields)} AS fields, {len(CONTRACT[t].checks)} AS checks, "
        f"count(*) AS row_count FROM {t}" for t, fields in FIELDS.items())),
    "A10_integrity_history": with_star(f"""
SELECT check_date, CAST(4 AS BIGINT) AS checks, CAST((SELECT sum(orphan_count) FROM ({ORPHANS})) AS BIGINT) AS orphans
FROM (VALUES (DATE '2026-04-28'), (DATE '2026-04-29')) d(check_date)"""),
    "K5_latest_integrity": with_star(f"""
SELECT check_name, orphan_count, CASE WHEN orphan_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
  DATE '{AS_OF}' AS check_timestamp FROM ({ORPHANS})"""),
}
