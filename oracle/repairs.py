"""Oracles of the R queries."""

from __future__ import annotations

from oracle.data import FULL
from oracle.defects import PROFIT_BAD, REV_BAD, f64
from oracle.star import AS_OF, with_star
from oracle.suites import results

OPT_OUT = "optout@example.com"
SENTINELS = "('n/a', 'N/A', 'na', 'NA', '')"
ORPHAN = "customer_key NOT IN (SELECT customer_key FROM x_dim_customer)"
RANKED = """SELECT *, is_current AND row_number() OVER (PARTITION BY customer_id, is_current
  ORDER BY effective_date DESC, customer_key DESC) > 1 AS old FROM x_dim_customer"""
CLOSED = f"greatest(effective_date, CAST(DATE '{AS_OF}' - INTERVAL 1 DAY AS DATE))"
REPAIRED_CUSTOMER = f"""
SELECT * EXCLUDE (old) REPLACE (
  coalesce(CASE WHEN email IN {SENTINELS} THEN NULL ELSE email END, '{OPT_OUT}') AS email,
  CASE WHEN customer_segment = 'Platnium' THEN 'Premium' ELSE customer_segment END AS customer_segment,
  CASE WHEN old THEN {CLOSED} ELSE expiry_date END AS expiry_date, is_current AND NOT old AS is_current)
FROM ({RANKED})"""
REPAIRED_PRODUCT = """
SELECT p.* REPLACE (CAST(CASE WHEN p.list_price <= 0 THEN coalesce(e.price, p.list_price) ELSE p.list_price END
  AS DECIMAL(12,2)) AS list_price)
FROM x_dim_product p LEFT JOIN (SELECT product_id, max(cost_price * 2) AS price FROM dim_product GROUP BY product_id) e
  ON p.product_id = e.product_id"""
MONEY = f64('unit_price', 'unit_cost', 'discount_amount', 'net_revenue', 'gross_profit', 'tax_amount')


def customers(expr: str) -> str:
    return with_star(f"SELECT customer_key, {expr} FROM x_dim_customer")


def totals(where: str) -> str:
    return with_star("SELECT store_key, count(*) AS rows, CAST(sum(net_revenue) AS DOUBLE) AS net_revenue "
                     f"FROM x_fact_sales WHERE {where} GROUP BY store_key")


CRITICAL = "check_type IN ('references', 'revenue_identity', 'profit_identity')"
GATE = f"""
SELECT table_name, failed, critical_failed,
  CASE WHEN failed = 0 THEN 'promote' WHEN table_name LIKE 'dim_%' THEN 'block'
       WHEN critical_failed > 0 THEN 'quarantine' ELSE 'promote_with_alert' END AS decision
FROM (SELECT table_name, count(*) FILTER (WHERE status = 'FAIL') AS failed,
  count(*) FILTER (WHERE status = 'FAIL' AND {CRITICAL}) AS critical_failed FROM results GROUP BY table_name)"""
CHECKED = {"results": results(FULL.values(), "x_")}
LOST = {c: f"{c} NOT IN (SELECT {c} FROM x_{t})" for c, t in (
    ("customer_key", "dim_customer"), ("product_key", "dim_product"), ("store_key", "dim_store"),
    ("date_key", "dim_date"))}
TAGS = ", ".join([f"CASE WHEN {cond} THEN 'references:{c}' END" for c, cond in LOST.items()]
                 + [f"CASE WHEN {REV_BAD} THEN 'revenue_identity:net_revenue' END",
                    f"CASE WHEN {PROFIT_BAD} THEN 'profit_identity:gross_profit' END"])
BAD = " OR ".join(f"coalesce({c}, false)" for c in (*LOST.values(), REV_BAD, PROFIT_BAD))
ISSUE_SUITES = [s.only(lambda c: c.issue_id in [f"DQ-00{n}" for n in range(1, 9)]) for t, s in FULL.items()
                if t in ("dim_customer", "dim_product", "fact_sales")]

ORACLE = {
    "R1_fill_null": customers(f"coalesce(email, '{OPT_OUT}') AS email"),
    "R2_expire_duplicates": with_star(f"""
SELECT customer_key, customer_id, effective_date, CASE WHEN old THEN {CLOSED} ELSE expiry_date END AS expiry_date,
  is_current AND NOT old AS is_current FROM ({RANKED})"""),
    "R3_sentinel_to_null": customers("nullif(email, 'n/a') AS email"),
    "R4_sentinel_list": customers(f"CASE WHEN email IN {SENTINELS} THEN NULL ELSE email END AS email"),
    "R5_recode": customers("CASE WHEN customer_segment = 'Platnium' THEN 'Premium' ELSE customer_segment END "
                           "AS customer_segment"),
    "R6_backfill_price": with_star(
        f"SELECT product_key, product_id, {f64('list_price', 'cost_price')} FROM ({REPAIRED_PRODUCT})"),
    "R7_clean_fact": totals(f"NOT ({ORPHAN})"),
    "R7_quarantined_orphans": with_star(
        f"SELECT * REPLACE ({MONEY}), DATE '{AS_OF}' AS quarantined_at FROM x_fact_sales WHERE {ORPHAN}"),
    "R7_routed_in_one_pass": with_star(f"""
SELECT CASE WHEN {ORPHAN} THEN 'orphan' ELSE 'clean' END AS side, store_key, count(*) AS rows,
  CAST(sum(net_revenue) AS DOUBLE) AS net_revenue FROM x_fact_sales GROUP BY 1, 2"""),
    "R7_rows_conserved": with_star("SELECT count(*) AS rows_in, count(*) AS rows_out FROM x_fact_sales"),
    "R8_sales_kept": totals("NOT coalesce(quantity < 1, false)"),
    "R8_returns_moved": totals("quantity < 1"),
    "R9_email_status": customers("CASE WHEN email IS NULL THEN 'optout' WHEN regexp_matches(email, "
                                 "'^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$') THEN 'active' "
                                 "ELSE 'unknown' END AS email_status"),
    "R10_transaction_type": with_star("""
SELECT CASE WHEN quantity < 0 THEN 'RETURN' WHEN quantity = 0 THEN 'EXCHANGE' ELSE 'SALE' END AS transaction_type,
  count(*) AS rows, CAST(sum(net_revenue) AS DOUBLE) AS net_revenue FROM x_fact_sales GROUP BY 1"""),
    "R11_gate": with_star(GATE, CHECKED),
    "R11_load_decision": with_star(f"""
SELECT CASE WHEN bool_or(decision = 'block') THEN 'block' WHEN bool_or(decision = 'quarantine') THEN 'quarantine'
  WHEN bool_or(decision = 'promote_with_alert') THEN 'promote_with_alert' ELSE 'promote' END AS decision
FROM ({GATE})""", CHECKED),
    "R11_quarantined_rows": with_star(f"""
SELECT sales_key, order_id, customer_key, quantity, concat_ws(',', {TAGS}) AS violations FROM x_fact_sales WHERE {BAD}"""),
    "R11_promoted_rows": totals(f"NOT ({BAD})"),
    "R12_recheck": with_star(
        "SELECT table_name, check_no, check_type, issue_id, unexpected_count, status FROM results",
        {"r_dim_customer": REPAIRED_CUSTOMER, "r_dim_product": REPAIRED_PRODUCT,
         "r_dim_store": "SELECT * FROM dim_store", "r_dim_date": "SELECT * FROM dim_date",
         "r_fact_sales": f"SELECT * FROM x_fact_sales WHERE NOT ({ORPHAN}) AND NOT coalesce(quantity < 1, false)",
         "results": results(ISSUE_SUITES, "r_")}),
    "R12_rows_changed": with_star(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE a.{c} IS DISTINCT FROM b.{c}) AS rows_changed "
        "FROM x_dim_customer a JOIN repaired b ON a.customer_key = b.customer_key"
        for c in ("email", "customer_segment", "expiry_date", "is_current")), {"repaired": REPAIRED_CUSTOMER}),
}
