"""Oracles of the E, C and N queries."""

from __future__ import annotations

from oracle.data import FIELDS, FULL, SPLIT, by_kind, matching
from oracle.star import AS_OF, pct, with_star
from oracle.suites import BRIEF, brief, broken, results, text

KEY_OF = {t: next(f.name for f in fields if f.primary) for t, fields in FIELDS.items()}


def of_kind(suites, *kinds) -> str:
    return brief(by_kind(suites, *kinds).values())


def orphan(column: str) -> str:
    return brief([FULL["fact_sales"].only(lambda c: c.kind == "references" and c.columns == (column,))])


def mirror(select: str, suites=None) -> str:
    return with_star(select, {"results": results((suites or FULL).values(), "x_")})


def verdict(n: str) -> str:
    return f"CASE WHEN {n} = 0 THEN 'PASS' ELSE 'FAIL' END"


def numbered(parts: list[tuple[str, int, str]]) -> str:
    return with_star(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {no} AS check_no, n AS unexpected_count, {verdict('n')} AS status FROM ({q})"
        for t, no, q in parts))


STORED = [
    ("not_null", "product_id", None, "SELECT count(*) AS n FROM dim_product WHERE product_id IS NULL", 1),
    ("between", "list_price", "DQ-005",
     "SELECT count(*) AS n FROM dim_product WHERE list_price NOT BETWEEN 0.01 AND 100000", 1),
    ("length_between", "brand", None, "SELECT count(*) AS n FROM dim_product WHERE length(brand) NOT BETWEEN 2 AND 50", 0.99),
    ("unexpected_rows", "", None,
     "SELECT count(*) AS n FROM dim_product WHERE NOT regexp_matches(product_id, '^PROD[0-9]+$')", 1),
    ("unexpected_rows", "", "DQ-006", "SELECT count(*) AS n FROM dim_product WHERE cost_price > list_price", 1),
]

SUMMARY = f"""
SELECT coalesce(table_name, 'TOTAL') AS table_name, count(*) AS total,
  count(*) FILTER (WHERE status = 'PASS') AS passed, count(*) FILTER (WHERE status = 'FAIL') AS failed,
  {pct("count(*) FILTER (WHERE status = 'PASS')", 'count(*)', 1)} AS pass_rate,
  CASE WHEN count(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM results GROUP BY ROLLUP (table_name)"""

FAULTS = {"unique": "n > 1", "compound_unique": "n > 1", "duplicate_key": "n > 1", "one_current_row": "cur > 1",
          "has_current_row": "cur = 0"}


def pieces(name: str, suite, c) -> str | None:
    """The 20 smallest pieces of evidence of one check by a hash of their key; nothing where no row shows the check."""
    table = f"x_{suite.table}"
    if c.kind in FAULTS:
        key = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in c.columns)
        current = f"count(*) FILTER (WHERE {c.args['flag']})" if "flag" in c.args else "0"
        known = " OR ".join(f"{k} IS NOT NULL" for k in c.columns) if c.kind.endswith("unique") else "true"
        rows = (f"SELECT {key} AS row_key FROM (SELECT {', '.join(c.columns)}, count(*) AS n, {current} AS cur FROM {table} "
                f"GROUP BY {', '.join(c.columns)}) WHERE ({known}) AND {FAULTS[c.kind]}")
    elif c.kind == "references":
        col = c.columns[0]
        rows = (f"SELECT {KEY_OF[suite.table]} AS row_key FROM {table} WHERE {col} IS NULL OR {col} NOT IN "
                f"(SELECT {c.args['key']} FROM x_{c.args['table']} WHERE {c.args['key']} IS NOT NULL)")
    elif c.kind in ("row_count", "column_order", "boolean_share", "distinct_ratio", "dominance", "unexpected_rows"):
        return None
    else:
        rows = f"SELECT {KEY_OF[suite.table]} AS row_key FROM {table} WHERE {broken(c)}"
    return (f"SELECT '{name}' AS suite, '{suite.table}' AS table_name, {c.no} AS check_no, {text(c.kind)} AS check_type, "
            f"{text(c.column_name)} AS column_name, CAST(no AS INTEGER) AS evidence_no, copies, row_key FROM "
            f"(SELECT CAST(row_key AS VARCHAR) AS row_key, count(*) AS copies, "
            f"row_number() OVER (ORDER BY md5(CAST(row_key AS VARCHAR))) AS no FROM ({rows}) GROUP BY row_key) WHERE no <= 20 "
            f"AND EXISTS (SELECT 1 FROM {name}_results WHERE table_name = '{suite.table}' AND check_no = {c.no} "
            f"AND status = 'FAIL')")


def by_load(kind: str, keys: str, skip: str, count: str) -> str:
    """After each load: a plain check over all rows so far."""
    return f"""
SELECT '{kind}' AS check_type, l.f AS load_date,
  (SELECT count(*) FROM ev WHERE load = l.f AND NOT ({skip})) AS load_rows,
  (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM ev WHERE load = l.f AND NOT ({skip}))) AS load_keys,
  (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM ev WHERE load = l.f AND NOT ({skip})
     INTERSECT SELECT DISTINCT {keys} FROM ev WHERE load < l.f)) AS keys_seen_before,
  (SELECT {count.format('true')} FROM (SELECT {keys}, count(*) AS n FROM ev WHERE load <= l.f AND NOT ({skip}) GROUP BY {keys}))
    AS evaluated_count,
  (SELECT {count.format('n > 1')} FROM (SELECT {keys}, count(*) AS n FROM ev WHERE load <= l.f AND NOT ({skip}) GROUP BY {keys}))
    AS unexpected_count
FROM loads l"""


ROWS, GROUPS = "CAST(coalesce(sum(n) FILTER (WHERE {}), 0) AS BIGINT)", "count(*) FILTER (WHERE {})"

ORACLE = {
    "E5_unique_by_load": with_star("\nUNION ALL ".join([
        by_load("unique", "event_id", "event_id IS NULL", ROWS),
        by_load("compound_unique", "event_type, user_id", "event_type IS NULL AND user_id IS NULL", ROWS),
        by_load("duplicate_key", "event_type, user_id", "false", GROUPS)]),
        {"loads": "SELECT CAST(unnest(['2024-01-01', '2024-01-11', '2024-01-21']) AS DATE) AS f",
         "ev": "SELECT d.*, e.user_id, (SELECT coalesce(max(f), DATE '2024-01-01') FROM loads WHERE f <= d.load_date) AS load "
               "FROM daily_load d JOIN events e USING (event_id)"}),
    "E16_evidence": with_star("\nUNION ALL ".join(
        p for name, suites in (("full", FULL), ("modular", SPLIT)) for s in suites.values() for c in s.checks
        if (p := pieces(name, s, c))),
        {"full_results": results(FULL.values(), "x_"), "modular_results": results(SPLIT.values(), "x_")}),
    "E1_row_count": of_kind(FULL, "row_count"),
    "E2_column_order": of_kind(FULL, "column_order", "row_count"),
    "E3_not_null": of_kind(FULL, "not_null"),
    "E4_unique": of_kind(FULL, "unique"),
    "E5_compound_unique": of_kind(FULL, "compound_unique"),
    "E6_distinct_ratio": of_kind(FULL, "distinct_ratio"),
    "E7_between": of_kind(FULL, "between"),
    "E8_between_dates": brief(matching(FULL, lambda c: c.kind == "between" and isinstance(c.args["min"], str)).values()),
    "E9_length_between": of_kind(FULL, "length_between"),
    "E10_in_set": of_kind(FULL, "in_set"),
    "E11_matches": of_kind(FULL, "matches"),
    "E12_distinct_in_set": of_kind(FULL, "distinct_in_set"),
    "E13_unexpected_rows": numbered([
        ("fact_sales", 1, "SELECT count(*) AS n FROM (SELECT 1 FROM fact_sales GROUP BY order_id, order_line_num "
                          "HAVING count(*) > 1)"),
        ("fact_sales", 2, "SELECT count(*) AS n FROM fact_sales f LEFT JOIN dim_customer c "
                          "ON f.customer_key = c.customer_key WHERE c.customer_key IS NULL"),
        ("fact_sales", 3, "SELECT count(*) AS n FROM fact_sales WHERE quantity < 1"),
        ("dim_store", 1, f"SELECT count(*) AS n FROM dim_store WHERE opening_date > DATE '{AS_OF}'")]),
    "E14_mostly": brief(matching(SPLIT, lambda c: c.mostly < 1).values()),
    "E14_mostly_nulls_unexpected": with_star(f"""
SELECT 'dim_customer' AS table_name, {next(c.no for c in FULL['dim_customer'].checks if c.kind == 'matches')} AS check_no,
  'matches' AS check_type, 'email' AS column_name, 'Validity' AS dimension, 'DQ-003' AS issue_id,
  ev AS evaluated_count, un AS unexpected_count, round(un * 100e0 / nullif(ev, 0), 6) AS unexpected_pct,
  CASE WHEN ev - un >= 0.99 * ev THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT count(*) AS ev, count(*) FILTER (WHERE email IS NULL OR NOT regexp_matches(email,
  '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}$')) AS un FROM dim_customer)"""),
    "E15_check_metadata": mirror("SELECT table_name, check_no, check_type, dimension, issue_id, predicted, mostly, "
                                 "status FROM results WHERE issue_id IS NOT NULL"),
    "E16_unexpected_sample": with_star("""
(SELECT 'dim_customer' AS table_name, 'matches' AS check_type, customer_key AS row_key FROM dim_customer
 WHERE NOT regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$') ORDER BY customer_key LIMIT 20)
UNION ALL (SELECT 'fact_sales', 'revenue_identity', sales_key FROM fact_sales
 WHERE abs(net_revenue - (quantity * unit_price - discount_amount)) > 0.01 ORDER BY sales_key LIMIT 20)
UNION ALL (SELECT 'dim_product', 'margin', product_key FROM dim_product
 WHERE cost_price >= list_price AND list_price > 0 ORDER BY product_key LIMIT 20)"""),
    "C1_one_current_row": mirror(f"SELECT {BRIEF} FROM results", by_kind(FULL, "one_current_row")),
    "C2_duplicate_key": of_kind({"dim_customer": FULL["dim_customer"]}, "duplicate_key"),
    "C3_duplicate_compound_key": of_kind({"fact_sales": FULL["fact_sales"]}, "duplicate_key"),
    "C4_id_format": of_kind(FULL, "id_format"),
    "C4_id_format_modular": of_kind(SPLIT, "id_format"),
    "C5_date_order": of_kind(FULL, "date_order"),
    "C6_open_row_sentinel": of_kind(FULL, "open_row_sentinel"),
    "C7_margin_guarded": of_kind(FULL, "margin"),
    "C8_margin_unguarded": of_kind(SPLIT, "margin"),
    "C9_not_future": of_kind(FULL, "not_future"),
    "C10_month_matches": of_kind(FULL, "month_matches"),
    "C11_year_matches": of_kind(SPLIT, "year_matches"),
    "C12_boolean_share": of_kind(SPLIT, "boolean_share"),
    "C13_dominance": of_kind(SPLIT, "dominance"),
    "C14_orphan_customer": orphan("customer_key"),
    "C15_orphan_product": orphan("product_key"),
    "C16_orphan_store": orphan("store_key"),
    "C17_orphan_date": orphan("date_key"),
    "C18_revenue_identity": of_kind(FULL, "revenue_identity"),
    "C19_profit_identity": of_kind(FULL, "profit_identity"),
    "A5_suite_store": with_star(" UNION ALL ".join(
        f"SELECT 'dim_product' AS table_name, {i} AS check_no, '{kind}' AS check_type, '{column}' AS column_name, "
        f"CAST({text(issue)} AS VARCHAR) AS issue_id, n AS unexpected_count, "
        + (verdict("n") if mostly == 1 else
           f"CASE WHEN (SELECT count(brand) FROM dim_product) - n >= {mostly} * (SELECT count(brand) FROM dim_product) "
           f"THEN 'PASS' ELSE 'FAIL' END") + f" AS status FROM ({q})"
        for i, (kind, column, issue, q, mostly) in enumerate(STORED, 1))),
    "N1_validate_fact_sales": brief([FULL["fact_sales"]]),
    "N1_validate_dim_customer": brief([FULL["dim_customer"]]),
    "N2_validate_all_consolidated": brief(FULL.values()),
    "N2_validate_all_modular": brief(SPLIT.values()),
    "N2_validate_mirror": brief(FULL.values(), "x_"),
    "N3_summary": mirror(SUMMARY),
    "N4_rerun_replaces": with_star(
        f"SELECT 'run-1' AS run_id, DATE '{AS_OF}' AS load_date, table_name, count(*) AS checks, "
        "count(*) FILTER (WHERE status = 'FAIL') AS failed FROM results GROUP BY table_name",
        {"results": results([FULL["dim_store"]])}),
    "N5_ad_hoc_check": with_star("""
SELECT 'fact_sales' AS table_name, 1 AS check_no, 'row_count' AS check_type, '' AS column_name,
  'Validity' AS dimension, CAST(NULL AS VARCHAR) AS issue_id, CAST(1 AS BIGINT) AS evaluated_count,
  CAST(u AS BIGINT) AS unexpected_count, u * 100e0 AS unexpected_pct,
  CASE WHEN u = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(n AS VARCHAR) AS observed_value
FROM (SELECT count(*) AS n, CASE WHEN count(*) BETWEEN 1 AND 1000000 THEN 0 ELSE 1 END AS u FROM fact_sales)"""),
}
