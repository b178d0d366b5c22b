"""Oracles of the T queries."""

from __future__ import annotations

from oracle.anomalies import LONG, SHORT
from oracle.data import CONTRACT, FIELDS, RULES, by_kind, matching
from oracle.profiles import ORPHAN_REPORT
from oracle.star import score, with_star
from oracle.suites import BRIEF, brief, results

EMAIL = "'^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$'"
REV_BAD = "abs(net_revenue - (quantity * unit_price - discount_amount)) > 0.01"
PROFIT_BAD = "abs(gross_profit - (net_revenue - quantity * unit_cost)) > 0.01"
NOW = "TIMESTAMP '2024-02-02 12:00:00'"


def of_kind(*kinds: str) -> str:
    return brief(by_kind(CONTRACT, *kinds).values())


def row_rules(*columns: str) -> str:
    return brief(matching(CONTRACT, lambda c: c.kind == "row_rule" and c.column_name in columns).values())


def field_type(table: str, f) -> str:
    limit = f.length
    longest = f"CAST(max(length({f.name})) AS BIGINT)" if limit else "CAST(NULL AS BIGINT)"
    fits = f"coalesce(max(length({f.name})), 0) <= {limit}" if limit else "count(*) >= 0"
    return (f"SELECT '{table}' AS table_name, '{f.name}' AS column_name, '{f.type}' AS declared_type, "
            f"{longest} AS max_length, {fits} AS conforms FROM {table}")


def level(table: str, name: str, measured: str, required: float) -> str:
    return (f"SELECT '{table}' AS table_name, '{name}' AS service_level, measured, {required}e0 AS required, "
            f"CASE WHEN measured >= {required}e0 THEN 'MET' ELSE 'MISSED' END AS status "
            f"FROM (SELECT CAST(({measured}) AS DOUBLE) AS measured)")


def complete(table: str) -> str:
    names = [f.name for f in FIELDS[table] if f.required]
    return (f"SELECT {score('a', 'b')} FROM (SELECT {' + '.join(f'count({n})' for n in names)} AS a, "
            f"count(*) * {len(names)} AS b FROM {table})")


def good(table: str, *conditions: str) -> str:
    bad = " OR ".join(f"coalesce({c}, false)" for c in conditions)
    return (f"SELECT {score('a', 'b')} FROM (SELECT count(*) FILTER (WHERE NOT ({bad})) AS a, count(*) AS b "
            f"FROM {table})")


def on_time(table: str) -> str:
    """Of the loads due on the 30 days before NOW."""
    return ("SELECT (floor(count(*) FILTER (WHERE load_timestamp < CAST(load_date AS TIMESTAMP) + INTERVAL 6 HOUR) "
            f"* 10000e0 / 30 + 0.5) / 100) / 100 FROM load_log WHERE table_name = '{table}' "
            "AND load_date BETWEEN DATE '2024-01-03' AND DATE '2024-02-01'")


def worse(*measures: str) -> str:
    return "SELECT least(" + ", ".join(f"({m})" for m in measures) + ")"


def fresh(table: str, hours: int) -> str:
    return (f"SELECT CASE WHEN date_sub('second', max(load_timestamp), {NOW}) / 3600e0 <= {hours} THEN 1 ELSE 0 END "
            f"FROM load_log WHERE table_name = '{table}'")


ORPHAN_FREE = good("fact_sales", *[f"{c} NOT IN (SELECT {c} FROM {t})" for c, t in (
    ("customer_key", "dim_customer"), ("product_key", "dim_product"), ("store_key", "dim_store"),
    ("date_key", "dim_date"))])
LEVELS = [
    level("dim_customer", "availability", on_time("dim_customer"), 0.999),
    level("dim_customer", "freshness", fresh("dim_customer", 24), 1.0),
    level("dim_customer", "completeness", complete("dim_customer"), 1.0),
    level("dim_customer", "accuracy", good("dim_customer", f"NOT regexp_matches(email, {EMAIL})"), 0.99),
    level("dim_customer", "uniqueness", worse(
        f"SELECT {score('a', 'b')} FROM (SELECT count(DISTINCT customer_key) AS a, count(*) AS b FROM dim_customer)",
        f"SELECT {score('a', 'b')} FROM (SELECT count(*) FILTER (WHERE n <= 1) AS a, count(*) AS b FROM (SELECT "
        "count(*) FILTER (WHERE is_current) AS n FROM dim_customer GROUP BY customer_id))"), 1.0),
    level("dim_product", "freshness", fresh("dim_product", 168), 1.0),
    level("dim_product", "completeness", complete("dim_product"), 1.0),
    level("dim_product", "accuracy", good("dim_product", "NOT (cost_price < list_price)",
                                            "is_active AND list_price <= 0"), 0.99),
    level("dim_store", "freshness", fresh("dim_store", 720), 1.0),
    level("dim_store", "completeness", complete("dim_store"), 1.0),
    level("dim_date", "freshness", fresh("dim_date", 8760), 1.0),
    level("dim_date", "completeness", worse(complete("dim_date"), f"SELECT {score('a', 'b')} FROM (SELECT "
          "count(DISTINCT full_date) AS a, date_diff('day', min(full_date), max(full_date)) + 1 AS b FROM dim_date)"), 1.0),
    level("fact_sales", "availability", on_time("fact_sales"), 0.995),
    level("fact_sales", "freshness", fresh("fact_sales", 24), 1.0),
    level("fact_sales", "completeness", worse(complete("fact_sales"), ORPHAN_FREE), 0.999),
    level("fact_sales", "accuracy", good("fact_sales", REV_BAD, PROFIT_BAD), 0.995),
    level("fact_sales", "consistency", ORPHAN_FREE, 1.0),
    level("fact_sales", "volume", f"""
SELECT avg(CASE WHEN n BETWEEN 50000 AND 500000 AND coalesce(n >= round(a7, 6) * 0.5, true) THEN 1e0 ELSE 0e0 END)
FROM (SELECT n, avg(n) OVER (ORDER BY load_date {SHORT}) AS a7
  FROM (SELECT load_date, count(*) AS n FROM dated_sales GROUP BY load_date))""", 1.0),
    level("fact_sales", "referential_integrity", ORPHAN_FREE, 1.0),
]


def catalogue(prefix: str = "") -> str:
    return with_star("""
SELECT rule_id, table_name, count(*) AS checks, CAST(sum(unexpected_count) AS BIGINT) AS violations,
  max(mostly) AS threshold, CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' ELSE 'PASS' END AS status
FROM results GROUP BY rule_id, table_name""", {"results": results(RULES.values(), prefix)})


ORACLE = {
    "T1c_contract_suite": brief(CONTRACT.values()),
    "T1c_contract_suite_mirror": with_star(f"SELECT {BRIEF}, severity FROM results",
                                           {"results": results(CONTRACT.values(), "x_")}),
    "T2c_field_types": with_star(" UNION ALL ".join(field_type(t, f) for t, fields in FIELDS.items() for f in fields)),
    "T3c_not_null": of_kind("not_null"),
    "T4c_unique": of_kind("unique"),
    "T5c_range": of_kind("between"),
    "T6c_pattern": of_kind("matches"),
    "T7c_length": of_kind("length_between"),
    "T8c_enum": of_kind("in_set"),
    "T9c_cross_field": row_rules("cost_price"),
    "T10c_consistency": row_rules("month_number"),
    "T11c_formula": row_rules("net_revenue", "gross_profit"),
    "T12c_referential_integrity": of_kind("references"),
    "T13c_compound_unique": of_kind("compound_unique"),
    "T14c_service_levels": with_star(" UNION ALL ".join(LEVELS)),
    "T15c_rule_catalogue": catalogue(),
    "T15c_rule_catalogue_mirror": catalogue("x_"),
    "T16c_integrity_policy": ORPHAN_REPORT,
    "T17c_anomaly_rules": with_star(f"""
SELECT 'volume' AS rule, 'high' AS severity, count(*) AS evaluated, count(*) FILTER (WHERE n < a7 * 0.5) AS triggered
FROM (SELECT n, avg(n) OVER (ORDER BY load_date {SHORT}) AS a7 FROM
  (SELECT load_date, count(*) AS n FROM dated_sales GROUP BY load_date))
UNION ALL SELECT 'freshness', 'critical', 1, CASE WHEN age <= 24 THEN 0 ELSE 1 END FROM
  (SELECT date_sub('second', max(load_timestamp), {NOW}) / 3600e0 AS age FROM load_log
   WHERE table_name = 'fact_sales')
UNION ALL SELECT 'revenue_spike', 'high', count(*), count(*) FILTER (WHERE t > a30 * 3) FROM
  (SELECT t, avg(t) OVER (ORDER BY load_date {LONG}) AS a30 FROM
    (SELECT load_date, CAST(sum(net_revenue) AS DOUBLE) AS t FROM dated_sales GROUP BY load_date))"""),
    "T18c_pii_columns": with_star(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, 'PII' AS classification, count({f.name}) AS filled "
        f"FROM {t}" for t, fields in FIELDS.items() for f in fields if f.pii)),
    "T18c_sample_without_pii": with_star(f"""
SELECT * EXCLUDE (email, customer_name) FROM (SELECT * FROM dim_customer WHERE NOT regexp_matches(email, {EMAIL})
ORDER BY customer_key LIMIT 20)"""),
}
