"""Oracles of the K queries."""

from __future__ import annotations

from oracle.anomalies import SHORT, daily_runs, r
from oracle.data import FIELDS, FULL as SUITES
from oracle.defects import PROFIT_BAD, REV_BAD
from oracle.checks import SUMMARY
from oracle.star import AS_OF, mean, pct, score, with_star
from oracle.suites import broken, results

CHECKED = {"results": results(SUITES.values(), "x_")}
ROW_KINDS = {"not_null", "between", "length_between", "in_set", "revenue_identity", "profit_identity"}
HISTORY = daily_runs([c for c in SUITES["fact_sales"].checks if c.kind in ROW_KINDS])
RUNS = f"""
SELECT DATE '{AS_OF}' AS load_date, table_name, dimension, evaluated_count AS total,
  least(unexpected_count, evaluated_count) AS fail,
  {score('(evaluated_count - least(unexpected_count, evaluated_count))', 'evaluated_count')} AS metric_value
FROM results"""
ALL_RUN = "CAST(0 AS BIGINT) AS not_run"
DAILY = f"""
SELECT load_date, 'fact_sales' AS table_name, dimension,
  {mean(score('(total - fail)', 'total'))} AS avg_score, CAST(sum(total - fail) AS BIGINT) AS total_pass,
  CAST(sum(fail) AS BIGINT) AS total_fail, {ALL_RUN}, CASE WHEN sum(fail) = 0 THEN 'PASS' ELSE 'FAIL' END AS overall_status
FROM ({HISTORY}) GROUP BY load_date, dimension"""
DAILY_MIRROR = f"""
SELECT load_date, table_name, dimension, {mean('metric_value')} AS avg_score,
  CAST(sum(total - fail) AS BIGINT) AS total_pass, CAST(sum(fail) AS BIGINT) AS total_fail, {ALL_RUN},
  CASE WHEN sum(fail) = 0 THEN 'PASS' ELSE 'FAIL' END AS overall_status
FROM ({RUNS}) GROUP BY load_date, table_name, dimension"""

# Checks that need groups, other tables or SQL.
LATER = ("'unique', 'compound_unique', 'duplicate_key', 'one_current_row', 'has_current_row', 'distinct_ratio', 'dominance', "
         "'references', 'unexpected_rows'")

ISSUES = [
    ("DQ-001", "dim_customer", "email", "Completeness", "HIGH", "email NOT NULL", 0.99),
    ("DQ-002", "dim_customer", "customer_id,is_current", "Uniqueness", "CRITICAL", "one current row per id", 1.0),
    ("DQ-003", "dim_customer", "email", "Validity", "HIGH", "email format", 0.99),
    ("DQ-004", "dim_customer", "customer_segment", "Validity", "MEDIUM", "segment in approved list", 1.0),
    ("DQ-005", "dim_product", "list_price", "Validity", "HIGH", "list_price > 0", 1.0),
    ("DQ-006", "dim_product", "cost_price,list_price", "Accuracy", "MEDIUM", "cost_price < list_price", 0.99),
    ("DQ-007", "fact_sales", "customer_key", "Consistency", "CRITICAL", "customer_key exists", 1.0),
    ("DQ-008", "fact_sales", "quantity", "Validity", "HIGH", "quantity >= 1", 0.999)]
CATALOGUE = "(VALUES " + ", ".join(f"('{i[0]}', '{i[1]}', '{i[2]}', '{i[3]}', '{i[4]}', '{i[5]}', {i[6]}e0)"
                                   for i in ISSUES) + ") i(issue_id, tab, cols, dim, severity, rule, threshold)"
OPEN = f"(SELECT DISTINCT issue_id FROM results WHERE status = 'FAIL' AND issue_id IS NOT NULL) JOIN {CATALOGUE} USING (issue_id)"
TARGET = ("CASE dimension WHEN 'Completeness' THEN 1e0 WHEN 'Consistency' THEN 1e0 WHEN 'Uniqueness' THEN 1e0 "
          "ELSE 0.995e0 END")
REQUIRED = {t: [f.name for f in fields if f.required] + ["email"] * (t == "dim_customer") for t, fields in FIELDS.items()}
KEY = {t: next(f.name for f in fields if f.primary) for t, fields in FIELDS.items()}
ONE_ROW = ROW_KINDS - {"not_null"} | {"distinct_in_set", "matches", "id_format", "date_order", "open_row_sentinel", "margin",
                                      "not_future", "month_matches", "year_matches", "row_rule"}
VALIDITY = {t: [c for c in s.checks if c.kind in ONE_ROW and c.dimension == "Validity"] for t, s in SUITES.items()}
KEYS = (("customer_key", "dim_customer"), ("product_key", "dim_product"), ("store_key", "dim_store"),
        ("date_key", "dim_date"))


def passing(conditions: list[str], table: str, lead: str = "") -> str:
    return with_star(passing_rows(conditions, table, lead))


def passing_rows(conditions: list[str], table: str, lead: str = "") -> str:
    bad = " OR ".join(f"coalesce({c}, false)" for c in conditions)
    return (f"SELECT {lead}good AS passing, n AS rows, {score('good', 'n')} AS score FROM "
            f"(SELECT count(*) FILTER (WHERE NOT ({bad})) AS good, count(*) AS n FROM {table})")


METRICS = f"""
SELECT q.load_date, s AS overall_quality_score, s - max(s) OVER (ORDER BY q.load_date ROWS BETWEEN 3 PRECEDING AND
    3 PRECEDING) AS score_3day_trend, row_count AS daily_row_count, a7, orphans,
  coalesce(date_diff('day', lag(q.load_date) OVER (ORDER BY q.load_date), q.load_date) * 24, 0) AS age
FROM (SELECT load_date, {mean(score('(total - fail)', 'total'))} AS s FROM ({HISTORY}) GROUP BY load_date) q
JOIN (SELECT load_date, row_count, {r(f'avg(row_count) OVER (ORDER BY load_date {SHORT})', 6)} AS a7 FROM
  (SELECT load_date, count(*) AS row_count FROM dated_sales GROUP BY load_date)) v ON q.load_date = v.load_date
JOIN (SELECT load_date, count(*) FILTER (WHERE customer_key NOT IN (SELECT customer_key FROM dim_customer)) AS orphans
  FROM dated_sales GROUP BY load_date) o ON q.load_date = o.load_date"""
RULES = [("ALT-001", "critical", "overall_quality_score < 0.95"), ("ALT-002", "critical", "orphans > 0"),
         ("ALT-003", "high", "age > 24"), ("ALT-004", "high", "daily_row_count < a7 * 0.5"),
         ("ALT-005", "medium", "score_3day_trend < -0.01"), ("ALT-006", "critical", "(SELECT count(*) FROM (SELECT customer_id FROM x_dim_customer GROUP BY customer_id "
          "HAVING count(*) FILTER (WHERE is_current) > 1)) > 0")]

ORACLE = {
    "K1_daily_scores": with_star(DAILY),
    "K1_daily_scores_mirror": with_star(DAILY_MIRROR, CHECKED),
    "K2_table_scorecard": with_star(f"""
SELECT table_name, {', '.join(f"max(CASE WHEN dimension = '{d}' THEN avg_score END) AS {d.lower()}" for d in
                              ('Completeness', 'Accuracy', 'Consistency', 'Uniqueness', 'Validity'))},
  round(avg(avg_score), 10) AS overall_score, {ALL_RUN} FROM ({DAILY_MIRROR}) GROUP BY table_name""", CHECKED),
    "K3_trend": with_star(f"""
SELECT load_date, round(avg(avg_score), 10) AS overall,
  round(avg(avg_score) FILTER (WHERE dimension = 'Validity'), 10) AS validity,
  round(avg(avg_score) FILTER (WHERE dimension = 'Consistency'), 10) AS consistency, 0.995e0 AS target_line
FROM ({DAILY}) WHERE load_date >= DATE '2001-08-01' - INTERVAL 30 DAY GROUP BY load_date"""),
    "K4_active_issues": with_star(f"""
SELECT severity, count(*) AS issue_count, string_agg(issue_id, ',' ORDER BY issue_id) AS issue_ids FROM {OPEN}
GROUP BY severity""", CHECKED),
    "K6_overall_score": with_star(f"SELECT dimension, {mean('metric_value')} AS score, {ALL_RUN} FROM ({RUNS}) "
                                  "GROUP BY ROLLUP (dimension)", CHECKED),
    "K6_overall_score_on_write": with_star(f"""
SELECT dimension, score, not_run
FROM (SELECT dimension, count(*) FILTER (WHERE check_type IN ({LATER})) AS not_run FROM fact_results GROUP BY ROLLUP (dimension)) a
LEFT JOIN (SELECT dimension AS d, {mean('metric_value')} AS score FROM
  (SELECT dimension, {score('(evaluated_count - least(unexpected_count, evaluated_count))', 'evaluated_count')} AS metric_value
   FROM fact_results WHERE check_type NOT IN ({LATER})) GROUP BY ROLLUP (dimension)) b ON a.dimension IS NOT DISTINCT FROM b.d""",
        {**CHECKED, "fact_results": "SELECT * FROM results WHERE table_name = 'fact_sales'"}),
    "K6_hours_since_last_run": with_star(
        "SELECT round(date_sub('minute', max(load_timestamp), TIMESTAMP '2024-02-01 00:00:00') / 60e0, 4) "
        "AS hours_since_last_run FROM load_log"),
    "K7_completeness": with_star(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, filled, expected, {score('filled', 'expected')} AS score FROM (SELECT "
        f"{' + '.join(f'count({c})' for c in names)} AS filled, count(*) * {len(names)} AS expected FROM x_{t})"
        for t, names in REQUIRED.items())),
    "K8_accuracy": passing([REV_BAD, PROFIT_BAD], "x_fact_sales"),
    "K9_consistency": passing([f"{c} NOT IN (SELECT {c} FROM x_{t})" for c, t in KEYS], "x_fact_sales"),
    "K10_uniqueness": with_star(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, d AS distinct_keys, n AS rows, {score('d', 'n')} AS score FROM "
        f"(SELECT count(DISTINCT {k}) AS d, count(*) AS n FROM x_{t})" for t, k in KEY.items())),
    "K11_validity": with_star(" UNION ALL ".join(
        passing_rows([broken(c) for c in checks], f"x_{t}", f"'{t}' AS table_name, ")
        for t, checks in VALIDITY.items())),
    "K12_timeliness": with_star(f"""
SELECT t AS table_name, e AS expected, n AS loads, early AS on_time, {pct('early', 'e')} AS timeliness_pct,
  {pct('(e - early)', 'e')} AS breach_pct
FROM (SELECT t, CAST(any_value(due) AS BIGINT) AS e, count(load_timestamp) AS n,
    count(*) FILTER (WHERE load_timestamp < CAST(load_date AS TIMESTAMP) + INTERVAL 6 HOUR) AS early
  FROM (VALUES ('fact_sales', 46, 'd'), ('dim_customer', 46, 'd'), ('dim_product', 46, 'd'), ('dim_store', 7, 'w'),
      ('dim_date', 0, 'y')) s(t, due, every)
  LEFT JOIN load_log ON table_name = t AND load_date BETWEEN DATE '2024-01-01' AND DATE '2024-02-15'
    AND (every = 'd' OR every = 'w' AND isodow(load_date) = 1)
  GROUP BY t)"""),
    "K13_response_times": """
SELECT count(*) AS incidents, round(avg(date_sub('second', injected_at, alerted_at) / 3600e0), 4) AS mttd_hours,
  round(avg(date_sub('second', alerted_at, resolved_at) / 3600e0), 4) AS mttr_hours,
  count(*) FILTER (WHERE errors > 1 AND resolved_at IS NULL) AS open_critical
FROM (SELECT min(ts) FILTER (WHERE event_type = 'error') AS injected_at,
    max(ts) FILTER (WHERE event_type = 'error') AS alerted_at,
    nullif(max(ts), max(ts) FILTER (WHERE event_type = 'error')) AS resolved_at,
    count(*) FILTER (WHERE event_type = 'error') AS errors
  FROM events GROUP BY user_id, CAST(ts AS DATE)) WHERE errors > 0""",
    "K13_issue_episodes": with_star(f"""
SELECT metric_name AS issue_id, count(*) AS episodes, CAST(sum(bad_days) AS BIGINT) AS failing_runs, min(opened) AS first_opened,
  max(resolved) AS last_resolved, count(*) FILTER (WHERE resolved IS NULL) AS open_now,
  round(avg(date_diff('day', opened, resolved) * 24e0), 4) AS mttr_hours
FROM (SELECT metric_name, day_no - bad_no AS island, min(load_date) AS opened, count(*) AS bad_days, max(after) AS resolved
  FROM (SELECT metric_name, load_date, day_no, row_number() OVER (PARTITION BY metric_name ORDER BY load_date) AS bad_no,
      (SELECT min(d) FROM (SELECT DISTINCT load_date AS d FROM dated_sales) days WHERE d > h.load_date) AS after
    FROM (SELECT metric_name, load_date, fail, row_number() OVER (PARTITION BY metric_name ORDER BY load_date) AS day_no
      FROM ({HISTORY})) h WHERE fail > 0) GROUP BY metric_name, island)
GROUP BY metric_name"""),
    "K14_summary": with_star(SUMMARY, {"results": results(SUITES.values())}),
    "K15_against_target": with_star(f"""
SELECT dimension, score, {TARGET} AS target, round(score - {TARGET}, 8) + CAST(0 AS DOUBLE) AS gap,
  CASE WHEN score >= {TARGET} THEN 'ON_TARGET' ELSE 'BELOW_TARGET' END AS status
FROM (SELECT dimension, {mean('metric_value')} AS score FROM ({RUNS}) GROUP BY dimension)""", CHECKED),
    "K16_issue_catalogue": with_star(f"""
SELECT issue_id, tab AS table_name, cols AS columns, dim AS dimension, i.severity AS severity, rule, threshold,
  checks, failed_checks, volume, volume_pct, CASE WHEN failed_checks > 0 THEN 'FAIL' ELSE 'PASS' END AS status
FROM (SELECT issue_id, count(*) AS checks, count(*) FILTER (WHERE status = 'FAIL') AS failed_checks,
    max(unexpected_count) AS volume, max(unexpected_pct) AS volume_pct
  FROM results WHERE issue_id IS NOT NULL GROUP BY issue_id) JOIN {CATALOGUE} USING (issue_id)""", CHECKED),
    "K17_alerts": with_star(" UNION ALL ".join(
        f"SELECT '{a}' AS alert_id, '{sev}' AS severity, count(*) AS evaluations, "
        f"count(*) FILTER (WHERE {cond}) AS triggered FROM metrics" for a, sev, cond in RULES), {"metrics": METRICS}),
    "K17_alert_cooldown": with_star("""
SELECT tab AS table_name, a AS alert_id, CAST(tm AS DATE) AS evaluated_on, count(*) AS evaluations,
  count(*) FILTER (WHERE hit) AS triggered, count(*) FILTER (WHERE hit AND NOT fresh) AS suppressed,
  count(*) FILTER (WHERE hit AND fresh) AS fired
FROM (WITH RECURSIVE loads AS (
      SELECT l.table_name AS tab, l.load_date AS d, l.load_timestamp AS tm, n, orphans, twice, (good * 20000 + n) // (n * 2) AS s
      FROM load_log l JOIN (SELECT table_name, d, sum(n) AS n, sum(good) AS good, sum(orphans) AS orphans,
          count(*) FILTER (WHERE n > 1) AS twice
        FROM (SELECT CASE event_type WHEN 'click' THEN 'fact_sales' WHEN 'view' THEN 'dim_customer'
              WHEN 'purchase' THEN 'dim_product' WHEN 'signup' THEN 'dim_store' ELSE 'dim_date' END AS table_name,
            CAST(ts AS DATE) AS d, user_id, count(*) AS n, count(*) FILTER (WHERE value >= 1) AS good,
            count(*) FILTER (WHERE user_id NOT IN (SELECT customer_key FROM dim_customer)) AS orphans
          FROM events GROUP BY ALL) GROUP BY table_name, d) m ON m.table_name = l.table_name AND m.d = l.load_date),
    metrics AS (SELECT *, date_sub('second', lag(tm) OVER w, tm) AS age, s - lag(s, 3) OVER w AS trend,
        sum(n) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS n7,
        count(*) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS c7
      FROM loads WINDOW w AS (PARTITION BY tab ORDER BY d)),
    judged AS (SELECT tab, a, cool, tm, coalesce(CASE a WHEN 'ALT-001' THEN s < 9500 WHEN 'ALT-002' THEN orphans > 0
          WHEN 'ALT-003' THEN age > 86400 WHEN 'ALT-004' THEN n * 2 * c7 < n7 WHEN 'ALT-005' THEN trend < -100
          ELSE twice > 0 END, false) AS hit
      FROM metrics, (VALUES ('ALT-001', 60), ('ALT-002', 0), ('ALT-003', 120), ('ALT-004', 60), ('ALT-005', 1440),
        ('ALT-006', 0)) r(a, cool)),
    timeline AS (SELECT tab, a, cool, tm, row_number() OVER (PARTITION BY tab, a ORDER BY tm) AS rn,
        (SELECT max(CAST(d AS TIMESTAMP) - INTERVAL 1 HOUR) FROM loads l
         WHERE l.tab = j.tab AND day(d) % 10 = 0 AND CAST(d AS TIMESTAMP) - INTERVAL 1 HOUR <= j.tm) AS sent
      FROM judged j WHERE hit),
    fold AS (
      SELECT tab, a, rn, tm, sent IS NULL OR sent + to_minutes(cool) <= tm AS fresh,
        CASE WHEN sent IS NULL OR sent + to_minutes(cool) <= tm THEN tm ELSE sent END AS latest
      FROM timeline WHERE rn = 1
      UNION ALL
      SELECT t.tab, t.a, t.rn, t.tm, greatest(f.latest, t.sent) + to_minutes(t.cool) <= t.tm,
        CASE WHEN greatest(f.latest, t.sent) + to_minutes(t.cool) <= t.tm THEN t.tm ELSE greatest(f.latest, t.sent) END
      FROM fold f JOIN timeline t ON t.tab = f.tab AND t.a = f.a AND t.rn = f.rn + 1)
  SELECT j.tab, j.a, j.tm, hit, coalesce(fresh, false) AS fresh FROM judged j LEFT JOIN fold f
    ON f.tab = j.tab AND f.a = j.a AND f.tm = j.tm)
GROUP BY ALL"""),
    "K18_failures_by_severity": with_star(f"""
SELECT coalesce(i.severity, upper(r.severity), 'UNCLASSIFIED') AS severity, count(*) AS failed_checks,
  count(DISTINCT r.issue_id) AS issues
FROM results r LEFT JOIN {CATALOGUE} ON r.issue_id = i.issue_id WHERE status = 'FAIL' GROUP BY 1""", CHECKED),
}
