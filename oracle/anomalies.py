"""Oracles of the H queries."""

from __future__ import annotations

from oracle.data import FULL
from oracle.star import mean, score, with_star

NOW = "2024-01-20 07:30:00"
SHORT, LONG = "ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING", "ROWS BETWEEN 29 PRECEDING AND 1 PRECEDING"


def r(expr: str, digits: int) -> str:
    return f"round({expr}, {digits}) + CAST(0 AS DOUBLE)"


def volume(table: str, series: str = "") -> str:
    lead, part = (f"{series}, ", f"PARTITION BY {series} ") if series else ("", "")
    return f"""SELECT *, avg(row_count) OVER ({part}ORDER BY load_date {SHORT}) AS a7,
  avg(row_count) OVER ({part}ORDER BY load_date {LONG}) AS a30,
  stddev_samp(row_count) OVER ({part}ORDER BY load_date {LONG}) AS s30
FROM (SELECT {lead}load_date, count(*) AS row_count FROM {table} GROUP BY {lead}load_date)"""


def bands(table: str, series: str = "") -> str:
    z7 = "(row_count - a7) / nullif(s30, 0)"
    return with_star(f"""
SELECT {series + ', ' if series else ''}load_date, row_count, {r('a7', 6)} AS rolling_7d_avg,
  {r('a7 * 0.5', 0)} AS lower_bound_50pct, {r('a7 * 1.5', 0)} AS upper_bound_50pct,
  CASE WHEN row_count < a7 * 0.5 THEN 'LOW_VOLUME_ALERT' WHEN row_count > a7 * 1.5 THEN 'HIGH_VOLUME_ALERT'
       ELSE 'NORMAL' END AS volume_status, {r(z7, 2)} AS z_score,
  coalesce(row_count < a7 * 0.5 OR abs({z7}) > 3, false) AS alert FROM ({volume(table, series)})""")


Z30 = "(row_count - a30) / nullif(s30, 0)"
FLAGS = f"""
SELECT load_date, row_count, {r('a7', 0)} AS rolling_7d_avg, {r('a30', 0)} AS rolling_30d_avg,
  {r('a7 * 0.5', 0)} AS lower_bound_50pct, {r(Z30, 2)} AS z_score,
  CASE WHEN row_count < a7 * 0.5 THEN 'SEVERE_DROP' WHEN abs({Z30}) > 3 THEN 'STATISTICAL_ANOMALY'
       WHEN row_count > a7 * 1.5 THEN 'HIGH_VOLUME' ELSE 'NORMAL' END AS anomaly_flag FROM """
REVENUE = f"""SELECT *, avg(total_revenue) OVER (ORDER BY date_key {LONG}) AS a30,
  stddev_samp(total_revenue) OVER (ORDER BY date_key {LONG}) AS s30
FROM (SELECT date_key, CAST(sum(net_revenue) AS DOUBLE) AS total_revenue FROM dated_sales GROUP BY date_key)"""
ZR = "(total_revenue - a30) / nullif(s30, 0)"
REVENUE_FLAGS = f"""SELECT date_key, total_revenue, {r('a30', 2)} AS expected_avg, {r(ZR, 2)} AS z_score,
  CASE WHEN abs({ZR}) > 3 THEN 'REVENUE_ANOMALY' ELSE 'NORMAL' END AS anomaly_flag FROM ({REVENUE})"""


def sla(now: str) -> str:
    return with_star(f"""
SELECT CAST(TIMESTAMP '{now}' AS DATE) AS check_date,
  round(date_sub('second', max(load_timestamp), TIMESTAMP '{now}') / 3600e0, 4) AS hours_since_load,
  CASE WHEN max(load_timestamp) < CAST(TIMESTAMP '{now}' AS DATE) + TIME '06:00:00' THEN 'SLA_MET'
       ELSE 'SLA_BREACH' END AS sla_status
FROM load_log WHERE table_name = 'fact_sales' AND load_date = CAST(TIMESTAMP '{now}' AS DATE)""")


MAX_AGE = {"dim_customer": 24, "dim_product": 168, "dim_store": 720, "dim_date": 8760, "fact_sales": 24}
CHECKS = FULL["fact_sales"].only(lambda c: c.kind in ("between", "revenue_identity")).checks


def daily_runs(checks) -> str:
    """(load_date, dimension, total, fail) per check and day."""
    from oracle.suites import COLUMN_KINDS, broken
    return " UNION ALL ".join(
        f"SELECT load_date, '{c.dimension}' AS dimension, '{c.kind}:{c.column_name}' AS metric_name, "
        f"{f'count({c.column_name})' if c.kind in COLUMN_KINDS else 'count(*)'} AS total, "
        f"count(*) FILTER (WHERE {broken(c)}) AS fail FROM dated_sales GROUP BY load_date" for c in checks)


def trends(daily: str, series: str = "") -> str:
    part = f"PARTITION BY {series} " if series else ""
    lead = f"{series}, " if series else ""
    return f"""
SELECT {lead}load_date, score, {r('change', 6)} AS change, declines = 3 AS declining_3_days,
  low_days = 7 AS below_target_7_days, coalesce(change < -0.02, false) AS sudden_drop
FROM (SELECT *, sum(CASE WHEN change < 0 THEN 1 ELSE 0 END) OVER ({part}ORDER BY load_date
    ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS declines,
  sum(CASE WHEN score < 0.995 THEN 1 ELSE 0 END) OVER ({part}ORDER BY load_date
    ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS low_days
  FROM (SELECT *, score - lag(score) OVER ({part}ORDER BY load_date) AS change FROM ({daily})))"""


def limits(table: str, low: int, high: int) -> str:
    return with_star(f"""
SELECT load_date, count(*) AS row_count, CASE WHEN count(*) < {low} THEN 'BELOW_MINIMUM'
  WHEN count(*) > {high} THEN 'ABOVE_MAXIMUM' ELSE 'IN_RANGE' END AS status FROM {table} GROUP BY load_date""")


def timely(now: str, due: dict[str, str], seen: str = "true") -> str:
    """Due days are worked out by hand: yesterday or today, the last Monday, the last day of the year before."""
    return with_star(f"""
SELECT t AS table_name, CAST(due AS DATE) AS due_date, last_load_date,
  CAST(date_sub('minute', due + INTERVAL 6 HOUR, coalesce(landed, TIMESTAMP '{now}')) AS BIGINT) AS delay_minutes,
  CASE WHEN last_load_date IS NULL THEN 'NEVER_LOADED' WHEN landed IS NULL THEN 'MISSING'
       WHEN landed < due + INTERVAL 6 HOUR THEN 'ON_TIME' ELSE 'LATE' END AS status
FROM (SELECT t, due, max(load_date) AS last_load_date, min(load_timestamp) FILTER (WHERE load_date >= due) AS landed
  FROM (VALUES {', '.join(f"('{t}', TIMESTAMP '{d}')" for t, d in due.items())}) e(t, due)
  LEFT JOIN (SELECT * FROM load_log WHERE load_timestamp <= TIMESTAMP '{now}' AND {seen}) l ON t = l.table_name
  GROUP BY t, due)""")


ORACLE = {
    "H1_volume_bands": bands("daily_load"),
    "H1_volume_bands_sales": bands("dated_sales"),
    "H1_volume_bands_per_feed": bands("daily_load", "event_type"),
    "H2_volume_flags": with_star(FLAGS + f"({volume('daily_load')})"),
    "H2_volume_flag_today": with_star(
        FLAGS + "(" + volume("(SELECT * FROM daily_load WHERE load_date >= DATE '2024-01-24' - INTERVAL 31 DAY)")
        + ") WHERE load_date = DATE '2024-01-24'"),
    "H3_revenue_flags": with_star(REVENUE_FLAGS + " ORDER BY date_key DESC LIMIT 10"),
    "H3_revenue_flags_all_days": with_star(REVENUE_FLAGS),
    "H4_revenue_spikes": with_star(f"SELECT date_key, total_revenue, {r('a30', 2)} AS baseline, "
                                   f"coalesce(total_revenue > a30 * 3, false) AS spike FROM ({REVENUE})"),
    "H5_freshness_sla": sla(NOW),
    "H5_freshness_sla_nothing_loaded": sla("2024-03-01 07:30:00"),
    "H6_freshness_age": with_star(f"""
SELECT table_name, age AS age_hours, CAST(allowed AS BIGINT) AS max_age_hours,
  CASE WHEN age <= allowed THEN 'FRESH' ELSE 'STALE' END AS status
FROM (SELECT table_name, round(date_sub('second', max(load_timestamp), TIMESTAMP '2024-02-02 12:00:00') / 3600e0, 4)
    AS age, CASE table_name {' '.join(f"WHEN '{t}' THEN {h}" for t, h in MAX_AGE.items())} END AS allowed
  FROM load_log GROUP BY table_name)"""),
    "H6_freshness_never_loaded": with_star(f"""
SELECT t AS table_name, CASE WHEN t <> 'dim_store' THEN round(date_sub('second', last, TIMESTAMP '2024-02-02 12:00:00')
    / 3600e0, 4) END AS age_hours, CAST(allowed AS BIGINT) AS max_age_hours,
  CASE WHEN t <> 'dim_store' AND date_sub('second', last, TIMESTAMP '2024-02-02 12:00:00') / 3600e0 <= allowed
    THEN 'FRESH' ELSE 'STALE' END AS status
FROM (VALUES {', '.join(f"('{t}', {h})" for t, h in MAX_AGE.items())}) a(t, allowed)
LEFT JOIN (SELECT table_name, max(load_timestamp) AS last FROM load_log GROUP BY table_name) l ON t = l.table_name"""),
    "H7_timeliness": timely("2024-01-20 05:30:00", {
        "fact_sales": "2024-01-19", "dim_customer": "2024-01-19", "dim_product": "2024-01-19",
        "dim_store": "2024-01-15", "dim_date": "2023-12-31"}),
    "H7_timeliness_stale": timely("2024-03-05 07:30:00", {
        "fact_sales": "2024-03-05", "dim_customer": "2024-03-05", "dim_product": "2024-03-05",
        "dim_store": "2024-03-04", "dim_date": "2023-12-31"}, "table_name <> 'dim_date'"),
    "H8_daily_limits": limits("daily_load", 100, 600),
    "H8_daily_limits_sales": limits("dated_sales", 50000, 500000),
    "H9_score_trends": with_star(trends(
        f"SELECT load_date, {mean(score('(total - fail)', 'total'))} AS score FROM ({daily_runs(CHECKS)}) "
        "GROUP BY load_date")),
    "H9_score_trends_per_feed": with_star(trends(
        "SELECT event_type, load_date, least(round(count(*) / 60e0, 6), 1e0) AS score FROM daily_load "
        "GROUP BY event_type, load_date", "event_type")),
}
