"""Quality scores: from check results to run history, scorecards, trends and issue lists."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import keys as K
from plumbline.functions import predicates as P
from plumbline.operators import anomaly
from plumbline.operators.checks import Check, Suite
from plumbline.operators.integrity import RELATIONSHIPS
from plumbline.operators.validate import COLUMN_KINDS, is_row_local, violation
from plumbline.sources.schemas import schema

TARGET = 0.995


# --- run history ---------------------------------------------------------------------------------------------------

def share(part: Column, whole: Column) -> Column:
    """Exact score between 0 and 1 with four decimals; 1 when there was nothing to judge."""
    whole = whole.cast("decimal(18,0)")
    return F.coalesce(F.round(part.cast("decimal(18,0)") / F.nullif(whole, F.lit(0)), 4),
                      F.lit(1)).cast("decimal(8,4)")


def runs_of(results: DataFrame, load_date: dt.date | str, run_id: int = 1, run_ts: str | None = None) -> DataFrame:
    """Check results as rows of the run history, in its declared columns. A check that was not run has no score."""
    total = F.coalesce("evaluated_count", "unexpected_count")
    failed = F.least("unexpected_count", total)
    issues = F.when(F.col("issue_id").isNotNull(), F.array("issue_id")).otherwise(F.array().cast("array<string>"))
    fields = {
        "run_id": F.lit(run_id), "run_timestamp": F.lit(run_ts or str(load_date)), "table_name": F.col("table_name"),
        "dimension": F.col("dimension"), "metric_name": F.concat_ws(":", "check_type", "column_name"),
        "metric_value": F.when(F.col("status") != "NOT_RUN", share(total - failed, total)), "pass_count": total - failed, "fail_count": failed,
        "total_count": total, "status": F.col("status"), "issue_ids": issues, "load_date": F.lit(str(load_date))}
    declared = schema("validation_runs")
    return results.select(*[fields[f.name].cast(f.dataType).alias(f.name) for f in declared.fields])


def daily_runs(df: DataFrame, suite: Suite, day: str = "load_date", as_of=None,
               more: Mapping[str, Column] | None = None) -> DataFrame:
    """Run history rebuilt per day: every row-local check of the suite for every day, from one scan and one shuffle.

    The shuffle carries one partial row per day and task. ``more`` are further aggregates of the day, taken in the same
    scan and repeated on its rows.
    """
    more = dict(more or {})
    checks = [c for c in suite.checks if is_row_local(c)]
    aggregates: dict[str, Column] = {"n": F.count(F.lit(1))}
    rows = []
    for c in checks:
        total = "n"
        if c.kind in COLUMN_KINDS:
            total = f"c_{c.column_name}"
            aggregates.setdefault(total, F.count(c.column_name))
        aggregates[f"u{c.no}"] = F.count_if(violation(c, df, as_of))
        rows.append(f"named_struct('dimension', '{c.dimension}', 'metric_name', '{c.kind}:{c.column_name}', "
                    f"'total_count', {total}, 'fail_count', u{c.no})")
    per_day = df.groupBy(day).agg(*[e.alias(n) for n, e in {**aggregates, **more}.items()])
    long = per_day.selectExpr(f"{day} as load_date", *more, f"inline(array({', '.join(rows)}))")
    passed = F.col("total_count") - F.col("fail_count")
    return long.select("load_date", F.lit(suite.table).alias("table_name"), "dimension", "metric_name",
                       share(passed, F.col("total_count")).alias("metric_value"), passed.alias("pass_count"),
                       "fail_count", "total_count",
                       F.when(F.col("fail_count") == 0, "PASS").otherwise("FAIL").alias("status"), *more)


def mean_score(column: str = "metric_value") -> Column:
    """Mean of exact decimal scores, rounded half up to eight decimals."""
    return F.round(F.avg(column), 8).cast("double")


def daily_scores(runs: DataFrame) -> DataFrame:
    """Average score, passes, failures, checks not run and status per day, table and dimension.

    Checks that were not run are in no average; without a failure they keep the status from being a pass.
    """
    counted = lambda column: F.coalesce(F.sum(column), F.lit(0))
    return runs.groupBy("load_date", "table_name", "dimension").agg(
        mean_score().alias("avg_score"), counted("pass_count").alias("total_pass"),
        counted("fail_count").alias("total_fail"), not_run().alias("not_run"),
        F.when(counted("fail_count") > 0, "FAIL").when(not_run() > 0, "NOT_RUN").otherwise("PASS").alias("overall_status"))


def not_run() -> Column:
    return F.count_if(F.col("status") == "NOT_RUN")


# Dimensions shown on the table scorecard.
SCORECARD = ("Completeness", "Accuracy", "Consistency", "Uniqueness", "Validity")


def table_scorecard(scores: DataFrame, load_date: str) -> DataFrame:
    """One row per table with a column per dimension and the mean of all, worst first."""
    today = scores.where(F.col("load_date") == F.lit(load_date).cast("date"))
    return (today.groupBy("table_name")
            .agg(*[F.max(F.when(F.col("dimension") == d, F.col("avg_score"))).alias(d.lower()) for d in SCORECARD],
                 P.rounded(F.avg("avg_score"), 10).alias("overall_score"), F.sum("not_run").alias("not_run"))
            .orderBy("overall_score", "table_name"))


def trend(scores: DataFrame, as_of: str, days: int = 30, target: float = TARGET) -> DataFrame:
    """Overall, validity and consistency score of the last days, with the target."""
    only = lambda d: P.rounded(F.avg(F.when(F.col("dimension") == d, F.col("avg_score"))), 10)
    return (scores.where(F.col("load_date") >= F.date_sub(P.as_date(as_of), days))
            .groupBy("load_date")
            .agg(P.rounded(F.avg("avg_score"), 10).alias("overall"), only("Validity").alias("validity"),
                 only("Consistency").alias("consistency"))
            .withColumn("target_line", F.lit(target)).orderBy("load_date"))


def overall(runs: DataFrame) -> DataFrame:
    """Score per dimension and over all of them (dimension NULL)."""
    return runs.rollup("dimension").agg(mean_score().alias("score"), not_run().alias("not_run"))


def hours_since_last_run(history: DataFrame, as_of: str, column: str = "run_ts") -> DataFrame:
    now = F.lit(as_of).cast(history.schema[column].dataType)
    return history.agg(F.max(column).alias("last")).select(
        F.round(F.timestamp_diff("MINUTE", F.col("last"), now) / F.lit(60.0), 4).alias("hours_since_last_run"))


# --- issues --------------------------------------------------------------------------------------------------------

# Catalogue of known issues (id, table, columns, dimension, severity, rule, threshold).
ISSUES = (
    ("DQ-001", "dim_customer", "email", "Completeness", "HIGH", "email NOT NULL", 0.99),
    ("DQ-002", "dim_customer", "customer_id,is_current", "Uniqueness", "CRITICAL", "one current row per id", 1.0),
    ("DQ-003", "dim_customer", "email", "Validity", "HIGH", "email format", 0.99),
    ("DQ-004", "dim_customer", "customer_segment", "Validity", "MEDIUM", "segment in approved list", 1.0),
    ("DQ-005", "dim_product", "list_price", "Validity", "HIGH", "list_price > 0", 1.0),
    ("DQ-006", "dim_product", "cost_price,list_price", "Accuracy", "MEDIUM", "cost_price < list_price", 0.99),
    ("DQ-007", "fact_sales", "customer_key", "Consistency", "CRITICAL", "customer_key exists", 1.0),
    ("DQ-008", "fact_sales", "quantity", "Validity", "HIGH", "quantity >= 1", 0.999),
)
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")


def _issue(field: int) -> Column:
    return F.create_map(*[F.lit(v) for i in ISSUES for v in (i[0], i[field])])[F.col("issue_id")]


def issue_catalogue(results: DataFrame) -> DataFrame:
    """Known issues over all their checks: how many there are and fail, the largest volume and share any of them found.

    An issue passes when all its checks do.
    """
    missed = F.count_if(F.col("status") != "PASS")
    found = results.where(F.col("issue_id").isNotNull()).groupBy("issue_id").agg(
        F.count(F.lit(1)).alias("checks"), missed.alias("failed_checks"), F.max("unexpected_count").alias("volume"),
        F.max("unexpected_pct").alias("volume_pct"), F.when(missed > 0, "FAIL").otherwise("PASS").alias("status"))
    return found.select(
        "issue_id", _issue(1).alias("table_name"), _issue(2).alias("columns"), _issue(3).alias("dimension"),
        _issue(4).alias("severity"), _issue(5).alias("rule"), _issue(6).alias("threshold"), "checks", "failed_checks",
        "volume", "volume_pct", "status")


def open_issues(results: DataFrame) -> DataFrame:
    """issue_id, severity, resolved_date: issues with a failed check are open."""
    return (results.where((F.col("status") == "FAIL") & F.col("issue_id").isNotNull())
            .select("issue_id").distinct()
            .select("issue_id", _issue(4).alias("severity"), F.lit(None).cast("date").alias("resolved_date")))


# --- life of an issue ----------------------------------------------------------------------------------------------

def issue_runs(runs: DataFrame, at: str = "run_timestamp") -> DataFrame:
    """(issue_id, run_at, failing) from the run history: an issue fails in a run if one of its checks does. Checks that were
    not run say nothing."""
    return (runs.where("status <> 'NOT_RUN'").select(F.explode("issue_ids").alias("issue_id"), F.col(at).alias("run_at"),
                                                    (F.col("status") != "PASS").alias("failing"))
            .groupBy("issue_id", "run_at").agg(F.bool_or("failing").alias("failing")))


def lifecycle(states: DataFrame) -> DataFrame:
    """One row per episode of an issue, from (issue_id, run_at, failing), one row per run.

    An episode opens with the first failing run after a passing one (or ever) and is resolved by the next passing run;
    ``last_clean_at`` is the run before it, so the defect came in between. Issues that never failed have no episode. The
    windows hold one row per run of an issue.
    """
    in_time = Window.partitionBy("issue_id").orderBy("run_at")
    opening = F.col("failing") & ~F.coalesce(F.lag("failing").over(in_time), F.lit(False))
    marked = states.select("issue_id", "run_at", "failing", opening.alias("opening"), F.lag("run_at").over(in_time).alias("before"))
    numbered = marked.withColumn("episode", F.sum(F.col("opening").cast("int")).over(
        in_time.rowsBetween(Window.unboundedPreceding, 0)))
    return (numbered.where("episode > 0").groupBy("issue_id", "episode").agg(
        F.max(F.when(F.col("opening"), F.col("before"))).alias("last_clean_at"),
        F.min(F.when(F.col("failing"), F.col("run_at"))).alias("opened_at"),
        F.min(F.when(~F.col("failing"), F.col("run_at"))).alias("resolved_at"),
        F.count_if("failing").alias("failing_runs")))


def issues_from_history(episodes: DataFrame) -> DataFrame:
    """issue_id, severity, status, episodes, opened_at, resolved_date of every known issue, as its last episode left it.

    status is OPEN, REOPENED (open, and resolved before), RESOLVED or NEVER_SEEN.
    """
    last = episodes.groupBy("issue_id").agg(
        F.count(F.lit(1)).alias("episodes"), F.max_by("opened_at", "episode").alias("opened_at"),
        F.max_by(F.struct("resolved_at"), "episode")["resolved_at"].alias("resolved_at"))
    known = episodes.sparkSession.createDataFrame([(i[0],) for i in ISSUES], "issue_id string")
    status = (F.when(F.col("episodes").isNull(), "NEVER_SEEN").when(F.col("resolved_at").isNotNull(), "RESOLVED")
              .when(F.col("episodes") > 1, "REOPENED").otherwise("OPEN"))
    return known.join(last, "issue_id", "left").select(
        "issue_id", _issue(4).alias("severity"), status.alias("status"), F.coalesce("episodes", F.lit(0)).alias("episodes"),
        "opened_at", F.to_date("resolved_at").alias("resolved_date"))


def response_from_history(episodes: DataFrame, severity: Column | None = None) -> DataFrame:
    """The mean hours to detect (at most: from the last clean run to the one that failed) and to resolve, reopened episodes
    and open critical issues, from episodes."""
    hours = lambda a, b: F.timestamp_diff("SECOND", F.col(a), F.col(b)) / F.lit(3600.0)
    grave = F.coalesce((_issue(4) if severity is None else severity) == "CRITICAL", F.lit(False))
    return episodes.agg(
        F.count(F.lit(1)).alias("incidents"), P.rounded(F.avg(hours("last_clean_at", "opened_at")), 4).alias("mttd_hours"),
        P.rounded(F.avg(hours("opened_at", "resolved_at")), 4).alias("mttr_hours"),
        F.count_if(F.col("episode") > 1).alias("reopened"),
        F.count_if(grave & F.col("resolved_at").isNull()).alias("open_critical"))


def severity_rank(severity: str = "severity") -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col(severity))


def active_issues(issues: DataFrame) -> DataFrame:
    """Open issues per severity, gravest first, with their sorted ids."""
    return (issues.where(F.col("resolved_date").isNull()).groupBy("severity")
            .agg(F.count(F.lit(1)).alias("issue_count"), F.array_sort(F.collect_list("issue_id")).alias("issue_ids"))
            .orderBy(severity_rank()))


def failures_by_severity(results: DataFrame) -> DataFrame:
    """Failed checks per severity: that of their issue, else their own, else UNCLASSIFIED. No failed check is left out."""
    severity = F.coalesce(_issue(4), F.upper("severity"), F.lit("UNCLASSIFIED"))
    return (results.where(F.col("status") != "PASS").groupBy(severity.alias("severity"))
            .agg(F.count(F.lit(1)).alias("failed_checks"), F.countDistinct("issue_id").alias("issues")))


# --- summaries -----------------------------------------------------------------------------------------------------

def summary(results: DataFrame) -> DataFrame:
    """total, passed, failed, pass_rate per table and for all tables (TOTAL)."""
    passed = F.count_if(F.col("status") == "PASS")
    total = F.count(F.lit(1))
    return results.rollup("table_name").agg(
        total.alias("total"), passed.alias("passed"), (total - passed).alias("failed"),
        P.percent(passed, total, 1).alias("pass_rate")).select(
        F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"), "total", "passed", "failed", "pass_rate",
        F.when(F.col("failed") == 0, "PASS").otherwise("FAIL").alias("status"))


# Target score per dimension.
TARGETS = {"Completeness": 1.0, "Accuracy": 0.995, "Consistency": 1.0, "Uniqueness": 1.0, "Validity": 0.995,
           "Timeliness": 0.995}


def against_target(runs: DataFrame) -> DataFrame:
    """Score, target, gap and status per dimension; one without any check that was run has no score."""
    target = F.create_map(*[F.lit(v) for item in TARGETS.items() for v in item])[F.col("dimension")]
    return (runs.groupBy("dimension").agg(mean_score().alias("score"))
            .select("dimension", "score", target.alias("target"), P.rounded(F.col("score") - target, 8).alias("gap"),
                    F.when(F.col("score").isNull(), "NOT_RUN").when(F.col("score") >= target, "ON_TARGET")
                    .otherwise("BELOW_TARGET").alias("status")))


# --- KPI formulas --------------------------------------------------------------------------------------------------

def completeness(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Filled required values over all required values, from one scan."""
    required = list(required)
    filled = reduce(Column.__add__, [F.count(c) for c in required])
    whole = F.count(F.lit(1)) * len(required)
    return df.agg(filled.alias("filled"), whole.alias("expected")).withColumn(
        "score", share(F.col("filled"), F.col("expected")).cast("double"))


def passing(df: DataFrame, broken: Iterable[Column]) -> DataFrame:
    """Rows that break none of the predicates over all rows; an unknown predicate does not count against a row."""
    any_broken = reduce(Column.__or__, [F.coalesce(b, F.lit(False)) for b in broken])
    return df.agg(F.count_if(~any_broken).alias("passing"), F.count(F.lit(1)).alias("rows")).withColumn(
        "score", share(F.col("passing"), F.col("rows")).cast("double"))


def accuracy(sales: DataFrame) -> DataFrame:
    return passing(sales, [P.revenue_gap() > F.lit(P.CENT), P.profit_gap() > F.lit(P.CENT)])


def consistency(tables: Mapping[str, DataFrame], keys=RELATIONSHIPS) -> DataFrame:
    flagged, flags = K.with_orphan_flags(tables["fact_sales"], list(keys), tables)
    return passing(flagged, flags.values())


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.count(key).alias("distinct_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).withColumn(
        "score", share(F.col("distinct_keys"), F.col("rows")).cast("double"))


def validity(df: DataFrame, checks: Iterable[Check], as_of=None) -> DataFrame:
    """Rows that pass ALL format, range and list checks."""
    chosen = [c for c in checks if is_row_local(c) and c.kind != "not_null" and c.dimension == "Validity"]
    return passing(df, [violation(c, df, as_of) for c in chosen])


def load_punctuality(log: DataFrame, first: str, last: str,
                     schedule: dict[str, tuple[str, int]] = anomaly.SCHEDULE) -> DataFrame:
    """On-time loads over the loads expected between two days, and the breach rate, per table of the schedule.

    A load that did not happen is a breach; a table without a load in the period has 0 %, one with nothing due NULL.
    """
    due = anomaly.expected_loads(log, first, last, schedule)
    start = F.col("due_date").cast("timestamp_ntz")
    on_time = F.coalesce(F.timestamp_diff("SECOND", start, F.col("load_timestamp")) < F.col("deadline_hour") * 3600,
                         F.lit(False))
    judged = due.groupBy("table_name").agg(F.count(F.lit(1)).alias("expected"), F.count("load_timestamp").alias("loads"),
                                           F.count_if(on_time).alias("on_time"))
    tables = log.sparkSession.createDataFrame([(t,) for t in schedule], "table_name string")
    counted = tables.join(judged, "table_name", "left").na.fill(0, ["expected", "loads", "on_time"])
    return counted.select("*", P.percent(F.col("on_time"), F.col("expected")).alias("timeliness_pct"),
                          P.percent(F.col("expected") - F.col("on_time"), F.col("expected")).alias("breach_pct"))


def response_times(incidents: DataFrame) -> DataFrame:
    """Mean hours to detect and to resolve, and the number of open critical incidents."""
    hours = lambda a, b: F.timestamp_diff("SECOND", F.col(a), F.col(b)) / F.lit(3600.0)
    return incidents.agg(
        F.count(F.lit(1)).alias("incidents"),
        P.rounded(F.avg(hours("injected_at", "alerted_at")), 4).alias("mttd_hours"),
        P.rounded(F.avg(hours("alerted_at", "resolved_at")), 4).alias("mttr_hours"),
        F.count_if((F.col("severity") == "CRITICAL") & F.col("resolved_at").isNull()).alias("open_critical"))


def latest_integrity(history: DataFrame) -> DataFrame:
    """The newest snapshot of the integrity history."""
    newest = history.agg(F.max("check_timestamp").alias("t")).scalar()
    return history.where(F.col("check_timestamp") == newest).select(
        "check_name", "orphan_count", F.when(F.col("orphan_count") == 0, "PASS").otherwise("FAIL").alias("status"),
        "check_timestamp")
