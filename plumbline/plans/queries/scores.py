"""K: scores, KPIs and alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import alerts, anomaly, scores
from plumbline.operators.defects import inject
from plumbline.operators.integrity import RELATIONSHIPS
from plumbline.functions import keys as K
from plumbline.functions.keys import ForeignKey
from plumbline.operators.validate import validate_all, validate_on_write
from plumbline.plans.contracts import TABLES
from plumbline.plans.queries import AS_OF
from plumbline.plans.suites import consolidated
from plumbline.session import durable
from plumbline.sources.events import FEED, incidents, load_log
from plumbline.sources.star import read, sales, star


def mirror(spark, sf_dir):
    return inject(star(spark, sf_dir), AS_OF)


def results(spark, sf_dir):
    return validate_all(mirror(spark, sf_dir), consolidated(), as_of=AS_OF)


def runs(spark, sf_dir):
    return scores.runs_of(results(spark, sf_dir), AS_OF)


def scores_on_write(spark, sf_dir):
    """Scores of a fact that is checked while it is written, before anything reads it back: key checks and foreign keys
    were not run."""
    loaded, found = validate_on_write(mirror(spark, sf_dir)["fact_sales"], consolidated()["fact_sales"], as_of=AS_OF)
    loaded.write.format("noop").mode("overwrite").save()
    return scores.overall(scores.runs_of(found(), AS_OF))


def issue_episodes(spark, sf_dir):
    """What each row check of the fact went through, load day by load day: a failing day opens an episode, the next clean
    one resolves it."""
    states = history(spark, sf_dir).select(F.col("metric_name").alias("issue_id"),
                                           F.col("load_date").cast("timestamp_ntz").alias("run_at"),
                                           (F.col("status") != "PASS").alias("failing"))
    hours = F.timestamp_diff("SECOND", F.col("opened_at"), F.col("resolved_at")) / F.lit(3600.0)
    return scores.lifecycle(states).groupBy("issue_id").agg(
        F.count(F.lit(1)).alias("episodes"), F.sum("failing_runs").alias("failing_runs"),
        F.to_date(F.min("opened_at")).alias("first_opened"), F.to_date(F.max("resolved_at")).alias("last_resolved"),
        F.count_if(F.col("resolved_at").isNull()).alias("open_now"), F.round(F.avg(hours), 4).alias("mttr_hours"))


def history(spark, sf_dir):
    return scores.daily_runs(sales(spark, sf_dir), consolidated()["fact_sales"])


def stamped_runs(spark, sf_dir):
    """The load log as run history: one run after each load."""
    return load_log(spark, sf_dir).withColumnRenamed("load_timestamp", "run_ts")


def alert_metrics(spark, sf_dir):
    """One metric row per load day: quality, volume and orphans of the fact from one scan of it."""
    fact, w = sales(spark, sf_dir), star(spark, sf_dir)
    customer = next(k for k in RELATIONSHIPS if k.table == "dim_customer")
    flagged, flags = K.with_orphan_flags(fact, [customer], w)
    runs = scores.daily_runs(flagged, consolidated()["fact_sales"], more={
        "daily_row_count": F.count(F.lit(1)), "orphan_record_count": F.count_if(flags[customer.flag])})
    daily = runs.groupBy("load_date").agg(
        scores.mean_score().alias("overall_quality_score"), F.max("daily_row_count").alias("daily_row_count"),
        F.max("orphan_record_count").alias("orphan_record_count"))
    frame = lambda *rows: anomaly.days_before("load_date", rows)
    return daily.withColumns({
        "rolling_7d_avg": F.avg("daily_row_count").over(frame(*anomaly.SHORT_FRAME)),
        "score_3day_trend": F.col("overall_quality_score") - F.max("overall_quality_score").over(frame(-3, -3)),
        "data_age_hours": F.coalesce(F.date_diff("load_date", F.max("load_date").over(frame(-1, -1))) * 24, F.lit(0)),
        "evaluated_at": F.col("load_date").cast("timestamp"), "scd2_duplicate_count": duplicates(spark, sf_dir)})


def alerts_by_day(spark, sf_dir):
    judged = alerts.evaluate(alert_metrics(spark, sf_dir))
    return judged.groupBy("alert_id", "severity").agg(F.count(F.lit(1)).alias("evaluations"),
                                                      F.count_if("triggered").alias("triggered"))


def load_metrics(spark, sf_dir):
    """One metric row per load of a table, measured on the events that stand for it, in one scan of them."""
    good = F.count_if(F.col("value") >= 1)
    feed = F.create_map(*[F.lit(v) for item in FEED.items() for v in item])[F.col("event_type")]
    events = read(spark, sf_dir, "events")
    users = ForeignKey("user_id", "dim_customer", "customer_key", source="events")
    flagged, flags = K.with_orphan_flags(events, [users], star(spark, sf_dir))
    by_user = flagged.groupBy(feed.alias("table_name"), F.to_date("ts").alias("load_date"), "user_id").agg(
        F.count(F.lit(1)).alias("n"), good.alias("good"), F.count_if(flags[users.flag]).alias("orphans"),
        F.min("ts").alias("first"), F.max("ts").alias("last"))
    loads = by_user.groupBy("table_name", "load_date").agg(
        F.sum("n").alias("daily_row_count"), scores.share(F.sum("good"), F.sum("n")).alias("overall_quality_score"),
        F.sum("orphans").alias("orphan_record_count"), F.count_if(F.col("n") > 1).alias("scd2_duplicate_count"),
        F.min("first").alias("first"), F.max("last").alias("last"))
    at = F.when(F.day("load_date") % 2 == 0, F.col("first")).otherwise(F.col("last")).cast("timestamp")
    frame = lambda *rows: anomaly.days_before("load_date", rows, ["table_name"])
    age = F.timestamp_diff("SECOND", F.max("evaluated_at").over(frame(-1, -1)), F.col("evaluated_at")) / F.lit(3600.0)
    return loads.withColumn("evaluated_at", at).withColumns({
        "data_age_hours": F.coalesce(age, F.lit(0.0)),
        "rolling_7d_avg": F.avg("daily_row_count").over(frame(*anomaly.SHORT_FRAME)),
        "score_3day_trend": F.col("overall_quality_score") - F.max("overall_quality_score").over(frame(-3, -3))})


def alerts_with_cooldown(spark, sf_dir):
    """All rules at every load, per table, against a log of earlier alerts: one of each rule and table an hour before
    every tenth day of the month."""
    metrics = durable(load_metrics(spark, sf_dir))
    sent = metrics.where("day(load_date) % 10 = 0").select(
        "table_name", F.explode(F.array(*[F.lit(r.alert_id) for r in alerts.RULES])).alias("alert_id"),
        (F.col("load_date").cast("timestamp") - F.expr("interval 1 hour")).alias("fired_at"))
    judged = alerts.evaluate(metrics, log=sent, series=["table_name"])
    return judged.groupBy("table_name", "alert_id", F.to_date("evaluated_at").alias("evaluated_on")).agg(
        F.count(F.lit(1)).alias("evaluations"), F.count_if("triggered").alias("triggered"),
        F.count_if("suppressed").alias("suppressed"), F.count_if("fired").alias("fired"))


def duplicates(spark, sf_dir):
    """Customer ids with more than one current row, as one value."""
    counts = mirror(spark, sf_dir)["dim_customer"].groupBy("customer_id").agg(F.count_if("is_current").alias("n"))
    return counts.agg(F.count_if(F.col("n") > 1).alias("n")).scalar()


def per_table(kpi):
    """A KPI of every table of the warehouse."""
    def query(spark, sf_dir):
        w = mirror(spark, sf_dir)
        return reduce(DataFrame.unionByName, [
            kpi(w[c.table], c).select(F.lit(c.table).alias("table_name"), "*") for c in TABLES])
    return query


QUERIES = {
    "K1_daily_scores": lambda spark, sf_dir: scores.daily_scores(history(spark, sf_dir)),
    "K1_daily_scores_mirror": lambda spark, sf_dir: scores.daily_scores(runs(spark, sf_dir)),
    "K2_table_scorecard": lambda spark, sf_dir: scores.table_scorecard(
        scores.daily_scores(runs(spark, sf_dir)), AS_OF),
    "K3_trend": lambda spark, sf_dir: scores.trend(
        scores.daily_scores(history(spark, sf_dir)), "2001-08-01"),
    "K4_active_issues": lambda spark, sf_dir: scores.active_issues(scores.open_issues(results(spark, sf_dir))),
    "K6_overall_score": lambda spark, sf_dir: scores.overall(runs(spark, sf_dir)),
    "K6_overall_score_on_write": scores_on_write,
    "K6_hours_since_last_run": lambda spark, sf_dir: scores.hours_since_last_run(
        stamped_runs(spark, sf_dir), "2024-02-01 00:00:00"),
    "K7_completeness": per_table(lambda df, c: scores.completeness(
        df, c.required_columns() + ["email"] * (c.table == "dim_customer"))),
    "K8_accuracy": lambda spark, sf_dir: scores.accuracy(mirror(spark, sf_dir)["fact_sales"]),
    "K9_consistency": lambda spark, sf_dir: scores.consistency(mirror(spark, sf_dir)),
    "K10_uniqueness": per_table(lambda df, c: scores.uniqueness(df, next(f.name for f in c.fields if f.primary))),
    "K11_validity": per_table(lambda df, c: scores.validity(df, consolidated()[c.table].checks, AS_OF)),
    "K12_timeliness": lambda spark, sf_dir: scores.load_punctuality(load_log(spark, sf_dir), "2024-01-01", "2024-02-15"),
    "K13_response_times": lambda spark, sf_dir: scores.response_times(incidents(spark, sf_dir)),
    "K13_issue_episodes": issue_episodes,
    "K14_summary": lambda spark, sf_dir: scores.summary(
        validate_all(star(spark, sf_dir), consolidated(), as_of=AS_OF)),
    "K15_against_target": lambda spark, sf_dir: scores.against_target(runs(spark, sf_dir)),
    "K16_issue_catalogue": lambda spark, sf_dir: scores.issue_catalogue(results(spark, sf_dir)),
    "K17_alerts": alerts_by_day,
    "K17_alert_cooldown": alerts_with_cooldown,
    "K18_failures_by_severity": lambda spark, sf_dir: scores.failures_by_severity(results(spark, sf_dir)),
}
