"""Scores, sinks, snapshots, profile details and the stream hook."""

import datetime as dt

from pyspark.sql import functions as F

from plumbline.operators import defects, integrity, investigate, profile, scores
from plumbline.operators.validate import validate, validate_on_write
from plumbline.plans.suites import consolidated
from plumbline.sources import sinks
from plumbline.sources.registry import from_parquet
from plumbline.sources.schemas import columns, schema
from plumbline.streaming.micro_batch import validate_stream

AS_OF = dt.date(2026, 4, 29)


def test_summary_adds_up(mirror_results):
    rows = {r.table_name: r for r in scores.summary(mirror_results).collect()}
    assert (rows["TOTAL"].total, rows["TOTAL"].failed) == (125, 11)
    assert (rows["dim_customer"].failed, rows["dim_product"].failed, rows["fact_sales"].failed) == (5, 2, 4)
    assert rows["dim_store"].pass_rate == rows["dim_date"].pass_rate == 100.0


def test_scores_are_exact_and_rounded_half_up(spark):
    df = spark.createDataFrame([(1, 8), (0, 0), (2, 3)], "p int, n int")
    got = [float(r.s) for r in df.select(scores.share(F.col("p"), F.col("n")).alias("s")).collect()]
    assert got == [0.125, 1.0, 0.6667]


def test_checks_not_run_have_no_score(spark, small_star):
    fact = defects.inject(small_star, AS_OF)["fact_sales"]
    loaded, found = validate_on_write(fact, consolidated()["fact_sales"], as_of=AS_OF)
    loaded.write.format("noop").mode("overwrite").save()
    runs = scores.runs_of(found(), AS_OF)
    left_out = runs.where("status = 'NOT_RUN'").collect()
    assert left_out and all((r.metric_value, r.total_count, r.fail_count) == (None, None, None) for r in left_out)
    whole = next(r for r in scores.overall(runs).collect() if r.dimension is None)
    run = [float(r.metric_value) for r in runs.where("status <> 'NOT_RUN'").collect()]
    assert whole.not_run == len(left_out) and abs(whole.score - sum(run) / len(run)) < 1e-7
    daily = {r.dimension: r for r in scores.daily_scores(runs).collect()}
    assert sum(r.not_run for r in daily.values()) == len(left_out)
    only = runs.where("status = 'NOT_RUN'")
    assert {(r.overall_status, r.avg_score, r.total_fail) for r in scores.daily_scores(only).collect()} == {("NOT_RUN", None, 0)}
    assert {(r.score, r.status) for r in scores.against_target(only).collect()} == {(None, "NOT_RUN")}
    assert scores.table_scorecard(scores.daily_scores(runs), str(AS_OF)).first().not_run == len(left_out)


def test_issue_life_cycle_from_run_history(spark):
    """Open, reopened, resolved and never seen issues; runs that say nothing about an issue are passed over."""
    story = {"DQ-001": "PFFPPFP", "DQ-002": "FFFFFFF", "DQ-003": "PPPPPPP", "DQ-004": "FPNNFFN", "DQ-005": "NNNNNNN",
             "DQ-007": "PPPFNPP"}
    word = {"P": "PASS", "F": "FAIL", "N": "NOT_RUN"}
    rows = [(f"2026-01-{day + 1:02d} 06:00:00", word[mark], [issue]) for issue, marks in story.items()
            for day, mark in enumerate(marks)]
    rows += [("2026-01-01 06:00:00", "PASS", ["DQ-002"]), ("2026-01-03 06:00:00", "PASS", [])]  # another check of the issue
    runs = spark.createDataFrame(rows, "run_timestamp string, status string, issue_ids array<string>").withColumn(
        "run_timestamp", F.col("run_timestamp").cast("timestamp"))
    episodes = scores.lifecycle(scores.issue_runs(runs))
    day = lambda t: None if t is None else t.day
    got = {(r.issue_id, r.episode): (day(r.last_clean_at), day(r.opened_at), day(r.resolved_at), r.failing_runs)
           for r in episodes.collect()}
    assert got == {("DQ-001", 1): (1, 2, 4, 2), ("DQ-001", 2): (5, 6, 7, 1), ("DQ-002", 1): (None, 1, None, 7),
                   ("DQ-004", 1): (None, 1, 2, 1), ("DQ-004", 2): (2, 5, None, 2), ("DQ-007", 1): (3, 4, 6, 1)}
    known = {r.issue_id: (r.status, r.episodes, day(r.resolved_date)) for r in scores.issues_from_history(episodes).collect()}
    assert known == {"DQ-001": ("RESOLVED", 2, 7), "DQ-002": ("OPEN", 1, None), "DQ-003": ("NEVER_SEEN", 0, None),
                     "DQ-004": ("REOPENED", 2, None), "DQ-005": ("NEVER_SEEN", 0, None), "DQ-006": ("NEVER_SEEN", 0, None),
                     "DQ-007": ("RESOLVED", 1, 6), "DQ-008": ("NEVER_SEEN", 0, None)}
    row = scores.response_from_history(episodes).first()
    assert (row.incidents, row.reopened, row.open_critical) == (6, 2, 1)
    assert (row.mttd_hours, row.mttr_hours) == ((1 + 1 + 3 + 1) * 24 / 4, (2 + 1 + 1 + 2) * 24 / 4)
    assert scores.lifecycle(scores.issue_runs(runs.limit(0))).collect() == []


def test_issue_list_is_ordered_by_gravity(mirror_results):
    rows = scores.active_issues(scores.open_issues(mirror_results)).collect()
    assert [(r.severity, r.issue_ids) for r in rows] == [
        ("CRITICAL", ["DQ-002", "DQ-007"]), ("HIGH", ["DQ-001", "DQ-003", "DQ-005", "DQ-008"]),
        ("MEDIUM", ["DQ-004", "DQ-006"])]


def test_daily_runs_add_up_to_the_whole(star):
    dated = defects.inject(star, AS_OF)["fact_sales"].withColumn(
        "load_date", F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"))
    suite = consolidated()["fact_sales"]
    daily = {r.metric_name: r.n for r in scores.daily_runs(dated, suite).groupBy("metric_name").agg(
        F.sum("fail_count").alias("n")).collect()}
    assert daily["between:quantity"] == daily["revenue_identity:net_revenue"] == 100


def test_repeated_run_replaces_itself(spark, star, tmp_path):
    results = validate(star["dim_store"], consolidated()["dim_store"], as_of=AS_OF)
    path = str(tmp_path / "runs")
    for run in ("a", "a", "b"):
        sinks.write_run(results, path, run, dt.datetime(2026, 4, 29), AS_OF)
    assert {r.run_id: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()} == {
        "a": 23, "b": 23}


def test_history_rows_have_the_declared_columns(mirror_results):
    rows = scores.runs_of(mirror_results, AS_OF, 7, "2026-04-29 06:30:00")
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in schema("validation_runs")]
    row = rows.where("metric_name = 'not_null:email'").first()
    assert (row.run_id, row.pass_count, row.fail_count, row.total_count, row.issue_ids) == (
        7, 9_710, 300, 10_010, ["DQ-001"])
    assert float(row.metric_value) == 0.97


def test_snapshot_is_independent(spark, small_star, tmp_path):
    copy = small_star.snapshot(spark, str(tmp_path / "mirror"))
    assert copy["fact_sales"].count() == 5_000
    again = from_parquet(spark, str(tmp_path / "mirror"))
    assert again["dim_product"].columns == columns("dim_product")
    assert again["dim_customer"].exceptAll(small_star["dim_customer"]).count() == 0


def test_quarantine_table_is_created_once(spark, small_star, tmp_path):
    path = str(tmp_path / "q")
    assert sinks.empty_like(spark, small_star["fact_sales"], path).count() == 0
    sinks.quarantine(small_star["fact_sales"].limit(7), path, dt.datetime(2026, 4, 29))
    assert sinks.empty_like(spark, small_star["fact_sales"], path).count() == 7


def test_scorecard_counts_rows_once_and_violations_twice(star):
    mirror = defects.inject(star, AS_OF)
    both = mirror["fact_sales"].withColumn(
        "net_revenue", F.when(F.col("customer_key") == 999999, F.lit(0)).otherwise(F.col("net_revenue")))
    row = integrity.scorecard(mirror.replaced(fact_sales=both)).first()
    assert (row.fact_rows, row.orphan_customer, row.revenue_broken) == (500_050, 50, 150)
    assert (row.clean_pct, row.distinct_clean_pct) == (99.96, 99.97)


def test_missing_days(star):
    gap = star["dim_date"].where("full_date != date '2024-03-05'")
    assert [r.missing_date for r in profile.missing_days(gap).collect()] == [dt.date(2024, 3, 5)]


def test_root_causes(star):
    rows = {(r.rule, r.cause): r.rows for r in investigate.root_cause(defects.inject(star, AS_OF)["fact_sales"]).collect()}
    assert rows == {("quantity", "injected"): 100, ("net_revenue identity", "cascade"): 100,
                    ("gross_profit identity", "cascade"): 100}


def test_share_of_a_distribution_needs_no_window(star):
    shares = profile.distribution(star["dim_customer"], "customer_segment", pct=True)
    assert abs(sum(r.pct for r in shares.collect()) - 100) < 0.02
    assert "Window" not in shares._jdf.queryExecution().executedPlan().toString()


def test_stream_of_files(spark, small_star, tmp_path):
    source, runs = str(tmp_path / "in"), str(tmp_path / "runs")
    small_star["dim_store"].write.parquet(source)
    stream = spark.readStream.schema(small_star["dim_store"].schema).parquet(source)
    query = validate_stream(stream, consolidated()["dim_store"], runs, str(tmp_path / "cp"), AS_OF, as_of=AS_OF)
    query.awaitTermination(120)
    assert query.exception() is None
    stored = spark.read.parquet(runs)
    assert stored.count() == 23 and stored.where("status = 'FAIL'").count() == 0
