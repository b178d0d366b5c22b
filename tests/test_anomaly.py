"""Windows over days, freshness, trends, alerts."""

import datetime as dt

from plumbline.operators import alerts, anomaly, scores


def volumes(spark, counts, start="2024-01-01"):
    days = [(i, n) for i, n in enumerate(counts)]
    return (spark.createDataFrame(days, "i int, n int")
            .selectExpr(f"date_add(date '{start}', i) as load_date", "explode(sequence(1, n)) as row"))


def test_all_four_labels(spark):
    counts = [100, 210] + [100 + i % 5 for i in range(20)] + [20] + [100] * 8 + [400]
    flags = {r.load_date.day + 31 * (r.load_date.month - 1): r.anomaly_flag
             for r in anomaly.volume_flags(volumes(spark, counts)).collect()}
    assert flags[1] == "NORMAL"                    # no prior day: every comparison is unknown
    assert flags[2] == "HIGH_VOLUME"               # deviation of one day is unknown
    assert flags[23] == "SEVERE_DROP"
    assert flags[32] == "STATISTICAL_ANOMALY"
    assert set(flags.values()) == {"NORMAL", "HIGH_VOLUME", "SEVERE_DROP", "STATISTICAL_ANOMALY"}


def test_constant_volume_has_no_score(spark):
    rows = anomaly.volume_bands(volumes(spark, [50] * 10)).collect()
    assert all(r.z_score is None and r.volume_status == "NORMAL" and not r.alert for r in rows)


def test_frame_is_six_and_twenty_nine_rows(spark):
    rows = {r.load_date.day: r for r in anomaly.volume_bands(volumes(spark, [10, 20, 30, 40, 50, 60, 70, 80])).collect()}
    assert rows[8].rolling_7d_avg == 45.0  # days 2 to 7
    assert rows[1].rolling_7d_avg is None


def test_one_day_equals_the_full_series_within_the_look_back(spark):
    df = volumes(spark, [100 + (i * 7) % 13 for i in range(25)])
    today = anomaly.volume_flags(df, as_of="2024-01-25").collect()
    full = [r for r in anomaly.volume_flags(df).collect() if r.load_date == dt.date(2024, 1, 25)]
    assert today == full


def test_day_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "fact")
    volumes(spark, [5] * 40).write.partitionBy("load_date").parquet(path)
    flagged = anomaly.volume_flags(spark.read.parquet(path), as_of="2024-02-09")
    text = flagged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in text


def test_series_do_not_mix(spark):
    a, b = volumes(spark, [10] * 8).selectExpr("'a' as s", "*"), volumes(spark, [1000] * 8).selectExpr("'b' as s", "*")
    rows = anomaly.volume_bands(a.union(b), series=["s"]).collect()
    assert {r.s: r.rolling_7d_avg for r in rows if r.load_date.day == 8} == {"a": 10.0, "b": 1000.0}


def test_missing_load_is_a_breach(spark):
    log = spark.createDataFrame([("f", dt.datetime(2024, 1, 1, 5, 0), dt.date(2024, 1, 1))],
                                "table_name string, load_timestamp timestamp, load_date date")
    met = anomaly.freshness_sla(log, "f", "2024-01-01 07:00:00").first()
    assert (met.sla_status, met.hours_since_load) == ("SLA_MET", 2.0)
    none = anomaly.freshness_sla(log, "f", "2024-01-02 07:00:00").first()
    assert (none.sla_status, none.hours_since_load) == ("SLA_BREACH", None)
    age = anomaly.freshness_age(log, "2024-01-02 05:00:00", {"f": 24}).first()
    assert (age.age_hours, age.status) == (24.0, "FRESH")


def test_trend_rules(spark):
    scores = [1.0, 0.999, 0.998, 0.997, 0.96] + [0.99] * 7
    daily = spark.createDataFrame([(dt.date(2024, 1, i + 1), s) for i, s in enumerate(scores)],
                                  "load_date date, score double")
    rows = {r.load_date.day: r for r in anomaly.score_trends(daily).collect()}
    assert [d for d in sorted(rows) if rows[d].declining_3_days] == [4, 5]
    assert [d for d in sorted(rows) if rows[d].sudden_drop] == [5]
    assert [d for d in sorted(rows) if rows[d].below_target_7_days] == [11, 12]


METRICS = ("evaluated_at timestamp, overall_quality_score double, orphan_record_count int, data_age_hours int, "
           "daily_row_count int, rolling_7d_avg double, score_3day_trend double, scd2_duplicate_count int")


def test_alert_rules_and_cooldown(spark):
    at = dt.datetime(2024, 1, 1, 6, 30)
    metrics = spark.createDataFrame([(at, 0.9, 3, 30, 40, 100.0, -0.02, 0)], METRICS)
    fired = {r.alert_id: r.fired for r in alerts.evaluate(metrics).collect()}
    assert fired == {"ALT-001": True, "ALT-002": True, "ALT-003": True, "ALT-004": True, "ALT-005": True,
                     "ALT-006": False}
    log = spark.createDataFrame([("ALT-001", at - dt.timedelta(minutes=59)), ("ALT-002", at - dt.timedelta(minutes=1)),
                                 ("ALT-003", at - dt.timedelta(minutes=120)), ("ALT-005", at + dt.timedelta(minutes=5))],
                                "alert_id string, fired_at timestamp")
    fired = {r.alert_id: r.fired for r in alerts.evaluate(metrics, log=log).collect()}
    assert fired == {"ALT-001": False, "ALT-002": True, "ALT-003": True, "ALT-004": True, "ALT-005": True,
                     "ALT-006": False}


def test_cooldown_covers_alerts_of_the_same_run(spark):
    at = dt.datetime(2024, 1, 1, 6, 30)
    times = [at + dt.timedelta(minutes=m) for m in (0, 30, 59, 60, 90, 121)]
    metrics = spark.createDataFrame([(t, 0.9, 0, 0, 100, 100.0, 0.0, 0) for t in times], METRICS)

    def fired(log):
        rows = alerts.evaluate(metrics, log=log).where("alert_id = 'ALT-001'").collect()
        assert all(r.triggered and r.suppressed != r.fired for r in rows)
        return [int((r.evaluated_at - at).total_seconds() // 60) for r in sorted(rows) if r.fired]

    log = spark.createDataFrame([("ALT-001", at - dt.timedelta(minutes=20)), ("ALT-001", at - dt.timedelta(days=30))],
                                "alert_id string, fired_at timestamp")
    assert fired(None) == [0, 60, 121] and fired(log) == [59, 121] and fired(log.limit(0)) == [0, 60, 121]


LOG = "table_name string, load_timestamp timestamp_ntz, load_date date"


def _log(spark, *loads):
    parse = dt.datetime.fromisoformat
    return spark.createDataFrame([(t, parse(ts), parse(ts).date()) for t, ts in loads], LOG)


def test_never_loaded_stale_and_missing(spark):
    log = _log(spark, ("fact_sales", "2023-01-01 05:00:00"), ("dim_customer", "2024-01-10 05:30:00"),
               ("dim_product", "2024-01-10 06:30:00"), ("dim_store", "2024-01-08 04:00:00"), ("dim_customer", "2024-01-09 07:00:00"))
    rows = {r.table_name: (r.status, r.delay_minutes) for r in anomaly.timeliness(log, "2024-01-10 08:00:00").collect()}
    assert rows == {"fact_sales": ("MISSING", 120), "dim_customer": ("ON_TIME", -30), "dim_product": ("LATE", 30),
                    "dim_store": ("ON_TIME", -120), "dim_date": ("NEVER_LOADED", rows["dim_date"][1])}
    age = {r.table_name: r.status for r in anomaly.freshness_age(log, "2024-01-10 08:00:00").collect()}
    assert age == {"fact_sales": "STALE", "dim_customer": "FRESH", "dim_product": "FRESH", "dim_store": "FRESH",
                   "dim_date": "STALE"}


def test_expected_loads(spark):
    log = _log(spark, ("fact_sales", "2024-01-02 05:00:00"), ("fact_sales", "2024-01-05 07:00:00"),
               ("dim_store", "2024-01-08 05:00:00"))
    rows = {r.table_name: (r.expected, r.loads, r.on_time, r.timeliness_pct)
            for r in scores.load_punctuality(log, "2024-01-01", "2024-01-10").collect()}
    assert rows == {"fact_sales": (10, 2, 1, 10.0), "dim_customer": (10, 0, 0, 0.0), "dim_product": (10, 0, 0, 0.0),
                    "dim_store": (2, 1, 1, 50.0), "dim_date": (0, 0, 0, None)}


def test_unknown_metric_does_not_fire(spark):
    metrics = spark.createDataFrame([(dt.datetime(2024, 1, 1), None, None, None, None, None, None, None)], METRICS)
    assert not any(r.fired for r in alerts.evaluate(metrics).collect())


def test_a_table_outside_the_lists_has_a_row(spark):
    log = spark.sql("select 'new' as table_name, date '2024-01-02' as load_date, "
                    "timestamp_ntz '2024-01-02 03:00:00' as load_timestamp")
    age = {r.table_name: (r.age_hours, r.max_age_hours, r.status)
           for r in anomaly.freshness_age(log, "2024-01-02 05:00:00", {"f": 24}).collect()}
    assert age == {"f": (None, 24, "STALE"), "new": (2.0, None, "UNSCHEDULED")}
    late = {r.table_name: (r.due_date, r.delay_minutes, r.status)
            for r in anomaly.timeliness(log, "2024-01-02 05:00:00", {"f": ("daily", 6)}).collect()}
    assert late["f"][2] == "NEVER_LOADED" and late["new"] == (None, None, "UNSCHEDULED") and len(late) == 2
