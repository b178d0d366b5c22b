"""Cool-downs by successor pointers equal a sequential fold; the fact is read once for its metrics."""

import datetime as dt
import random

from pyspark.sql import functions as F

from plumbline.operators import alerts
from plumbline.operators.alerts import AlertRule

START = dt.datetime(2026, 1, 1)
RULES = [AlertRule("A", "a", "x > 0", "high", 60), AlertRule("B", "b", "y > 0", "high", 0),
         AlertRule("C", "c", "x > 0 and y > 0", "low", 1440)]
HIT = {"A": lambda x, y: x == 1, "B": lambda x, y: y == 1, "C": lambda x, y: x == 1 and y == 1}


def fold(metrics, log):
    """(series, alert, time) of what fires, one evaluation after another."""
    fired = set()
    for rule in RULES:
        cool = dt.timedelta(minutes=rule.cooldown_minutes)
        last = {}
        for s, at, x, y in sorted(metrics, key=lambda r: (r[1], str(r[0]))):
            if not HIT[rule.alert_id](x, y):
                continue
            sent = [t for k, a, t in log if k == s and a == rule.alert_id and t <= at]
            before = max([t for t in [last.get(s), *sent] if t is not None], default=None)
            if before is None or before == at == last.get(s) or at - before >= cool:
                fired.add((s, rule.alert_id, at))
                last[s] = at
    return fired


def test_same_as_a_sequential_fold(spark):
    for seed, spread in ((1, 60 * 24 * 4), (2, 400), (3, 60 * 24 * 40)):
        rng = random.Random(seed)
        moment = lambda: START + dt.timedelta(minutes=rng.randrange(spread), microseconds=rng.choice([0, 0, 1, 999_999]))
        times = {(rng.choice(["s", "t", None]), moment()) for _ in range(300)}
        times |= {("s", START + dt.timedelta(minutes=60 * i)) for i in range(30)}  # exactly one cool-down apart
        metrics = [(s, t, rng.choice([0, 1, 1, None]), rng.choice([0, 1])) for s, t in times]
        log = [(rng.choice(["s", "t", None]), rng.choice("ABC"), moment() - dt.timedelta(minutes=30)) for _ in range(12)]
        df = spark.createDataFrame(metrics, "s string, at timestamp_ntz, x int, y int")
        sent = spark.createDataFrame(log, "s string, alert_id string, fired_at timestamp_ntz")
        judged = alerts.evaluate(df, RULES, log=sent, at="at", series=["s"])
        rows = judged.collect()
        assert len(rows) == 3 * len(metrics)
        assert {(r.s, r.alert_id, r["at"]) for r in rows if r.fired} == fold(metrics, log)
        assert all(r.triggered == (r.fired or r.suppressed) and not (r.fired and r.suppressed) for r in rows)


def test_one_alert_with_very_many_evaluations(spark):
    """Every minute for 140 days: one alert an hour; no window or array holds the whole alert."""
    n = 200_000
    df = spark.range(n).select((F.lit("2026-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int")))
                               .alias("at"), F.lit(1).alias("x"), F.lit(0).alias("y"))
    hits = df.select(F.lit("A").alias("alert_id"), F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"),
                                                                      "at").alias("t"),
                     F.lit(3_600_000_000).cast("bigint").alias("cool"))
    fired = alerts.first_after_cooling(hits, ["alert_id"])
    assert fired.count() == -(-n // 60)
    plan = alerts.first_after_cooling(hits.where("t % 7 = 0"), ["alert_id"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_no_metrics(spark):
    df = spark.createDataFrame([], "at timestamp, x int, y int")
    assert alerts.evaluate(df, RULES, at="at").collect() == []
