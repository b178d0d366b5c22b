"""Volume, revenue and freshness anomalies.

Rows are first reduced to one per day (and series); the windows then run over days, whose number does not grow with
the volume of data. With ``series`` the windows are partitioned, so many tables are watched in parallel.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from plumbline.functions import predicates as P

# Frames are counted in rows before the current one, as the monitored rules state them.
SHORT_FRAME = (-6, -1)
LONG_FRAME = (-29, -1)


def days_before(order: str, frame: tuple[int, int], series: Iterable[str] = ()) -> WindowSpec:
    window = Window.partitionBy(*series) if series else Window.partitionBy()
    return window.orderBy(order).rowsBetween(*frame)


def daily_volume(df: DataFrame, day: str = "load_date", series: Iterable[str] = ()) -> DataFrame:
    return df.groupBy(*series, day).agg(F.count(F.lit(1)).alias("row_count"))


def z_score(value: str, mean: str, deviation: str):
    return (F.col(value) - F.col(mean)) / F.nullif(F.col(deviation), F.lit(0.0))


def volume_bands(df: DataFrame, day: str = "load_date", series: Iterable[str] = ()) -> DataFrame:
    """Per day: 7-day average, ±50 % band, label, and a z-score against the 7-day average."""
    short, long = (days_before(day, f, series) for f in (SHORT_FRAME, LONG_FRAME))
    stats = daily_volume(df, day, series).withColumns({
        "rolling_7d_avg": F.avg("row_count").over(short),
        "rolling_30d_stddev": F.stddev_samp("row_count").over(long)})
    count, mean = F.col("row_count"), F.col("rolling_7d_avg")
    z = z_score("row_count", "rolling_7d_avg", "rolling_30d_stddev")
    status = (F.when(count < mean * 0.5, "LOW_VOLUME_ALERT").when(count > mean * 1.5, "HIGH_VOLUME_ALERT")
              .otherwise("NORMAL"))
    return stats.select(
        *series, day, "row_count", P.rounded(mean, 6).alias("rolling_7d_avg"),
        P.rounded(mean * 0.5, 0).alias("lower_bound_50pct"), P.rounded(mean * 1.5, 0).alias("upper_bound_50pct"),
        status.alias("volume_status"), P.rounded(z, 2).alias("z_score"),
        F.coalesce((count < mean * 0.5) | (F.abs(z) > 3), F.lit(False)).alias("alert"))


def volume_flags(df: DataFrame, day: str = "load_date", as_of=None, look_back: int = 31,
                 series: Iterable[str] = ()) -> DataFrame:
    """Per day: first rule that applies of severe drop, 3-sigma, high volume.

    With ``as_of`` only that day is judged, and only the look-back is read (the date filter reaches the scan).
    """
    if as_of is not None:
        df = df.where(F.col(day) >= F.date_sub(P.as_date(as_of), look_back))
    short, long = (days_before(day, f, series) for f in (SHORT_FRAME, LONG_FRAME))
    stats = daily_volume(df, day, series).withColumns({
        "avg_7": F.avg("row_count").over(short), "avg_30": F.avg("row_count").over(long),
        "std_30": F.stddev_samp("row_count").over(long)})
    if as_of is not None:
        stats = stats.where(F.col(day) == P.as_date(as_of))
    z = z_score("row_count", "avg_30", "std_30")
    flag = (F.when(F.col("row_count") < F.col("avg_7") * 0.5, "SEVERE_DROP")
            .when(F.abs(z) > 3, "STATISTICAL_ANOMALY")
            .when(F.col("row_count") > F.col("avg_7") * 1.5, "HIGH_VOLUME").otherwise("NORMAL"))
    return stats.select(
        *series, day, "row_count", P.rounded(F.col("avg_7"), 0).alias("rolling_7d_avg"),
        P.rounded(F.col("avg_30"), 0).alias("rolling_30d_avg"),
        P.rounded(F.col("avg_7") * 0.5, 0).alias("lower_bound_50pct"),
        P.rounded(z, 2).alias("z_score"), flag.alias("anomaly_flag"))


def daily_revenue(sales: DataFrame, day: str = "date_key", measure: str = "net_revenue") -> DataFrame:
    return sales.groupBy(day).agg(F.sum(measure).cast("double").alias("total_revenue"),
                                  F.count(F.lit(1)).alias("row_count"))


def revenue_flags(sales: DataFrame, day: str = "date_key", measure: str = "net_revenue",
                  last: int | None = 10, since=None) -> DataFrame:
    """Daily revenue against its 30-day average, 3-sigma rule; the last days only, if asked.

    ``since``, in the form of the day column, limits what is read (the filter reaches the scan); the first 30 days from
    there on have shorter averages.
    """
    if since is not None:
        sales = sales.where(F.col(day) >= F.lit(since))
    window = days_before(day, LONG_FRAME)
    stats = daily_revenue(sales, day, measure).withColumns({
        "avg_30": F.avg("total_revenue").over(window), "std_30": F.stddev_samp("total_revenue").over(window)})
    z = z_score("total_revenue", "avg_30", "std_30")
    flags = stats.select(
        day, "total_revenue", P.rounded(F.col("avg_30"), 2).alias("expected_avg"), P.rounded(z, 2).alias("z_score"),
        F.when(F.abs(z) > 3, "REVENUE_ANOMALY").otherwise("NORMAL").alias("anomaly_flag"))
    return flags.orderBy(F.desc(day)).limit(last) if last else flags


def revenue_spikes(sales: DataFrame, day: str = "date_key", measure: str = "net_revenue",
                   ratio: float = 3.0) -> DataFrame:
    """Days whose revenue exceeds ``ratio`` times the 30-day average."""
    stats = daily_revenue(sales, day, measure).withColumn(
        "baseline", F.avg("total_revenue").over(days_before(day, LONG_FRAME)))
    return stats.select(day, "total_revenue", P.rounded(F.col("baseline"), 2).alias("baseline"),
                        F.coalesce(F.col("total_revenue") > F.col("baseline") * ratio, F.lit(False)).alias("spike"))


def daily_limits(df: DataFrame, low: int = 50_000, high: int = 500_000, day: str = "load_date") -> DataFrame:
    count = F.col("row_count")
    return daily_volume(df, day).withColumn(
        "status", F.when(count < low, "BELOW_MINIMUM").when(count > high, "ABOVE_MAXIMUM").otherwise("IN_RANGE"))


# --- freshness -----------------------------------------------------------------------------------------------------

def _hours(later, earlier):
    return F.round(F.timestamp_diff("SECOND", earlier, later) / F.lit(3600.0), 4)


def freshness_sla(log: DataFrame, table: str, as_of: str, deadline_hour: int = 6) -> DataFrame:
    """Did today's load land before the deadline? Nothing loaded is a breach."""
    kind = log.schema["load_timestamp"].dataType
    now = F.lit(as_of).cast(kind)
    deadline = (F.to_date(now).cast(kind) + F.expr(f"interval {deadline_hour} hours"))
    return (log.where((F.col("table_name") == table) & (F.col("load_date") == F.to_date(now)))
            .agg(F.max("load_timestamp").alias("last"))
            .select(F.to_date(now).alias("check_date"), _hours(now, F.col("last")).alias("hours_since_load"),
                    F.when(F.col("last") < deadline, "SLA_MET").otherwise("SLA_BREACH").alias("sla_status")))


# Maximum age in hours per table.
MAX_AGE_HOURS = {"dim_customer": 24, "dim_product": 7 * 24, "dim_store": 30 * 24, "dim_date": 365 * 24,
                 "fact_sales": 24}


def freshness_age(log: DataFrame, as_of: str, max_age: dict[str, int] = MAX_AGE_HOURS) -> DataFrame:
    """Age of the newest load per table against its allowance; a table never loaded is stale, one
    without an allowance is UNSCHEDULED."""
    kind = log.schema["load_timestamp"].dataType
    now = F.lit(as_of).cast(kind)
    expected = log.sparkSession.createDataFrame(list(max_age.items()), "table_name string, max_age_hours bigint")
    age = _hours(now, F.col("last"))
    newest = log.groupBy("table_name").agg(F.max("load_timestamp").alias("last"))
    return (expected.join(newest, "table_name", "full")
            .select("table_name", age.alias("age_hours"), "max_age_hours",
                    F.when(F.col("max_age_hours").isNull(), "UNSCHEDULED").when(age <= F.col("max_age_hours"), "FRESH").otherwise("STALE").alias("status")))


# How often each table is due (daily, on Mondays, on the last day of the year) and until which hour.
SCHEDULE = {"fact_sales": ("daily", 6), "dim_customer": ("daily", 6), "dim_product": ("daily", 6),
            "dim_store": ("weekly", 6), "dim_date": ("annual", 6)}


def _schedule(spark, schedule: dict[str, tuple[str, int]]) -> DataFrame:
    return spark.createDataFrame([(t, every, hour) for t, (every, hour) in schedule.items()],
                                 "table_name string, every string, deadline_hour int")


def _due_on(day, every):
    """Whether a load is due on a day."""
    return (F.when(every == "weekly", F.weekday(day) == 0)
            .when(every == "annual", (F.month(day) == 12) & (F.day(day) == 31)).otherwise(True))


def expected_loads(log: DataFrame, first: str, last: str, schedule: dict[str, tuple[str, int]] = SCHEDULE) -> DataFrame:
    """(table_name, due_date, deadline_hour, load_timestamp): every load due between two days, and the first one of that
    day's loads, NULL if there was none."""
    spark = log.sparkSession
    days = _schedule(spark, schedule).select("*", F.explode(F.sequence(
        F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("due_date"))
    earliest = log.groupBy("table_name", F.col("load_date").alias("due_date")).agg(
        F.min("load_timestamp").alias("load_timestamp"))
    return (days.where(_due_on(F.col("due_date"), F.col("every")))
            .join(earliest, ["table_name", "due_date"], "left")
            .select("table_name", "due_date", "deadline_hour", "load_timestamp"))


def timeliness(log: DataFrame, as_of: str, schedule: dict[str, tuple[str, int]] = SCHEDULE) -> DataFrame:
    """Per table: its newest load up to ``as_of``, the last day a load was due by then, the delay against that
    day's deadline in minutes (negative: early), and ON_TIME, LATE, MISSING (due, not there yet) or NEVER_LOADED;
    UNSCHEDULED for a table that loads without being in the schedule.

    A load of the due day or later counts; the delay of a missing load runs until ``as_of``.
    """
    spark = log.sparkSession
    now = F.lit(as_of).cast(log.schema["load_timestamp"].dataType)
    day = F.to_date(now)
    passed = now >= _at_hour(day, F.col("deadline_hour"), now)
    today = F.when(passed, day).otherwise(F.date_sub(day, 1))  # the last day whose deadline is over
    due = (F.when(F.col("every") == "weekly", F.date_sub(today, F.weekday(today)))
           .when(F.col("every") == "annual", F.when((F.month(today) == 12) & (F.day(today) == 31), today)
                 .otherwise(F.date_sub(F.trunc(today, "year"), 1)))
           .otherwise(today))
    plan = _schedule(spark, schedule).withColumn("due_date", due)
    seen = log.where(F.col("load_timestamp") <= now).join(F.broadcast(plan), "table_name", "left").groupBy("table_name").agg(
        F.max("load_date").alias("last_load_date"),
        F.min(F.when(F.col("load_date") >= F.col("due_date"), F.col("load_timestamp"))).alias("landed"))
    deadline = _at_hour(F.col("due_date"), F.col("deadline_hour"), now)
    minutes = F.timestamp_diff("MINUTE", deadline, F.coalesce("landed", now))
    return plan.join(seen, "table_name", "full").select(
        "table_name", "due_date", "last_load_date", minutes.cast("bigint").alias("delay_minutes"),
        F.when(F.col("every").isNull(), "UNSCHEDULED").when(F.col("last_load_date").isNull(), "NEVER_LOADED")
        .when(F.col("landed").isNull(), "MISSING")
        .when(F.col("landed") < deadline, "ON_TIME").otherwise("LATE").alias("status"))


def _at_hour(day, hour, like):
    """That hour of a day, in the timestamp type of ``like``."""
    return day.cast("timestamp_ntz") + F.make_dt_interval(hours=hour)


# --- trends --------------------------------------------------------------------------------------------------------

def score_trends(daily: DataFrame, day: str = "load_date", score: str = "score", target: float = 0.995,
                 series: Iterable[str] = ()) -> DataFrame:
    """Per day: three declines in a row, seven days below target, a drop of more than two points in a day."""
    base = Window.partitionBy(*series) if series else Window.partitionBy()
    window = base.orderBy(day)
    flagged = daily.withColumn("change", F.col(score) - F.lag(score).over(window)).withColumns({
        "declines": F.sum(F.when(F.col("change") < 0, 1).otherwise(0)).over(window.rowsBetween(-2, 0)),
        "low_days": F.sum(F.when(F.col(score) < target, 1).otherwise(0)).over(window.rowsBetween(-6, 0))})
    return flagged.select(
        *series, day, score, P.rounded(F.col("change"), 6).alias("change"),
        (F.col("declines") == 3).alias("declining_3_days"), (F.col("low_days") == 7).alias("below_target_7_days"),
        F.coalesce(F.col("change") < -0.02, F.lit(False)).alias("sudden_drop"))
