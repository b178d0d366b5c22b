"""Monitoring inputs derived from the event stream: load log, daily load, incidents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.star import read

# Which feed of the event stream stands for the load of which table.
FEED = {"click": "fact_sales", "view": "dim_customer", "purchase": "dim_product", "signup": "dim_store",
        "error": "dim_date"}


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """table_name, load_timestamp, load_date: early loads on even days, late ones on odd days."""
    feed = F.create_map(*[F.lit(v) for item in FEED.items() for v in item])
    day = F.to_date("ts")
    return (read(spark, sf_dir, "events").groupBy(feed[F.col("event_type")].alias("table_name"), day.alias("load_date"))
            .agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
            .select("table_name", F.when(F.day("load_date") % 2 == 0, F.col("first")).otherwise(F.col("last"))
                    .alias("load_timestamp"), "load_date"))


def daily_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded rows with their load date, as three bad days leave them: loaded twice, partly, three times."""
    day = F.to_date("ts")
    on = lambda d: day == F.lit(d).cast("date")
    copies = (F.when(on("2024-01-02"), 2).when(on("2024-01-15") & (F.col("event_type") != "click"), 0)
              .when(on("2024-01-24"), 3).otherwise(1))
    return read(spark, sf_dir, "events").select(
        "event_id", "event_type", day.alias("load_date"),
        F.explode(F.array_repeat(F.lit(1), copies)).alias("copy")).drop("copy")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One incident per user and day with errors: first error, last error, last event of the day.

    An incident whose day ends with the error is still open.
    """
    error = F.col("event_type") == "error"
    per_day = (read(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day"))
               .agg(F.min(F.when(error, F.col("ts"))).alias("injected_at"),
                    F.max(F.when(error, F.col("ts"))).alias("alerted_at"),
                    F.max("ts").alias("last_at"), F.count_if(error).alias("errors")))
    return per_day.where("errors > 0").select(
        "injected_at", "alerted_at",
        F.when(F.col("last_at") > F.col("alerted_at"), F.col("last_at")).alias("resolved_at"),
        F.when(F.col("errors") > 1, "CRITICAL").otherwise("HIGH").alias("severity"))
