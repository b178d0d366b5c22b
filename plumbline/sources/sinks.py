"""Append-only history tables on Parquet: validation runs, integrity history, quarantine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def moment(at: dt.datetime) -> Column:
    """A wall-clock time in the session's time zone, whatever the zone of the driver process."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp")


def write_run(results: DataFrame, path: str, run_id: str, run_ts: dt.datetime, load_date: dt.date) -> None:
    """Store the results of one run; storing the same run again replaces it.

    The run is its own partition, so a repeated write overwrites exactly the rows of that run.
    """
    (results.withColumn("run_ts", moment(run_ts))
     .withColumn("load_date", F.lit(load_date))
     .withColumn("run_id", F.lit(run_id))
     .coalesce(1)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("load_date", "run_id").parquet(path))


def append_by_date(df: DataFrame, path: str, date_column: str = "load_date") -> None:
    """Append to a table partitioned by day: readers of one day touch one folder."""
    df.write.mode("append").partitionBy(date_column).parquet(path)


def quarantine(rows: DataFrame, path: str, as_of: dt.datetime) -> None:
    """Keep rejected rows, whole, with the time they were set aside. Creates the table on first use."""
    rows.withColumn("quarantined_at", moment(as_of)).write.mode("append").parquet(path)


def empty_like(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """An empty quarantine table with the columns of ``df`` and the time stamp; written only if missing."""
    empty = spark.createDataFrame([], df.withColumn("quarantined_at", F.current_timestamp()).schema)
    empty.write.mode("ignore").parquet(path)
    return spark.read.schema(empty.schema).parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
