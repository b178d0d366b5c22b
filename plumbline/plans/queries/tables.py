"""A: sources, registry, snapshot and the history sinks."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.contracts import compile_suite, from_yaml, to_yaml
from plumbline.operators.defects import orphan_rows
from plumbline.operators.integrity import orphan_report
from plumbline.operators.repair import split_orphans
from plumbline.operators.integrity import RELATIONSHIPS
from plumbline.operators.scores import latest_integrity, runs_of
from plumbline.operators.validate import validate
from plumbline.plans.contracts import ALL
from plumbline.plans.queries import AS_OF
from plumbline.plans.suites import consolidated
from plumbline.session import new_table_path
from plumbline.sources import sinks
from plumbline.sources.registry import Warehouse, from_parquet
from plumbline.sources.schemas import WAREHOUSE
from plumbline.sources.snapshots import Snapshots, portable_hash
from plumbline.sources.star import star, stored_sales


def _sizes(w: Warehouse) -> DataFrame:
    return reduce(DataFrame.unionAll, [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"))
        for name, df in w.items()])


def scan(spark, sf_dir):
    return _sizes(star(spark, sf_dir))


def views(spark, sf_dir):
    star(spark, sf_dir).register_views()
    return spark.sql("SELECT region, store_type, count(*) AS stores FROM dim_store GROUP BY region, store_type")


def snapshot(spark, sf_dir):
    """Copy the warehouse, then read the copy with the declared schemas."""
    path = new_table_path(spark, "snapshot")
    star(spark, sf_dir).snapshot(spark, path)
    return _sizes(from_parquet(spark, path, WAREHOUSE))


def year() -> Column:
    return F.year("load_date")


def two_states(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The fact before and after a load: a year appended, one removed, and one whose first lines lost their quantity."""
    fact = stored_sales(spark, sf_dir)
    lost = (year() == 1997) & (F.col("order_line_num") == 1)
    after = fact.where(year() != 1996).withColumn("quantity", F.when(lost, F.lit(None)).otherwise(F.col("quantity")))
    return fact.where(year() < 2001), after


def snapshot_by_content(spark, sf_dir):
    """What the second of two snapshots copied, kept and removed, with the content of each year."""
    copies = Snapshots(spark, new_table_path(spark, "snapshots"), portable_hash)
    for state in two_states(spark, sf_dir):
        copies.take(state, year())
    return copies.report().withColumn("hash_sum", F.col("hash_sum").cast("string")).drop("stored_in")


def run_history(spark, sf_dir):
    """Two days of results appended; reading one day prunes to its partition."""
    results = validate(star(spark, sf_dir)["dim_product"], consolidated()["dim_product"], as_of=AS_OF)
    path = new_table_path(spark, "validation_runs")
    for run, day in enumerate(("2026-04-28", "2026-04-29"), 1):
        sinks.append_by_date(runs_of(results, day, run, f"{day} 06:30:00"), path)
    return (sinks.read_history(spark, path).where(F.col("load_date") == F.lit(AS_OF).cast("date"))
            .groupBy("run_id", "load_date", F.date_format("run_timestamp", "HH:mm").alias("run_time"), "table_name",
                     "dimension")
            .agg(F.count(F.lit(1)).alias("metrics"), F.sum("fail_count").alias("fail_count")))


def quarantine_table(spark, sf_dir):
    """An empty quarantine table like the fact, then orphans inserted with the time."""
    w = star(spark, sf_dir)
    path = new_table_path(spark, "fact_sales_orphan_quarantine")
    sinks.empty_like(spark, w["fact_sales"], path)
    customer = next(k for k in RELATIONSHIPS if k.table == "dim_customer")
    _, orphans = split_orphans(w["fact_sales"], customer, w)
    sinks.quarantine(orphans, path, dt.datetime(2026, 4, 29, 6, 30))
    return sinks.read_history(spark, path).groupBy("customer_key", F.to_date("quarantined_at").alias("quarantined_on")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("net_revenue").alias("net_revenue"))


def generated(spark, sf_dir):
    """Generated rows inside the whole fact."""
    return (orphan_rows(star(spark, sf_dir)["fact_sales"])
            .groupBy(F.col("order_id").startswith("ORD-ORPHAN-").alias("generated"))
            .agg(F.count(F.lit(1)).alias("rows"), F.max("sales_key").alias("max_sales_key"),
                 F.max("order_id").alias("max_order_id"), F.sum("net_revenue").alias("net_revenue")))


def contract_source(spark, sf_dir):
    """Contracts read from their multi-document text, next to the size of the table each one governs."""
    loaded = [c for c in from_yaml(to_yaml(ALL)) if c.table]
    w = star(spark, sf_dir)
    return reduce(DataFrame.unionAll, [
        w[c.table].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(c.table).alias("table_name"), F.lit(len(c.fields)).alias("fields"),
            F.lit(len(compile_suite(c).checks)).alias("checks"), "row_count") for c in loaded])


def _integrity_history(spark, sf_dir):
    report = orphan_report(star(spark, sf_dir)).select("check_name", "orphan_count")
    path = new_table_path(spark, "referential_integrity_checks")
    for day in ("2026-04-28", "2026-04-29"):
        stamped = report.withColumns({"check_timestamp": F.lit(f"{day} 06:30:00").cast("timestamp"),
                                      "check_date": F.lit(day).cast("date")})
        sinks.append_by_date(stamped, path, "check_date")
    return sinks.read_history(spark, path)


def integrity_history(spark, sf_dir):
    return _integrity_history(spark, sf_dir).groupBy("check_date").agg(
        F.count(F.lit(1)).alias("checks"), F.sum("orphan_count").alias("orphans"))


def newest_integrity(spark, sf_dir):
    return latest_integrity(_integrity_history(spark, sf_dir)).withColumn(
        "check_timestamp", F.to_date("check_timestamp"))


QUERIES = {
    "A1_table_scan": scan,
    "A2_registry_views": views,
    "A3_head": lambda spark, sf_dir: star(spark, sf_dir).head("dim_customer", 5, "customer_key"),
    "A4_snapshot": snapshot,
    "A4_snapshot_by_content": snapshot_by_content,
    "A6_validation_runs_sink": run_history,
    "A7_quarantine_table": quarantine_table,
    "A8_row_generator": generated,
    "A9_contract_source": contract_source,
    "A10_integrity_history": integrity_history,
    "K5_latest_integrity": newest_integrity,
}
