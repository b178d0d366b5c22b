"""Profiles from states are those of the whole table, whatever was appended, replaced or removed."""

import pytest
from pyspark.sql import functions as F

from plumbline.operators import profile
from plumbline.operators.profile_states import ProfileStore, file_versions, snapshot_versions, table_profile
from plumbline.sources.snapshots import Snapshots, period_text

AS_OF = "2026-04-29"


def equal(found, wanted):
    a, b = found.first().asDict(), wanted.first().asDict()
    assert a == b


@pytest.mark.parametrize("table", ["dim_customer", "dim_product", "dim_store", "fact_sales"])
def test_merged_is_the_whole_profile(small_star, table, spark):
    df = small_star[table]
    parts = table_profile(df, table, AS_OF)
    states = parts.states(df, F.pmod(F.xxhash64(df.columns[0]), F.lit(5)))
    equal(parts.merged(states), profile.whole_profile(df, table, AS_OF))
    equal(parts.merged(states.limit(0)), profile.whole_profile(df.limit(0), table, AS_OF))


def test_append_replace_and_remove_by_snapshot(spark, small_star, tmp_path):
    month = F.substring(F.col("date_key").cast("string"), 1, 6)
    source = small_star["fact_sales"].where("date_key < 20240501")
    copies = Snapshots(spark, str(tmp_path / "copy"))
    store = ProfileStore(spark, str(tmp_path / "states"), table_profile(
        source, "fact_sales", cells={"quantity": F.col("quantity"), "order_length": F.length("order_id")}))
    read = []

    def refresh(df):
        copies.take(df, month)
        read.clear()
        store.refresh(snapshot_versions(copies), lambda p: read.extend(p) or copies.read(periods=p), period_text(month))
        equal(store.whole(), profile.whole_profile(df, "fact_sales"))
        for name, column in (("quantity", F.col("quantity")), ("order_length", F.length("order_id"))):
            wanted = profile.distribution(df, column.cast("string"), "value")
            assert sorted(map(tuple, store.histogram(name).collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)
        return sorted(read)

    one = source.where("date_key < 20240401")
    assert refresh(one) == ["p202401", "p202402", "p202403"]
    assert refresh(one) == []
    changed = source.withColumn("quantity", F.when(F.col("date_key") == 20240215, None).otherwise(F.col("quantity")))
    assert refresh(changed) == ["p202402", "p202404"]
    assert refresh(changed.where("date_key NOT BETWEEN 20240101 AND 20240131")) == []
    actions = {r.period: r.action for r in store.index().collect()}
    assert actions == {"p202401": "REMOVED", "p202402": "KEPT", "p202403": "KEPT", "p202404": "KEPT"}
    assert refresh(source) == ["p202401", "p202402"]
    equal(store.whole(["p202403"]), profile.whole_profile(source.where("date_key BETWEEN 20240301 AND 20240331"), "fact_sales"))
    assert refresh(source.limit(0)) == []


def test_files_tell_what_changed(spark, small_star, tmp_path):
    path = str(tmp_path / "fact")
    fact = small_star["fact_sales"].withColumn("month", F.substring(F.col("date_key").cast("string"), 1, 6))
    fact.where("month < '202404'").write.partitionBy("month").parquet(path)
    store = ProfileStore(spark, str(tmp_path / "states"), table_profile(small_star["fact_sales"], "fact_sales"))
    read = []

    def refresh():
        read.clear()
        table = lambda: spark.read.schema(fact.schema).parquet(path)
        store.refresh(file_versions(spark, path, "month"),
                      lambda p: read.extend(p) or table().where(F.col("month").isin(p)), F.col("month"))
        equal(store.whole(), profile.whole_profile(table().drop("month"), "fact_sales"))
        return sorted(read)

    assert refresh() == ["202401", "202402", "202403"]
    assert refresh() == []
    (fact.where("month IN ('202402', '202405')").withColumn("quantity", F.lit(-1)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path))
    assert refresh() == ["202402", "202405"]
    plan = file_versions(spark, path, "month")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_states_are_all_that_is_read(spark, small_star, tmp_path):
    store = ProfileStore(spark, str(tmp_path), table_profile(small_star["fact_sales"], "fact_sales"))
    assert store.whole().first().total_rows == 0 and store.histogram("quantity").collect() == []
    df = small_star["fact_sales"]
    versions = spark.createDataFrame([("a", "1")], "period string, version string")
    store.refresh(versions, lambda p: df, F.lit("a"))
    assert {f.split("/")[-3] for f in store._live("states", None).inputFiles()} <= {"states", "index"}
    equal(store.whole(), profile.whole_profile(df, "fact_sales"))
