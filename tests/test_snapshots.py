"""A snapshot copies changed periods only, proves its copies, and finds damaged ones."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from plumbline.sources.registry import Warehouse
from plumbline.sources.snapshots import Snapshots, fast_hash, fingerprints, portable_hash, snapshot_by_content

SCHEMA = "day date, id bigint, name string, price decimal(12,2), tags array<string>"


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(3_000).selectExpr(
        "date_add(date '2024-01-01', cast(id % 10 as int)) as day", "id", "if(id % 7 = 0, null, concat('n', id % 5)) as name",
        "cast(id / 4 as decimal(12,2)) as price", "if(id % 3 = 0, array('a', null), array(null, 'a')) as tags").cache()


def actions(report):
    found = {}
    for r in report.collect():
        assert r.agrees
        found.setdefault(r.action, set()).add(r.period[-2:])
    return found


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("hashed", [fast_hash, portable_hash])
def test_changed_days_only(spark, table, tmp_path, hashed):
    copies = Snapshots(spark, str(tmp_path / "s"), hashed)
    days = {f"{i:02d}" for i in range(1, 11)}
    first = table.where("day <> date '2024-01-10'")
    assert actions(copies.take(first, F.col("day"))) == {"COPIED": days - {"10"}}
    changed = table.where("day <> date '2024-01-02'").withColumn(
        "name", F.when(F.col("id") == 4, F.lit(None)).otherwise(F.col("name")))
    assert actions(copies.take(changed, F.col("day"))) == {
        "KEPT": days - {"02", "05", "10"}, "COPIED": {"05", "10"}, "REMOVED": {"02"}}
    assert same(copies.read(), changed) and same(copies.read(1), first)
    # other order and layout: nothing to copy, and nothing is written
    assert set(actions(copies.take(changed.orderBy(F.desc("id")).repartition(3), F.col("day")))) == {"KEPT"}
    assert not os.path.exists(tmp_path / "s" / "data" / "snapshot_version=3")
    assert same(copies.read(periods=["p2024-01-05"]), changed.where("day = date '2024-01-05'"))


def test_one_folder_is_read(spark, table, tmp_path):
    copies = Snapshots(spark, str(tmp_path))
    copies.take(table, F.col("day"))
    copies.take(table.where("id <> 4"), F.col("day"))
    assert len(copies.read(periods=["p2024-01-05"]).inputFiles()) > 0
    plan = copies.read(periods=["p2024-01-05"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "PushedFilters: []" in plan
    rows = copies.read()
    assert rows.count() == 2_999 and rows.columns == table.columns  # the replaced copy of a day is not read again


def test_one_scan_of_the_source(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "t"))
    plan = fingerprints(spark.read.parquet(str(tmp_path / "t")), F.col("day"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_damage_is_found_and_mended(spark, table, tmp_path):
    copies = Snapshots(spark, str(tmp_path))
    copies.take(table, F.col("day"))
    assert copies.damaged().count() == 0
    folder = f"{tmp_path}/data/snapshot_version=1/snapshot_period="
    for f in glob.glob(f"{folder}p2024-01-03/*.parquet"):
        os.remove(f)
    for f in glob.glob(f"{folder}p2024-01-06/*.parquet"):
        with open(f, "r+b") as out:
            out.truncate(40)
    for f in glob.glob(f"{folder}p2024-01-06/.*.crc"):
        os.remove(f)
    spare = table.where("day = date '2024-01-07'").withColumn("price", (F.col("price") + 1).cast("decimal(12,2)"))
    spare.write.mode("overwrite").parquet(f"{folder}p2024-01-07")
    found = {r.period[-2:]: (r.rows, r.stored_rows) for r in copies.damaged().collect()}
    assert found == {"03": (300, 0), "06": (300, 0), "07": (300, 300)}
    assert set(actions(copies.take(table, F.col("day")))) == {"KEPT"}  # trusts its manifest
    assert actions(copies.take(table, F.col("day"), verify=True))["COPIED"] == {"03", "06", "07"}
    assert copies.damaged().count() == 0 and same(copies.read(), table)


def test_hash_tells_rows_apart(spark):
    """NULLs in other places, values that move between columns, repeated rows and nested NULLs."""
    rows = [("a", None, ["x", None]), (None, "a", ["x", None]), ("a", None, [None, "x"]), ("a|", "b", None), ("a", "|b", None),
            ("", None, []), (None, "", []), (None, None, None)]
    for hashed in (fast_hash, portable_hash):
        seen = {tuple(fingerprints(spark.createDataFrame([r] * n, "a string, b string, c array<string>"), F.lit("p"), hashed)
                      .first()) for r in rows for n in (1, 2, 3)}
        assert len(seen) == 3 * len(rows)


def test_odd_tables(spark, tmp_path):
    copies = Snapshots(spark, str(tmp_path / "a"))
    empty = spark.createDataFrame([], SCHEMA)
    assert copies.take(empty, F.col("day")).collect() == [] and copies.read().collect() == []
    assert copies.read().columns == empty.columns and copies.last() == 1
    odd = spark.createDataFrame([(None, 1, "x", None, None), (None, 1, "x", None, None), (None, None, None, None, [None])], SCHEMA)
    assert [(r.period, r.rows) for r in copies.take(odd, F.col("day")).collect()] == [("p", 3)]
    assert same(copies.read(), odd)
    assert [r.action for r in copies.take(empty, F.col("day")).collect()] == ["REMOVED"]
    assert copies.read().count() == 0 and copies.read(2).count() == 3
    renamed = odd.withColumnRenamed("name", "label")
    assert [r.action for r in copies.take(renamed, F.col("day")).collect()] == ["COPIED"]
    again = renamed.withColumnRenamed("label", "name")
    assert [r.action for r in copies.take(again, F.col("day")).collect()] == ["COPIED"]  # another schema
    with pytest.raises(ValueError):
        copies.take(odd.withColumn("snapshot_period", F.lit(1)))
    with pytest.raises(ValueError):
        Snapshots(spark, str(tmp_path / "b")).read()


def test_warehouse(spark, tmp_path):
    w = Warehouse({"dim": spark.range(5), "fact": spark.range(20).withColumn("k", F.col("id") % 2)})
    copy = snapshot_by_content(spark, w, str(tmp_path), {"fact": F.col("k")})
    assert same(copy["dim"], w["dim"]) and same(copy["fact"], w["fact"])
    assert {r.period for r in Snapshots(spark, f"{tmp_path}/fact").manifest().collect()} == {"p0", "p1"}


def test_few_periods_are_copied_without_a_shuffle(spark, table, tmp_path):
    """Many are brought together, so that a task does not write a file for each."""
    files = {}
    for name, period in (("few", F.col("day")), ("many", F.expr("id % 40"))):
        copies = Snapshots(spark, str(tmp_path / name))
        source = table.repartition(6)
        assert {r.action for r in copies.take(source, period).collect()} == {"COPIED"}
        assert same(copies.read(), table)
        files[name] = len(glob.glob(f"{tmp_path}/{name}/data/*/*/*.parquet"))
    assert files["few"] == 6 * 10  # as the source lies
    assert files["many"] < 6 * 40
