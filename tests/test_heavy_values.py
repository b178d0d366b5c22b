"""Frequent values by summaries and a recount: none missing, all counts exact."""

import pytest
from pyspark.sql import functions as F

from plumbline.operators.heavy_values import candidates, counters, heavy_values


def exact(df, columns, share):
    n = df.count()
    return sorted(((c, r[c], r["count"]) for c in columns
                   for r in df.groupBy(F.col(c).cast("string").alias(c)).count().where(F.col("count") >= share * n).collect()),
                  key=str)


def found(df, columns, share):
    return sorted(((r.column_name, r.value, r.row_count) for r in heavy_values(df, columns, share).collect()), key=str)


@pytest.fixture(scope="module")
def table(spark):
    """A column of mostly single values with some heavy ones, in order of value so that tasks differ; one of few values."""
    return spark.range(0, 300_000, 1, 12).selectExpr(
        "case when id % 3 = 0 then 7 when id % 100 = 1 then 8 when id between 100000 and 103999 then 9 "
        "when id % 250 = 2 then null when id % 5 = 0 then id div 400 else id + 1000 end as wide",
        "id % 20 as few", "concat(repeat('x', 200), if(id % 2 = 0, 0, id)) as long").cache()


@pytest.mark.parametrize("share", [0.5, 0.01, 0.004, 0.0025])
def test_none_is_missing(table, share):
    columns = ["wide", "few", "long"]
    wanted = exact(table, columns, share)
    assert found(table, columns, share) == wanted and wanted


def test_candidates_are_bounded(table):
    for share in (0.01, 0.004):
        rows, named = candidates(table, ["wide", "long"], share)
        assert rows == 300_000
        assert all(len(v) <= 2 / share for v in named.values())
        assert max(map(len, named["long"])) <= 65


def test_hard_order(spark):
    """Equal counts of many values just below the share, then the heavy one, split over tasks."""
    rows = spark.range(0, 99_000, 1, 7).selectExpr("id % 150 as v").union(spark.range(1_000).selectExpr("1000 as v"))
    assert found(rows, ["v"], 0.01) == [("v", "1000", 1_000)]
    assert len(found(rows, ["v"], 0.0066)) == 151


def test_odd_tables(spark):
    schema = "a string, `b.c` int"
    make = lambda rows: found(spark.createDataFrame(rows, schema), ["a", "b.c"], 0.3)
    assert make([]) == []
    assert make([(None, None)]) == [("a", None, 1), ("b.c", None, 1)]
    assert make([("", 1), ("", 2), (None, 3), ("n", 3)]) == [("a", "", 2), ("b.c", "3", 2)]
    with pytest.raises(ValueError):
        counters(0)


def test_reads_counted_columns_only(spark, table, tmp_path):
    table.limit(1000).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert {r.column_name for r in heavy_values(stored, ["few"], 0.01).collect()} == {"few"}
