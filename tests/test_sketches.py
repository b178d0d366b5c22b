"""States of periods merge to exactly the state of all rows; estimates keep their error."""

import pytest
from pyspark.sql import functions as F

from plumbline.operators import sketches

KEYS = {"a": ["a"], "b": ["b"], "both": ["a", "b"], "few": ["few"]}


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(120_000).selectExpr(
        "cast(id % 10 as int) as day", "if(id % 3 = 0, -1, id % 50000) as a", "cast(id as string) as b", "id % 7 as few",
        "if(id % 2 = 0, null, id) as holes").cache()


@pytest.mark.parametrize("hashed", [sketches.fast_hash, sketches.portable_hash])
def test_merged_is_the_whole(table, hashed):
    rows = lambda df: sorted(map(tuple, df.select("key_set", "register", "rank", "rows").collect()))
    states = sketches.period_states(table, F.col("day"), KEYS, hashed=hashed)
    whole = sketches.period_states(table, F.lit(0), KEYS, hashed=hashed)
    assert rows(sketches.merged(states)) == rows(whole)
    some = sketches.period_states(table.where("day between 2 and 5"), F.lit(0), KEYS, hashed=hashed)
    assert sorted(map(tuple, sketches.distinct_between(states, 2, 5).collect())) == sorted(
        map(tuple, sketches.estimates(sketches.merged(some)).collect()))


def test_error_is_within_its_bound(table):
    states = sketches.period_states(table, F.col("day"), {**KEYS, "holes": ["holes"]})
    found = {r.key_set: r for r in sketches.distinct_between(states, 0, 9).collect()}
    for name, columns in {**KEYS, "holes": ["holes"]}.items():
        exact = table.select(*columns).na.drop().distinct().count()
        assert abs(found[name].distinct_estimate - exact) <= 3 * 1.04 / 64 * exact
        assert found[name].rows == (60_000 if name == "holes" else 120_000)
    assert found["few"].distinct_estimate == 7


def test_a_period_replaced_and_an_empty_one(spark, table):
    states = sketches.period_states(table, F.col("day"), KEYS)
    other = table.where("day = 3").selectExpr("day", "a + 1000000 as a", "b", "few")
    replaced = states.where("period <> 3").union(sketches.period_states(other, F.col("day"), KEYS))
    whole = table.where("day <> 3").select("day", "a", "b", "few").union(other)
    assert sorted(map(tuple, sketches.distinct_between(replaced, 0, 9).collect())) == sorted(
        map(tuple, sketches.distinct_between(sketches.period_states(whole, F.col("day"), KEYS), 0, 9).collect()))
    assert sketches.distinct_between(states, 50, 60).collect() == []
    assert sketches.period_states(table.limit(0), F.col("day"), KEYS).collect() == []


def test_one_scan_for_all_key_sets(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "t"))
    states = sketches.period_states(spark.read.parquet(str(tmp_path / "t")), F.col("day"), KEYS)
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "holes" not in plan.split("ReadSchema")[1]
