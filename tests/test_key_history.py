"""Incremental uniqueness equals the full check; only touched parts of the history are read. Bitmaps of keys are exact."""

import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions import keys as K
from plumbline.operators import checks as C
from plumbline.operators.checks import Suite
from plumbline.operators.integrity import orphan_report
from plumbline.operators.key_history import history_of
from plumbline.operators.validate import validate

SCHEMA = "id bigint, a string, b int"


def loads(seed):
    rng = random.Random(seed)
    row = lambda: (rng.choice([None, rng.randrange(-50, 50), rng.randrange(10 ** 12)]), rng.choice(["x", "y", None]),
                   rng.choice([None, 1, 2, 3]))
    made = [[row() for _ in range(60)] for _ in range(3)]
    made[2] += [(7, "hot", 1)] * 200
    return [*made, []]


@pytest.mark.parametrize("check", [C.unique("id"), C.compound_unique("a", "b"), C.duplicate_key("a", "b"), C.unique("a"),
                                   C.duplicate_key("id")])
def test_same_as_the_full_check(check, spark, tmp_path):
    suite = Suite("s", "t", (check,))
    history, whole = None, []
    for i, rows in enumerate(loads(3)):
        df = spark.createDataFrame(rows, SCHEMA)
        history = history or history_of(spark, str(tmp_path / "h"), check, df, parts=8)
        day = f"2026-01-{i + 1:02d}"
        clashes = {tuple(r)[:-2]: tuple(r)[-2:] for r in history.clashes(df, day).collect()}
        got = history.add(df, day).first()
        if i == 1:  # the last load again: the same
            again = history.add(df, day).first()
            assert again == got
        before = {}
        key = lambda r: tuple(dict(zip(("id", "a", "b"), r))[c] for c in check.columns)
        for r in whole:
            before[key(r)] = before.get(key(r), 0) + 1
        now = {}
        for r in rows:
            now[key(r)] = now.get(key(r), 0) + 1
        skip = lambda k: (check.kind == "unique" and None in k) or (check.kind == "compound_unique" and set(k) == {None})
        assert clashes == {k: (n, before.get(k, 0)) for k, n in now.items() if not skip(k) and (n > 1 or k in before)}
        whole += rows
        full = validate(spark.createDataFrame(whole, SCHEMA), suite).first()
        assert (got.evaluated_count, got.unexpected_count) == (full.evaluated_count, full.unexpected_count)
    assert history.totals().count() == 4
    with pytest.raises(ValueError):
        history.add(spark.createDataFrame([], SCHEMA), "2026-01-01")


def test_only_touched_parts_are_read(spark, tmp_path):
    """Ascending keys: a load of new ones meets no stored key, and one old key reads one part."""
    check = C.unique("id")
    make = lambda lo, hi: spark.range(lo, hi).selectExpr("id", "'a' as a", "1 as b")
    history = history_of(spark, str(tmp_path / "h"), check, make(0, 1), parts=64)
    million = 1 << 20
    for day in range(4):
        history.add(make(day * million, (day + 1) * million), f"2026-02-{day + 1:02d}")
    new = history._counted(make(4 * million, 4 * million + 1000)).cache()
    assert history._parts_of(new) == [4]
    assert history.suspects(new, "2026-02-05").count() == 0
    mixed = make(4 * million, 4 * million + 10).union(make(million + 5, million + 6))
    counted = history._counted(mixed)
    suspects = history.suspects(counted, "2026-02-05")
    assert [r.id for r in suspects.collect()] == [million + 5]
    stored = history.stored_keys(suspects, "2026-02-05")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "part" in plan.split("PartitionFilters")[1][:200]
    read = stored.select(F.input_file_name().alias("f")).distinct().collect()
    assert read and all("part=1/" in r.f for r in read)
    assert [tuple(r) for r in history.clashes(mixed, "2026-02-05").collect()] == [(million + 5, 1, 1)]


def fk(column="k"):
    return K.ForeignKey(column, "dim", "k", source="fact")


def test_bitmaps_are_exact(spark):
    rng = random.Random(1)
    known = {rng.randrange(-10_000, 10_000) for _ in range(3_000)} | {-(1 << 63), (1 << 63) - 1, 0, -1, 63, 64, 4096}
    asked = [*range(-10_100, 10_100), -(1 << 63), (1 << 63) - 1, (1 << 63) - 2, None, 1 << 40]
    dim = spark.createDataFrame([(k,) for k in known] + [(None,), (0,)], "k bigint")
    fact = spark.createDataFrame([(k, 1) for k in asked], "k bigint, words int")
    lookup = K.Lookup(K.key_blocks(K.key_words(dim, "k")), True)
    marked = K.mark(fact, fk(), lookup)
    assert {r.k for r in marked.where(fk().flag).collect()} == set(asked) - known
    assert marked.count() == len(asked)
    halves = [K.key_words(dim.where("k % 2 = 0"), "k"), K.key_words(dim.where("k % 2 <> 0"), "k")]
    merged = K.merged_words(halves[0].union(halves[1]))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, K.key_words(dim, "k").collect()))


def test_large_dimension_needs_no_shuffled_fact(spark, tmp_path):
    """Keys beyond the bound, bitmaps within it: the fact is joined with a broadcast and only counted."""
    dim = spark.range(100_000).selectExpr("id * 2 as k")
    spark.range(50_000).selectExpr("id as k", "1 as x").write.parquet(str(tmp_path / "fact"))
    tables = {"dim": dim, "fact": spark.read.parquet(str(tmp_path / "fact"))}
    limit = 100_000  # the keys take 24 bytes each
    assert not K.small_enough({"d": (dim, "k")}, limit)
    assert K.lookups([fk()], tables, limit)[fk().flag].bitmaps
    report = orphan_report(tables, [fk()], broadcast_bytes=limit)
    assert report.first().orphan_count == 25_000
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "hashpartitioning(k" not in plan
    assert not K.lookups([fk()], tables, 1_000)
    assert orphan_report(tables, [fk()], broadcast_bytes=1_000).first().orphan_count == 25_000
    text = {"dim": dim.selectExpr("cast(k as string) as k"), "fact": tables["fact"].selectExpr("cast(k as string) as k")}
    assert orphan_report(text, [fk()], broadcast_bytes=limit).first().orphan_count == 25_000


def test_a_dimension_is_measured_once(spark):
    dim = spark.range(10).selectExpr("id as k")
    found = K.lookups([fk("a"), fk("b")], {"dim": dim})
    assert set(found) == {fk("a").flag, fk("b").flag} and not any(x.bitmaps for x in found.values())
