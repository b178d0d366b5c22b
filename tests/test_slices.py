"""Slices that stand out: planted ones are found, and all are those of a plain search over every combination."""

import math
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from plumbline.operators.slices import NULL, slices

def by(*names):
    return {n: F.col(n) for n in names}


@pytest.fixture(scope="module")
def table(spark):
    spread = "pmod(xxhash64(id, {}), {})"
    return spark.range(40_000).selectExpr(
        "id", f"{spread.format(1, 8)} as store", f"{spread.format(2, 10)} as day",
        f"element_at(array('a', 'b', 'c', null), cast({spread.format(3, 4)} as int) + 1) as kind", "id as wide",
        f"{spread.format(4, 200)} = 0 as noise", f"{spread.format(5, 10)} < 8 as mostly").cache()


def g2(n, f, N, F_):
    cells = [(f, n, F_), (n - f, n, N - F_), (F_ - f, N - n, F_), (N - n - F_ + f, N - n, N - F_)]
    return 2 * sum(o * math.log(o / (r * c / N)) for o, r, c in cells if o)


def brute(rows, names, depth, share, least, least_gain):
    n, f = Counter(), Counter()
    for row in rows:
        items = [f"{d}={NULL if row[d] is None else row[d]}" for d in names]
        for k in range(depth + 1):
            for key in combinations(items, k):
                n[key] += 1
                f[key] += bool(row["failed"])
    N, F_ = n[()], f[()]
    out = {}
    for key, fails in f.items():
        if not key or fails < least or fails < share * F_ or fails * N <= n[key] * F_:
            continue
        gains = []
        for j in range(len(key)):
            p = key[:j] + key[j + 1:]
            gains.append(g2(n[key], fails, n[p], f[p]) if fails * n[p] > f[p] * n[key] else 0.0)
        if min(gains) >= least_gain:
            out[key] = (n[key], fails, round(g2(n[key], fails, N, F_), 3), round(min(gains), 3))
    return out


def found(df):
    return {tuple(r.conditions): (r.rows, r.failures, round(r.g2, 3), round(r.gain, 3)) for r in df.collect()}


def test_equal_to_brute_force(spark, table):
    small = table.where("id < 6000").drop("wide").withColumn("failed", F.expr(
        "noise or (store = 3 and mostly) or (day = 4 and kind = 'a') or (kind is null and store = 5 and day = 6)"))
    dims = by("store", "day", "kind")
    for share, least, gain in ((0.01, 5, 10.83), (0.002, 2, 0.5), (0.1, 1, 3.0)):
        got = found(slices(small, F.col("failed"), dims, 3, share, least, gain))
        wanted = brute(small.collect(), list(dims), 3, share, least, gain)
        assert got.keys() == wanted.keys()
        for key, values in wanted.items():
            assert got[key] == pytest.approx(values, abs=2e-3)


@pytest.mark.parametrize("rule, planted", [
    ("store = 3", ("store=3",)), ("store = 3 and kind = 'b'", ("store=3", "kind=b")),
    ("store = 2 and day = 7 and kind is null", ("store=2", "day=7", f"kind={NULL}"))])
def test_planted_slices_come_first(table, rule, planted):
    ranked = slices(table, F.expr(f"noise or (({rule}) and mostly)"), by("store", "day", "kind", "wide")).orderBy(F.desc("g2"))
    assert tuple(ranked.first().conditions) == planted
    assert all(set(planted) >= set(r.conditions) for r in ranked.where("gain > 40").collect())


def test_candidates_are_bounded_by_support(table):
    """A dimension with as many values as rows gives no candidates, and no set of dimensions more than 1 / share."""
    result = slices(table, F.expr("store < 4"), by("store", "day", "kind", "wide"), share=0.05, least_gain=0.0)
    sets = Counter(tuple(c.split("=")[0] for c in r.conditions) for r in result.collect())
    assert sets and max(sets.values()) <= 20 and not any("wide" in s for s in sets)


def test_two_scans(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    reads = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def seen(x):
        reads.add(1)
        return x

    slices(stored, seen("noise"), {"store": F.col("store"), "kind": F.col("kind")}).collect()
    assert reads.value == 2 * 40_000


def test_odd_inputs(spark, table):
    schema = "a string, failed boolean"
    dims = by("a")
    make = lambda rows: slices(spark.createDataFrame(rows, schema), F.col("failed"), dims, least=1, least_gain=0.0)
    assert make([]).collect() == [] and make([("x", False)] * 9).collect() == []
    assert make([("x", True)] * 9).collect() == []  # fails no more often than the whole
    odd = make([(None, True)] * 9 + [("x", None)] * 9 + [("null", False)] * 9 + [("", True)])
    assert sorted((r.conditions, r.rows, r.failures) for r in odd.collect()) == [
        (["a="], 1, 1), ([f"a={NULL}"], 9, 9)]


def test_the_query_joins_the_lines_once(spark, small_star, monkeypatch):
    """Both scans of the search read what the joins gave."""
    from plumbline.plans.queries import defects

    scanned = []
    monkeypatch.setattr(defects, "slices", lambda df, *a, **k: scanned.append(df) or slices(df, *a, **k))
    monkeypatch.setattr(defects, "mirror", lambda *_: defects.defects.inject(small_star, "2026-04-29"))
    assert defects.failure_slices(spark, "").columns[0] == "conditions"
    assert "Join" not in scanned[0]._jdf.queryExecution().executedPlan().toString()
    assert scanned[0].count() == small_star["fact_sales"].count() + 50
