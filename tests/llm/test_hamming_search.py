import random

import numpy as np
import pytest

from plumbline.llm import hamming_search


def brute(vectors, queries, k, words=1):
    def code(v):
        return sum(1 << i for i, x in enumerate(v) if x is not None and x > 0)

    rows = [(i, code(v)) for i, v in vectors if i is not None and v is not None]
    out = set()
    for q, v in queries:
        if q is None or v is None:
            continue
        best = sorted(((code(v) ^ c).bit_count(), i) for i, c in rows)[:k]
        out |= {(q, rank, i, d) for rank, (d, i) in enumerate(best, 1)}
    return out


def vectors(n, width, seed=12):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        noise = rng.choice([0.0, 0.2, 2.0])
        rows.append((i * 3, [x + rng.gauss(0, noise) if noise else x for x in c]))
    return rows


@pytest.mark.parametrize("width, chunk", [(64, 1000), (64, 5), (100, 1000), (10, 1)])
def test_against_brute_force(spark, width, chunk):
    rows = vectors(260, width)
    df = spark.createDataFrame(rows, "id long, vector array<float>")
    queries = df.where("id % 10 = 0")
    found = hamming_search.top_k(df, queries, 7, chunk).collect()
    assert {tuple(r) for r in found} == brute(rows, [r for r in rows if r[0] % 10 == 0], 7)


def test_hot_code_and_ties(spark):
    rows = [(i, [1.0, -1.0] * 32) for i in range(300)] + [(1000 + i, [1.0] * i + [-1.0] * (64 - i)) for i in range(64)]
    df = spark.createDataFrame(rows, "id long, vector array<float>")
    found = hamming_search.top_k(df, df.where("id in (0, 1000, 1063)"), 10, 9).collect()
    assert {tuple(r) for r in found} == brute(rows, [r for r in rows if r[0] in (0, 1000, 1063)], 10)


def test_edge_rows(spark):
    rows = [(1, None), (None, [1.0] * 64), (2, [None] * 64), (3, [1.0, float("nan")]), (4, []), (4, []), (5, [1.0] * 70)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "id long, vector array<float>, distance int")
    found = hamming_search.top_k(df, df, 3).collect()
    repeated = [(i, [1.0 if x is not None and (x > 0 or x != x) else -1.0 for x in v] if v is not None else None) for i, v in rows]
    assert {tuple(r) for r in found} == brute(repeated, repeated, 3) and len(found) == 4 * 3
    assert hamming_search.top_k(df.where("false"), df, 3).count() == 0
    assert hamming_search.top_k(df, df.where("false"), 3).count() == 0


def coded(spark, values):
    return spark.createDataFrame([(i, [v]) for i, v in enumerate(values)], "id long, code array<long>")


def test_index_is_written_once_and_not_shuffled_again(spark):
    rng = np.random.default_rng(3)
    index = hamming_search.build(coded(spark, rng.integers(-2 ** 63, 2 ** 63, 3000).tolist() + [7] * 500), 2, 1)
    assert index.table.count() == 4 * 3001 and index.rows == 3002
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asking = coded(spark, [7, -1]).selectExpr("id as query_id", "code as q", "cast(null as int) as kth")
        plan = hamming_search.meet(asking, index, 1)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") == 1  # of the queries
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_value_is_dealt_in_chunks(spark):
    """All codes share the value of one segment: no chunk holds more than its share, and every code is met once."""
    codes = [(v << 16) + 5 for v in range(4000)]
    index = hamming_search.build(coded(spark, codes), 1, 1, 200)
    sizes = index.table.where("s = 0").groupBy("chunk").count().toPandas()["count"]
    assert len(sizes) == 20 and sizes.max() < 300
    asking = coded(spark, [5]).selectExpr("id as query_id", "code as q", "cast(null as int) as kth")
    met = hamming_search.meet(asking, index, 0).collect()
    assert sorted(r["id"] for r in met) == list(range(4000))
    assert all(r["distance"] == (codes[r["id"]] ^ 5).bit_count() for r in met)
    assert not hamming_search.meet(asking, index, 1).collect()  # met before, by another segment


def test_a_query_leaves_when_it_is_covered(spark, monkeypatch):
    asked, meet = [], hamming_search.meet
    monkeypatch.setattr(hamming_search, "meet", lambda a, i, r: asked.append(a.count()) or meet(a, i, r))
    rows = [(i, [1.0 if v >> b & 1 else -1.0 for b in range(64)]) for i, v in enumerate(
        [0, 0, 1, 3, (1 << 64) - 1, 0xFFFF00000000FFFF])]
    df = spark.createDataFrame(rows, "id long, vector array<float>")
    found = hamming_search.top_k(df, df.where("id in (0, 4)"), 3).collect()
    assert {tuple(r) for r in found} == brute(rows, [rows[0], rows[4]], 3)
    # 0 has its three within 3 bits: done at once. 4 needs 62 bits covered, which takes radius 15.
    assert asked == [2] + [1] * 15
