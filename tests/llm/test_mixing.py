import random

import pytest
from pyspark.sql import functions as F

from plumbline.llm import mixing


def filled(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by repeated resharing."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        rate = budget / sum(weight[s] for s in free)
        over = {s for s in free if rate * weight[s] > most * sizes[s]}
        if not over:
            out.update({s: rate * weight[s] for s in free})
            break
        for s in over:
            out[s] = most * sizes[s]
            budget -= out[s]
        free -= over
    return out


def corpus(spark, seed, n=600):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "b", "b", "b", "c", "Z", "é", None]), " ".join("w" for _ in range(int(rng.expovariate(1 / 40)))))
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, text string")


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_taken(spark, seed):
    rows, df = corpus(spark, seed)
    found = mixing.mixed(df).collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    goals = filled(sizes)
    for source, goal in goals.items():
        own = [r for r in found if r["source"] == source]
        assert all(abs(r["target"] - goal) < 1e-6 * max(goal, 1) and r["source_size"] == sizes[source] for r in own)
        # some document that could close the gap was tried: the rest is below the size of a common document
        assert abs(sum(r["taken"] for r in own) - goal) <= max([r["size"] for r in own]) / 2
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in found)


def test_reruns_agree_and_mix_repeats(spark):
    rows, df = corpus(spark, 3, 200)
    first = {(r["doc_id"], r["taken"]) for r in mixing.mixed(df).collect()}
    again = {(r["doc_id"], r["taken"]) for r in mixing.mixed(df.repartition(7)).collect()}
    assert first == again
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    words = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.sum(mixing.words(F.col("text"))).alias("n")).collect()}
    assert {(i, words.get(i, 0)) for i, _ in first} == first


def test_edge_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mixed(empty).count() == 0 and mixing.mix(empty).count() == 0
    rows = [(1, None, None), (1, None, None), (None, "a", "x y"), (2, "a", ""), (3, "b", "one\u00a0word\x0btwo " + "z " * 30_000)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, source string, text string, size int, h int")
    found = {(r["doc_id"], r["source"]): r for r in mixing.mixed(df).collect()}
    assert found[(1, None)]["size"] == 0 and found[(1, None)]["target"] == 0.0
    assert found[(None, "a")]["size"] == 2 and found[(3, "b")]["size"] == 30_002
    assert mixing.mix(df).columns == df.columns


def test_no_python_in_the_plan(spark):
    _, df = corpus(spark, 4, 50)
    plan = mixing.mixed(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
