import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.llm import simhash


def brute(texts):
    """{row: smallest id reachable} for rows (doc_id, text)."""
    prints = [simhash.simhash(t) for _, t in texts]
    group = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 4:
                    group[i] = group[j] = min(group[i], group[j])
    ids = {}
    for g, (doc_id, _) in zip(group, texts):
        if doc_id is not None:
            ids[g] = min(ids.get(g, doc_id), doc_id)
    return [ids.get(g) for g in group]


def prints_of(spark, values, extra=()):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, fp long")


def test_masks_cover_the_radius():
    masks = [m & (2 ** 64 - 1) for m in simhash.masks(4)]
    assert len(masks) == 31
    rng = random.Random(1)
    for _ in range(3000):
        differing = sum(1 << i for i in rng.sample(range(64), 4))
        assert any(m & differing == 0 for m in masks)


def test_fingerprint_by_its_definition():
    import xxhash

    text = "The quick\tBROWN fox jumps over\u00a0the lazy dog the quick brown fox"
    words = text.encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(len(words) - 3)]
    expected = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.simhash(text) == expected
    assert simhash.simhash("A b") == xxhash.xxh64_intdigest(b"a b", 42)
    assert simhash.simhash("") == simhash.simhash(None) == simhash.simhash(" \n") == 0


def test_components_against_brute_force(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(12)]
    values = []
    for b in base:
        v = b
        for _ in range(8):  # chains: each a few bits from the last
            v ^= sum(1 << i for i in rng.sample(range(64), rng.choice([0, 1, 3, 4, 5])))
            values.append(v)
    values += [0, 1, 3, 2 ** 63]
    signed = [v - 2 ** 64 if v >> 63 else v for v in values]
    group = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(values):
            for j, b in enumerate(values):
                if (a ^ b).bit_count() <= 4 and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    found = {r["doc_id"]: r["component_id"] for r in simhash.with_components(prints_of(spark, signed)).collect()}
    assert found == dict(enumerate(group))


@pytest.mark.parametrize("bucket", [2, 6])
def test_large_buckets_lose_no_link(spark, bucket):
    rng = random.Random(3)
    values = sorted({sum(1 << i for i in rng.sample(range(10), 3)) for _ in range(60)})
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = {tuple(sorted(r)) for r in simhash.link_forest(df, 1, bucket).collect()}
    assert all((a ^ b).bit_count() <= 1 for a, b in edges)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = simhash.link_forest(df, 2, bucket)
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    group = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= 2 and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    assert {v: roots.get(v, v) for v in values} == group


def test_edge_rows(spark):
    long_text = " ".join(f"w{i}" for i in range(40_000))
    rows = [(5, None), (3, ""), (9, " \n"), (7, "one two"), (7, "one two"), (None, "one two"), (1, long_text),
            (2, long_text + " end"), (None, "lonely words here today"), (None, "lonely words here today")]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, fp string")
    found = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect()), key=str)
    assert found == sorted(zip([a for a, _ in rows], brute(rows)), key=str)
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash.keep_one(df).collect()), key=str)
    assert [(a, b) for a, b in kept if a != 1] == sorted([(3, ""), (7, "one two"), (None, "lonely words here today")], key=str)
    assert simhash.keep_one(df).columns == df.columns


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0
    assert simhash.keep_one(df).count() == 0


def test_one_id_with_two_texts_is_in_two_components(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(400)) for c in "ab")
    rows = [(1, a), (3, a + " "), (1, b), (2, b + " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r["doc_id"], r["text"]) for r in simhash.keep_one(df).collect()) == [(1, a), (1, b)]


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_one_giant_component(spark, monkeypatch, broadcast_rows):
    """4,096 fingerprints in one component, one of them a third of all rows; by broadcast and by a shuffled join."""
    from plumbline.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast_rows)
    alone = [0xFFFFF << 30, 0xFFF << 50]
    rows = [(10_000 + v, v) for v in range(4096)] + [(20_000 + i, 77) for i in range(2500)]
    rows += [(5, alone[0]), (3, alone[0]), (None, alone[1])]
    prints = spark.createDataFrame(rows, "doc_id long, fp long")
    found = simhash.with_components(prints)
    assert found.columns == ["fp", "doc_id", "root", "component_id"]
    got = found.groupBy("component_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("root").alias("roots")).collect()
    assert {(r["component_id"], r["n"], r["roots"]) for r in got} == {(10_000, 4096 + 2500, 1), (3, 2, 1), (None, 1, 1)}


@pytest.mark.parametrize("step", ["keep_one", "near_duplicates", "score_documents", "train"])
def test_python_tasks_get_small_batches(spark, step):
    """A task's texts reach Python in batches of a few megabytes, not 10,000 rows at once."""
    from plumbline.llm import toxicity

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    few = spark.createDataFrame([(1, "a b c d e"), (2, "v w x y z")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int")
    settings = toxicity.Settings()
    {"keep_one": lambda: simhash.keep_one(few), "near_duplicates": lambda: simhash.near_duplicates(few),
     "score_documents": lambda: toxicity.score_documents(few, toxicity.Model(np.zeros(4), 0.0, settings)),
     "train": lambda: toxicity.train(few, labels)}[step]()

    @F.pandas_udf("long")
    def given(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.str.len() * 0 + texts.str.len().sum()

    texts = spark.range(0, 9000, 1, 1).select(F.repeat(F.lit("text"), 512).alias("text"))
    assert texts.select(given("text").alias("n")).agg(F.max("n")).first()[0] <= 5 << 20
