import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from plumbline.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, at long, digest string, `group` string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def levels_of(leaves, fanout):
    levels = [leaves]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([sha("".join(now[i:i + fanout])) for i in range(0, len(now), fanout)])
    return levels


def siblings(levels, at, fanout):
    for level in levels[:-1]:
        begin = at // fanout * fanout
        yield "".join(level[begin:at]), "".join(level[at + 1:begin + fanout])
        at //= fanout


def brute_force(rows, fanout=2):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {g: levels_of([leaf_of(r) for r in groups[g]], fanout) for g in order}
    top = levels_of([trees[g][-1][0] for g in order], fanout)
    found = []
    for k, g in enumerate(order):
        for i, row in enumerate(groups[g]):
            path = [*siblings(trees[g], i, fanout), *siblings(top, k, fanout)]
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None
            folded = leaf_of((*row[:3], row[3] + 1, row[4]) if changed else row)
            for a, b in path:
                folded = sha(a + folded + b)
            found.append((row[0], leaf_of(row), trees[g][-1][0], sha("".join(a + b for a, b in path)), folded, top[-1][0]))
    return found


def proofs(spark, rows, fanout=2):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(5)
    claim = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, {"n_chars": F.col("n_chars") + 1})
    return merkle.proofs(merkle.manifest(df, claim=claim, fanout=fanout))


def some_rows(n, langs, seed=1):
    rng = random.Random(seed)
    return [(rng.choice([None, i, i, i, i // 2]), rng.choice(["a", None, "é", ""]), rng.choice(langs),
             rng.choice([None, 5, 6]), rng.choice([None, "", "x" * 9, "ü\n:-", "1:2"])) for i in range(n)]


@pytest.mark.parametrize("rows, fanout", [
    (some_rows(1, [None]), 2), (some_rows(60, ["en", None, "a", "é", "z"]), 2), (some_rows(700, ["en"] * 9 + ["b"]), 3),
    (some_rows(3_000, ["en"] * 30 + [str(i) for i in range(9)]), 2), (some_rows(3, ["a"]) * 40, 2),
    ([(0, "s", "en", 1, "long " * 400_000), (0, "s", "en", 1, "long " * 400_000)], 2)])
def test_same_as_brute_force(rows, fanout, spark):
    key = lambda r: tuple(map(str, r))
    found = proofs(spark, rows, fanout).select("doc_id", "leaf", "subroot", "proof_sha256", "folded_root", "root").collect()
    assert sorted(map(tuple, found), key=key) == sorted(brute_force(rows, fanout), key=key)


def test_empty_table(spark):
    assert proofs(spark, []).collect() == []


def test_a_changed_field_is_found(spark):
    rows = some_rows(200, ["en", "de"], 3)
    for r in proofs(spark, rows).collect():
        if r["folded_root"] == r["root"]:
            assert r["leaf"] in {leaf_of(x) for x in rows}
    assert any(r["folded_root"] != r["root"] for r in proofs(spark, rows).collect())


def test_descent_of_some_requests():
    """Any subset of ranks goes down together; paths lead back to the top."""
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(23)]
    for fanout in (2, 3, 7):
        levels = merkle.height(len(leaves), fanout)
        top, digests, children = merkle.records(b"".join(leaves), levels, fanout)
        wanted = [0, 5, 6, 17, 22]
        got = list(merkle.descend(dict(zip(digests, children)), top, wanted, levels, fanout))
        assert [(rank, digest) for rank, digest, _ in got] == [(i, leaves[i]) for i in wanted]
        assert all(merkle.fold(digest, path) == top for _, digest, path in got)
        assert merkle.fold(leaves[1], got[0][2]) != top


def test_fields_are_told_apart(spark):
    df = spark.createDataFrame([("1", None), (None, "1"), ("", "1"), ("1:1", "-")], "a string, b string")
    leaves = [bytes(r[0]) for r in df.select(merkle.leaf([F.col("a"), F.col("b")])).collect()]
    assert len(set(leaves)) == 4
