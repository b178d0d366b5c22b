import random

import numpy as np
import pytest

from plumbline.llm import substring_dedup as sd

SCHEMA = "doc_id long, text string, runs string, t1 int, doc string"


def brute_force(rows, length):
    """(doc_id, words, removed, kept text) of each row."""
    words = [(t or "").encode().split() for _, t in rows]
    last = float("inf")
    order = [last if d is None else d for d, _ in rows]
    owner = {}
    for k, w in zip(order, words):
        for i in range(len(w) - length + 1):
            seq = tuple(w[i:i + length])
            owner[seq] = min(owner.get(seq, k), k)
    found = []
    for (d, _), k, w in zip(rows, order, words):
        gone = {j for i in range(len(w) - length + 1) if owner[tuple(w[i:i + length])] < k for j in range(i, i + length)}
        kept = [x for j, x in enumerate(w) if j not in gone]
        found.append((d, len(w), len(gone), b" ".join(kept).decode()))
    return found


def run(spark, rows, length, gram):
    df = spark.createDataFrame([(d, t, "r", 1, "x") for d, t in rows], SCHEMA).repartition(4)
    found = sd.remove_repeats(df, length, gram).collect()
    for r in found:
        assert sum(s["stop"] - s["first"] for s in r["spans"]) == r["n_removed"]
        assert all(a["stop"] < b["first"] for a, b in zip(r["spans"], r["spans"][1:]))  # maximal
    return [(r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in found]


def same(found, expected):
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(found, key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("length, gram, letters, block", [(5, 2, "ab", None), (6, 6, "abc", None), (4, 1, "ab", 7),
                                                          (9, 3, "abcd", 16)])
def test_random_words(length, gram, letters, block, spark, monkeypatch):
    if block:
        monkeypatch.setattr(sd, "BLOCK", block)
    rng = random.Random(length)
    rows = [(rng.choice([None, i, i, i, i // 3]), rng.choice([" ", "\n", "\t "]).join(rng.choice(letters) for _ in range(
        rng.choice([0, 3, length, 20, 60])))) for i in range(90)]
    rows += [(500 + i, rows[i % 7][1]) for i in range(30)]
    same(run(spark, rows, length, gram), brute_force(rows, length))


def test_passages_copies_and_cases(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghéü") for _ in range(5))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, line, whole = text(70), text(20), text(300)
    rows = [(i, f"{text(rng.randrange(40))} {passage} {text(30)}") for i in range(40)]  # at any place
    rows += [(100 + i, f"{text(60)} {line} {text(60)}") for i in range(40)]  # too short
    rows += [(200 + i, whole) for i in range(30)] + [(200, whole)] * 3
    parts = whole.split()
    rows += [(300, " ".join(parts[:120] + ["other"] + parts[121:])), (301, " ".join(parts[10:59])), (302, whole.upper()),
             (303, " \n ".join(parts[10:60]))]
    rows += [(400, None), (401, ""), (402, " \n"), (None, whole), (None, passage), (None, None), (403, "w " * 120),
             (404, "w " * 60), (405, "w " * 49), (406, f"w w {passage}"), (407, text(50_000)),
             (408, "x" * 200_000)]
    expected = brute_force(rows, 50)
    same(run(spark, rows, 50, 12), expected)
    removed = {d: n for d, _, n, _ in expected}
    assert removed[0] == 0 and removed[39] == 70 and removed[200] == 0 and removed[229] == 300 and removed[300] == 299


def test_empty_table(spark):
    assert run(spark, [], 50, 12) == []


def test_selection_is_that_of_a_plain_scan():
    rng = random.Random(4)
    powers = [sd.Powers(b) for b in sd.BASES]
    for length, gram in ((7, 3), (50, 12), (5, 5), (9, 2)):
        words = [rng.choice([b"a", b"bb", b"c"]) for _ in range(200)]
        many = len(words) - length + 1
        anchor, first, last = sd.winnowed(sd.Words(words, powers), many, length, gram)
        assert first[0] == 0 and last[-1] == many - 1 and (first[1:] == last[:-1] + 1).all()
        for w in range(many):  # equal windows select equal anchors
            run_of = int(np.searchsorted(last, w))
            for v in range(many):
                if words[w:w + length] == words[v:v + length]:
                    assert anchor[run_of] == anchor[int(np.searchsorted(last, v))]
        hashes = sd.Words(words, powers).hashes(np.arange(many), np.arange(many) + length - 1, 1)
        assert len({int(h) for h in hashes}) == len({tuple(words[i:i + length]) for i in range(many)})
