import random
import re
import zlib

import pytest

from plumbline.llm import spelling


def near(a, b):
    """One code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_force(counts, ratio=10):
    form, found = {}, []
    around = {w: [v for v in counts if near(w, v)] for w in counts}
    for w, others in around.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        found.append((w, form[w], root, counts[w], len(around[w]), counts.get(form[w])))
    return sorted(found)


@pytest.fixture
def many_tasks(spark):
    """Small sorts are not put into one task, so that numbers are carried from task to task."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def variants(spark, counts, ratio=10):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted(map(tuple, spelling.variants(df, ratio).collect()))


@pytest.mark.parametrize("letters, longest, ratio", [("ab", 7, 2), ("abé", 4, 3), ("aé😀ÿ", 3, 2)])
def test_same_as_brute_force(letters, longest, ratio, spark, many_tasks):
    rng = random.Random(longest)
    counts = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, longest + 1))): rng.choice([1, 2, 3, 9, 30, 200])
              for _ in range(150)}
    assert variants(spark, counts, ratio) == brute_force(counts, ratio)


def test_chains_ties_and_long_words(spark, many_tasks):
    counts = {"letters": 100_000, "leters": 10_000, "letrs": 1_000, "ltrs": 100, "ltr": 10, "lt": 1, "lettersx": 9_999,
              "abcdefg": 5, "abcdefh": 50, "abcdefi": 50, "xbcdefg": 50, "x" * 3_000: 2, "x" * 2_999: 20,
              "x" * 1_500 + "y" + "x" * 1_499: 200, "alone": 7}
    assert variants(spark, counts) == brute_force(counts)
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).collect() == []


def test_words_of_documents(spark):
    rng = random.Random(6)
    names = ["Straßenbahn", "ÀÉÿabcd", "hello", "HÉLLOworld", "abcdefgh", "seven77letters", "x÷y×zabcd", "İstanbullu"]
    rows = [(rng.choice([None, i, i]), rng.choice([None, "", *(" ".join(rng.choices(names, k=30)) for _ in range(6))]), "w", 1)
            for i in range(80)]
    rows += rows[:9] + [(7, "abcdefg " * 50_000, "w", 1)]
    counts = {}
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] = counts.get(run, 0) + 1
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, n int").repartition(3)
    assert dict(map(tuple, spelling.words(df).collect())) == {w: n for w, n in counts.items() if n >= 2}
    assert spelling.words(df.limit(0)).collect() == []


def test_trie_numbers_are_one_to_one(spark, many_tasks):
    rng = random.Random(8)
    texts = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(9))) for _ in range(500)} - {""})
    rows = spelling.trie(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    number = {}
    for r in rows:
        for i, x in enumerate(r["nodes"]):
            assert number.setdefault(r["text"][:i], x) == x
    assert len(set(number.values())) == len(number)
    assert [r["text"] for r in sorted(rows, key=lambda r: r["nodes"][-1])] == texts
