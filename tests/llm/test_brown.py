import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from plumbline.llm import brown

SMALL = brown.Settings(head=60, assigned=40, clustered=20, classes=4, passes=5)


def corpus(n=120):
    rng = random.Random(11)
    left, right = [f"l{i}" for i in range(15)], [f"R{i}." for i in range(15)]
    rare = [f"rare{i}x" for i in range(200)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(1, 40)):
            words += [rng.choice(left), rng.choice(right)]
            if rng.random() < 0.2:
                words.append(rng.choice(rare))
        rows.append((i, " ".join(words)))
    return rows


def objective(counts, group):
    k = group.max() + 1
    member = np.eye(k)[group]
    pairs = member.T @ counts @ member
    f = brown._xlogx
    return f(pairs).sum() - f(pairs.sum(0)).sum() - f(pairs.sum(1)).sum()


def test_exchange_raises_mutual_information():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 9, (14, 14)).astype(float)
    counts[:6, 6:12] += 40
    start = np.array([i % 3 for i in range(12)] + [3, 4])
    found = brown.exchange(counts, start, 12, 3, 10)
    assert objective(counts, found) > objective(counts, start)
    assert found[12] == 3 and found[13] == 4
    for word in range(12):  # no single move is better
        for new in range(3):
            other = found.copy()
            other[word] = new
            assert objective(counts, other) <= objective(counts, found) + 1e-6


def test_gain_is_the_change_of_the_objective():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 30, (8, 8)).astype(float)
    group = np.array([0, 1, 2, 0, 1, 2, 0, 1])
    member = np.eye(3)[group]
    member[5] = 0
    pairs = member.T @ counts @ member
    right, left = member.T @ counts[5], member.T @ counts[:, 5]
    gain = brown._gain(pairs, right, left, counts[5, 5])
    for a in range(3):
        for b in range(3):
            one, two = group.copy(), group.copy()
            one[5], two[5] = a, b
            assert abs((objective(counts, one) - objective(counts, two)) - (gain[a] - gain[b])) < 1e-6


def frames(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_base_score_and_counts(spark):
    rows = corpus()
    odd = [(1000, None), (1000, None), (None, "never seen THESE l1"), (1001, "l1 " * 50_000), (1002, "é  x 12 R1.")]
    docs = frames(spark, rows + odd)
    model, vocab = brown.train(frames(spark, rows).select("text"), SMALL)
    found = brown.score(docs, model, vocab).collect()
    assert len(found) == len(rows) + len(odd)
    counts = Counter(w for _, t in rows for w in brown.tokens(t))
    total = sum(counts.values())
    texts = {i: t for i, t in rows + odd}
    for r in found:
        words = brown.tokens(texts[r["doc_id"]])
        assert r["n_tokens"] == len(words) and r["n_known"] == sum(w in counts for w in words)
        assert r["train_tokens"] == total
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in words)
        assert abs(base - r["base_score"]) < 1e-7 * abs(base) + 1e-9
        assert r["score"] < 0 and abs(r["perplexity"] - 10 ** (-r["score"] / len(words))) < 1e-6 * r["perplexity"]
    known = [r for r in found if r["doc_id"] is not None and r["doc_id"] < 1000]
    assert sum(r["score"] for r in known) > sum(r["base_score"] for r in known)


def test_probabilities_sum_to_one(spark):
    rows = corpus()
    model, vocab = brown.train(frames(spark, rows).select("text"), SMALL)
    assert np.allclose((10 ** model.transition).sum(1), 1)
    head = set(model.words.split(b"\n"))
    mass = np.zeros(len(model.transition))
    np.add.at(mass, model.group, 10 ** model.emission)
    for word, c in ((bytes(r["word"]), r["c"]) for r in vocab.collect()):
        if word not in head:
            f = brown.form(word)
            mass[model.end + 1 + f] += (c + 1) / 10 ** model.form_total[f]
    for f in range(brown.FORMS):  # one share is left for the unseen
        mass[model.end + 1 + f] += 1 / 10 ** model.form_total[f]
    used = np.unique(np.append(model.group, model.end + 1 + np.arange(brown.FORMS)))
    assert np.allclose(mass[used], 1)


def test_empty_training(spark):
    model, vocab = brown.train(frames(spark, []).select("text"), SMALL)
    row = brown.score(frames(spark, [(1, "a b")]), model, vocab).first()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and row["base_score"] == 0.0
    assert brown.score(frames(spark, []), model, vocab).count() == 0


def test_best_classes_is_the_largest_gain():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 30, (6, 6)).astype(float)
    dense = rng.integers(0, 3, (50, 12)).astype(float)
    dense[:, 0] += 1
    word, cell = np.nonzero(dense)
    found = brown.best_classes(counts, word, cell, dense[word, cell], 4)
    for i, row in enumerate(dense):
        gain = brown._gain(counts, row[:6], row[6:], 0.0)[:4]
        assert abs(gain[found[i]] - gain.max()) < 1e-9


def test_every_word_of_the_training_texts_has_a_class(spark):
    rows = corpus()
    rows += [(2000 + i, f"l1 {'x' * 80}{i % 3} l2 tailA{i} l3 R4. tailB{i}") for i in range(30)]
    model, rarer = brown.train(frames(spark, rows).select("text"), SMALL)
    counts = Counter(w for _, t in rows for w in brown.tokens(t))
    head = model.words.split(b"\n")
    found = {bytes(r["word"]): r for r in rarer.collect()}
    assert not set(head) & set(found) and set(head) | set(found) == set(counts)
    assert all(r["c"] == counts[w] and 0 <= r["class"] < SMALL.classes for w, r in found.items())
    assert model.group[0] == model.end and (model.group[1:] < SMALL.classes).all()
    # The class follows the neighbours: what stands before a left word is where right words stand.
    follow = Counter(r["class"] for w, r in found.items() if w.startswith(b"taila"))
    assert follow.most_common(1)[0][1] > 25


def test_score_by_hand(spark):
    rows = corpus()
    model, rarer = brown.train(frames(spark, rows).select("text"), SMALL)
    head = {w: i for i, w in enumerate(model.words.split(b"\n"))}
    rest = {bytes(r["word"]): r for r in rarer.collect()}
    texts = {**dict(rows[:20]), 5000: "rare1x rare2x Never rare1x l1 rare3x", 5001: ""}
    for r in brown.score(frames(spark, list(texts.items())), model, rarer).collect():
        score, last = 0.0, model.end
        for w in brown.tokens(texts[r["doc_id"]]):
            if w in head:
                now, within = model.group[head[w]], model.emission[head[w]]
            elif w in rest:
                now = model.rare + rest[w]["class"]
                within = math.log10(rest[w]["c"]) - model.rare_total[rest[w]["class"]]
            else:
                now, within = model.end + 1 + brown.form(w), -model.form_total[brown.form(w)]
            score, last = score + model.transition[last, now] + within, now
        assert abs(score - r["score"]) < 1e-9 * abs(score)


def test_exchange_finds_the_best_clustering_of_a_tiny_vocabulary():
    """All clusterings of seven words into two classes are tried; the exchange is at the best of them."""
    rng = np.random.default_rng(7)
    counts = rng.integers(0, 6, (9, 9)).astype(float)
    counts[:4, 4:7] += 30
    counts[4:7, :4] += 20
    start = np.array([i % 2 for i in range(7)] + [2, 3])
    found = brown.exchange(counts, start, 7, 2, 20)
    best = max(objective(counts, np.array([code >> i & 1 for i in range(7)] + [2, 3])) for code in range(1, 127))
    assert abs(objective(counts, found) - best) < 1e-9


def test_extra_columns_and_repeated_rows_without_id(spark):
    rows = corpus(40)
    model, rarer = brown.train(frames(spark, rows).select("text"), SMALL)
    odd = [(None, rows[0][1], b"x", 1, True)] * 3 + [(rows[0][0], rows[0][1], b"y", 2, False)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, ids binary, block int, train boolean")
    found = brown.score(docs, model, rarer).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["0", "None", "None", "None"]
    assert len({(r["n_tokens"], r["n_known"], r["score"], r["base_score"]) for r in found}) == 1


def test_blocks_are_cut_between_documents(spark, monkeypatch):
    """Scores do not depend on where blocks end, nor on how wide their numbers are."""
    rows = corpus(60)
    scores = []
    for size, words in ((1 << 19, 60_000), (50, 60_000), (1 << 19, 5)):
        monkeypatch.setattr(brown, "BLOCK_TOKENS", size)
        monkeypatch.setattr(brown, "BLOCK_WORDS", words)
        model, rarer = brown.train(frames(spark, rows).select("text"), SMALL)
        scores.append({r["doc_id"]: round(r["score"], 8) for r in brown.score(frames(spark, rows), model, rarer).collect()})
    assert scores[0] == scores[1] == scores[2]
    monkeypatch.setattr(brown, "BLOCK_WORDS", 10 ** 9)
    wide = [(1, " ".join(f"w{i}" for i in range(70_000)) + " l1 R1."), (2, "l1 R1.")]
    monkeypatch.setattr(brown, "BLOCK_TOKENS", 1 << 30)
    model, rarer = brown.train(frames(spark, wide).select("text").coalesce(1), SMALL)
    found = {r["doc_id"]: r for r in brown.score(frames(spark, wide).coalesce(1), model, rarer).collect()}
    assert found[1]["n_tokens"] == found[1]["n_known"] == 70_003 and found[2]["n_known"] == 3


def test_forms_of_many_words():
    words = [b"", b".", b"end.", b"a,", b"x:", b"4th", b"4th!", "\u00e9t\u00e9".encode(), "\u00e97".encode(), b"it's", b"", b"four", b"eight",
             b"longerword", b"\x7f", b"eightlet", b""]
    whole = pa.array(words, pa.binary())
    assert brown.forms(whole).tolist() == [brown.form(w) for w in words]
    assert brown.forms(whole[3:9]).tolist() == [brown.form(w) for w in words[3:9]]
    assert brown.forms(whole[:1]).tolist() == [brown.form(b"")] and not len(brown.forms(whole[:0]))


def test_packed_numbers():
    for top in (0, 255, 256, 65_535, 65_536, 2 ** 32 - 1, 2 ** 32):
        numbers = np.array([0, top, 1])
        assert brown.unpacked(pa.scalar(brown.packed(numbers), pa.binary())).tolist() == numbers.tolist()
    assert len(brown.packed(np.arange(256))) == 257 and len(brown.packed(np.zeros(0, np.int64))) == 1


def test_words_and_cells_leave_a_task_packed(spark):
    """A block's words are one value, not one per word; cells leave a task by parts, not one row for each."""
    rows = corpus(60)
    blocks = brown.tokenise(spark.createDataFrame([(*r, r[0] % 3 > 0) for r in rows] + [(99, None, None)],
                                                  "doc_id long, text string, train boolean").coalesce(2))
    assert {f.name: f.dataType.simpleString() for f in blocks.schema}["words"] == "binary"
    learned = [[b""] + brown.tokens(t) for i, t in rows if i % 3]
    vocab = Counter(w for words in learned for w in words[1:])
    assert {bytes(r["word"]): r["c"] for r in brown.vocabulary(blocks).collect()} == vocab
    listed = sorted(vocab)[:30]
    place = {w: i for i, w in enumerate(listed)}
    expected = Counter((place[a], place[b]) for words in learned for a, b in zip(words, words[1:]) if a in place and b in place)

    def terms(number):
        return [(np.where(number < 0, 900, number * 30), np.where(number < 0, 900, number))]

    found = brown.count_cells(blocks, b"\n".join(sorted(vocab)), 30, 900, terms)
    assert {divmod(int(c), 30): int(found[c]) for c in np.flatnonzero(found)} == expected


def test_best_classes_by_steps():
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 30, (6, 6)).astype(float)
    dense = rng.integers(0, 3, (50, 12)).astype(float)
    dense[:, 0] += 1
    dense[::7, 3] = 40
    word, cell = np.nonzero(dense)
    plain = brown.best_classes(counts, word, cell, dense[word, cell], 4)
    steps = brown._steps(counts, 4, np.arange(brown.SMALL))
    assert (brown.best_classes(counts, word, cell, dense[word, cell], 4, steps) == plain).all()


def test_split_gives_the_tokens_of_a_text():
    texts = ["", None, " ", "A b", " Lead\ttrail\x0b\x0c\r\n", "\u00c9T\u00c9  \u0130x\u00a0y\u2003z\x85", "a\x1cb\x1d c\x1f\x00 d", "one", "\n\n"]
    whole = pa.array(texts, pa.string())
    assert [[w.encode() for w in ws] for ws in brown.split(whole).to_pylist()] == [brown.tokens(t) for t in texts]
    assert brown.split(whole[:0]).to_pylist() == [] and brown.split(whole[4:5]).to_pylist() == [["lead", "trail", ""]]


def test_blocks_hold_all_tokens_over_several_batches(spark, monkeypatch):
    """Every document is in one block, whatever the size of batches; a block ends after the document that fills it."""
    rows = corpus(150) + [(1000, None), (1001, ""), (1002, "l1 " * 300), (None, "New words")]
    docs = spark.createDataFrame([(*r, i % 3 > 0) for i, r in enumerate(rows)], "doc_id long, text string, train boolean")
    monkeypatch.setattr(brown, "BLOCK_TOKENS", 400)
    monkeypatch.setattr(brown, "BLOCK_WORDS", 40)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = brown.tokenise(docs.coalesce(1)).orderBy("block").toArrow()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    seen = []
    for i, block in enumerate(brown.Block.each(found.to_batches())):
        words, lengths, at = block.words.to_pylist(), block.array("lengths").tolist(), 0
        assert words[0] == brown.END and len(set(words)) == len(words)
        ids, counts, learned = block.ids.tolist(), brown.unpacked(block.row["counts"]).tolist(), Counter()
        for doc_id, train, n in zip(block.row["doc_ids"].as_py(), block.row["train"].as_py(), lengths):
            seen.append((doc_id, [words[j] for j in ids[at:at + n]]))
            at += n
            learned.update(ids[at - n:at] if train else [])
        assert at == len(ids) and counts == [learned[j] for j in range(len(words))]
        before = ids[:len(ids) - lengths[-1]]
        assert len(before) < 400 and len({0, *before}) < 40
        assert i + 1 == found.num_rows or len(ids) >= 400 or len(words) >= 40
    key = lambda r: (str(r[0]), r[1])
    assert sorted(seen, key=key) == sorted([(i, brown.tokens(t)) for i, t in rows], key=key)


def test_blocks_are_stored_and_read_a_few_at_a_time(spark):
    """Blocks of about a megabyte: neither a row group nor an Arrow batch holds all blocks of a task."""
    import glob

    import pyarrow.parquet as pq

    docs = spark.range(0, 14, 1, 1).select(F.col("id").alias("doc_id"), F.lit(True).alias("train"), F.array_join(
        F.transform(F.sequence(F.lit(1), F.lit(60_000)), lambda i: F.sha1(F.concat(i.cast("string"), F.lit("-"), F.col("id")).cast(
            "binary")).substr(1, 12)), " ").alias("text"))
    blocks = brown.tokenise(docs)
    assert blocks.count() == 14
    groups = [pq.ParquetFile(f).metadata for name in blocks.inputFiles() for f in glob.glob(name.removeprefix("file://"))]
    assert max(m.row_group(i).total_byte_size for m in groups for i in range(m.num_row_groups)) < 12 << 20

    def given(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    assert blocks.coalesce(1).mapInArrow(given, "n long").agg(F.max("n")).first()[0] < 7 << 20
    # Words are still added up over the batches of a task.
    found = list(brown._counted(iter(blocks.select("words", "sizes", "counts").limit(2).toArrow().to_batches(1))))
    assert sum(b.num_rows for b in found) == len({w for b in found for w in b.column(0).to_pylist()})
