import math
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import queries, toxicity

SF_DIR = "/root/testdata/sf0.01"


def corpus(spark, n=400):
    rows = [(i, f"Calm words number {i % 17} here. " * (i % 5 + 1) + ("You grolb now! " if i % 4 == 0 else "")
             + "More calm words.", int(i % 4 == 0)) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


def test_learns_and_locates(spark):
    df = corpus(spark)
    model = toxicity.train(df, df.select("doc_id", "label"), F.col("doc_id") < 300)
    rows = toxicity.score_documents(df.where("doc_id >= 300"), model).collect()
    for r in rows:
        assert (r["toxicity"]["score"] >= 0.7) == bool(r["label"])
        spans = [r["text"][a:b] for a, b in zip(r["toxicity"]["offending_start"], r["toxicity"]["offending_end"])]
        assert spans == (["You grolb now!"] if r["label"] else [])
    kept = toxicity.keep_clean(df, model)
    assert kept.columns == df.columns and kept.where("label = 1").count() == 0 and kept.count() == 300


def test_score_is_noisy_or_of_sentences():
    import numpy as np

    z = np.array([-1.0, 0.5, -3.0])
    p = 1 / (1 + np.exp(-z))
    assert abs(toxicity.noisy_or(z) - (1 - np.prod(1 - p))) < 1e-12
    assert toxicity.noisy_or(np.zeros(0)) == 0.0


def test_edge_rows(spark):
    df = corpus(spark, 120)
    model = toxicity.train(df, df.select("doc_id", "label"))
    odd = spark.createDataFrame([(None, None, 1.0), (1, "", 2.0), (1, "", 2.0), (2, "...", 3.0), (3, "You grolb now", 1.0),
                                 (4, "calm " * 60_000, 1.0)], "doc_id long, text string, score double")
    found = [r["toxicity"]["score"] for r in toxicity.score_documents(odd, model).collect()]
    assert found[:3] == [0.0, 0.0, 0.0] and found[3] == 0.0 and found[4] >= 0.7 and found[5] == 0.0
    assert toxicity.keep_clean(odd, model).columns == odd.columns
    assert toxicity.score_documents(odd.where("false"), model).count() == 0


@pytest.mark.parametrize("label", [None, 0, 1])
def test_without_both_classes(spark, label):
    df = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, label)], "doc_id long, label int")
    model = toxicity.train(df, labels)
    assert toxicity.score_documents(df, model).first()["toxicity"]["score"] == 0.0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")
def test_held_out_accuracy(spark):
    found = queries.op1_toxicity(spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "toxic")
    rows = found.where("held_out").join(labels, "doc_id").collect()
    wrong = [r for r in rows if r["predicted"] != r["toxic"]]
    false_alarms = [r for r in wrong if r["predicted"]]
    assert len(wrong) <= 0.05 * len(rows) and len(false_alarms) <= 0.02 * len(rows)


def test_repeated_rows_of_a_sampled_id_are_trained_on_once(spark, monkeypatch):
    df = corpus(spark)
    fitted = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda labels, *a: fitted.append(len(labels)) or fit(labels, *a))
    toxicity.train(df.unionByName(df.where("doc_id = 4").crossJoin(spark.range(500)).drop("id")), df.select("doc_id", "label"))
    assert fitted == [400]


def plain_score(text, model):
    """(score, sentences, spans) by reading a text word by word."""
    weight = lambda f: float(model.weights[f]) if f else 0.0
    mask, sentences = (1 << model.settings.bits) - 1, []
    begin = 0
    for line in (text or "").split("\n"):
        now = []
        for m in toxicity.TOKEN.finditer(line):
            now.append((m.group(), begin + m.start(), begin + m.end()))
            if m.group().endswith(toxicity.ENDS) or m.group().rstrip(toxicity.CLOSING).endswith(toxicity.ENDS):
                sentences.append(now)
                now = []
        sentences += [now] if now else []
        begin += len(line) + 1
    sentences = [s[i:i + model.settings.sentence_words] for s in sentences
                 for i in range(0, len(s), model.settings.sentence_words)]
    rest, starts, stops = 1.0, [], []
    for s in sentences:
        z, heavy = model.bias, False
        for raw in {w for w, _, _ in s}:
            word = raw.strip(toxicity.STRIP).lower()
            parts = [word] * bool(word) + [f"{word[:n]}-" for n in toxicity.PREFIXES if len(word) >= n]
            found = [weight(1 + zlib.crc32(p.encode()) % mask) for p in parts]
            heavy = heavy or any(found)
            z += sum(found)
        p = 1 / (1 + math.exp(-z)) if heavy else 0.0
        rest *= 1 - p
        if heavy and z >= 0:
            starts.append(s[0][1])
            stops.append(s[-1][2])
    return 1 - rest, len(sentences), starts, stops


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")
def test_score_and_spans_of_whole_texts_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    model = queries.toxicity_model(spark, docs, SF_DIR)
    assert np.count_nonzero(model.weights)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    some = max(texts.values(), key=lambda t: plain_score(t, model)[0])
    odd = [None, "", "\n\n", "…", f" {some}\r\n{some}", some.replace(". ", " "), f"({some[:400]})\x85 " * 30,
           "é " * 100 + some.upper()]
    docs = docs.unionByName(spark.createDataFrame([(-1 - i, t) for i, t in enumerate(odd)], docs.schema))
    texts.update({-1 - i: t for i, t in enumerate(odd)})
    rows = toxicity.score_documents(docs, model).select("doc_id", "toxicity.*").collect()
    assert len(rows) == len(texts) and any(r["offending_start"] for r in rows)
    for r in rows:
        score, sentences, starts, stops = plain_score(texts[r["doc_id"]], model)
        assert abs(score - r["score"]) < 1e-9 and sentences == r["sentences"]
        assert (starts, stops) == (r["offending_start"], r["offending_end"])


def test_label_sample_sorts_little_more_than_it_keeps(spark):
    from pyspark.sql import functions as F

    ids = spark.range(200_000).select(F.col("id").alias("doc_id"))
    for wanted in (2_000, 50_000, 200_000, 500_000):
        below = ids.where(F.xxhash64("doc_id") <= toxicity._threshold(200_000, wanted)).count()
        assert min(wanted, 200_000) <= below <= 1.15 * wanted + 1_500
    assert toxicity._threshold(0, 5) == 2 ** 63 - 1


def test_clean_documents_keep_columns_of_any_name(spark):
    weights = np.zeros(1 << 18, np.float32)
    model = toxicity.Model(weights, 0.0)
    names = ["__toxicity__", "__row__", "toxicity", "a.b"]
    docs = spark.createDataFrame([(1, "some text", *names), (2, None, *names)], ["doc_id", "text", *names])
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == sorted(map(tuple, docs.collect()))
