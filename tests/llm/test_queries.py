"""The registered queries on the smallest data set, and the pipeline stage by stage."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
import parity
from plumbline.llm import mixing, packing, queries, simhash

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(names) == sorted(queries.QUERIES)
    assert sorted(n.split("_")[0] for n in names if n != "pipeline") == sorted(f"op{i}" for i in range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(name, spark):
    assert parity.compare(queries.QUERIES[name](spark, SF_DIR), parity.connect(SF_DIR), queries.SQL[name]) == []


@pytest.mark.parametrize("name", ["op1_toxicity", "op3_mixing", "op5_simhash", "op6_brown", "op9_winnowing"])
def test_one_row_per_document(name, spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ids = sorted(r[0] for r in queries.QUERIES[name](spark, SF_DIR).select("doc_id").collect())
    assert ids == sorted(r[0] for r in docs.select("doc_id").collect())


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    toxic = {r[0] for r in queries.op1_toxicity(spark, SF_DIR).where("predicted = 1").select("doc_id").collect()}
    clean = dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, SF_DIR)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in docs.collect()} - toxic
    one = corpus_pipeline.drop_near_copies(spark, clean, SF_DIR)
    assert one.columns == docs.columns
    groups = {r["component_id"] for r in simhash.near_duplicates(clean).collect()}
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(groups)
    mixed = corpus_pipeline.mix_sources(spark, one, SF_DIR)
    taken = {r["doc_id"]: r["copies"] for r in mixing.mixed(one).collect() if r["copies"]}
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == taken
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    lengths = {}
    for r in pieces:
        lengths.setdefault(r["doc_id"], [0, r["doc_tokens"]])[0] += r["length"]
    assert {k: n * taken[k] for k, (_, n) in lengths.items()} == {k: got for k, (got, _) in lengths.items()}
    assert set(lengths) == set(taken)
    assert packing.WINDOW >= max(r["offset"] + r["length"] for r in pieces)


def test_pipeline_on_odd_rows(spark, tmp_path):
    """NULL and empty texts, NULL sources and ids, repeated rows and ids, a long text, and no rows at all."""
    import corpus_pipeline

    calm = [(i, f"Calm words number {i} and {i * 7} here, {i % 13} of them. " * (i % 5 + 1), "en", f"s{i % 3}", 10) for i in range(120)]
    toxic = [(200 + i, f"Calm words number {i} here. You grolb now! And {i * 3} of them.", "en", "s0", 10) for i in range(60)]
    odd = [(300, None, None, None, None), (301, "", "en", None, 0), (None, None, "en", "s1", 1), (None, "no id at all", "en", "s1", 1),
           (302, "long words " * 30_000, "en", "s2", 5), (303, "one id", "en", "s2", 5), (303, "with two other texts", "en", "s2", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = calm + toxic + odd + calm[:5] * 3
    labels = [(r[0], 0) for r in calm] + [(r[0], 1) for r in toxic]
    for name, given in (("some", rows), ("none", [])):
        folder = tmp_path / name
        spark.createDataFrame(given, schema).repartition(3).write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(folder / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []
    docs, counts = spark.read.parquet(str(tmp_path / "some" / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        before, path = docs, str(tmp_path / name)
        stage(spark, docs, str(tmp_path / "some")).write.parquet(path)
        docs = spark.read.parquet(path)
        assert name == "packing" or docs.columns == before.columns
        counts.append([tuple(r) for r in docs.collect()])
    clean, single, mixed, pieces = counts
    key = lambda r: tuple(map(str, r))
    assert sorted(clean, key=key) == sorted((r for r in rows if not (r[1] or "").count("grolb")), key=key)
    groups = simhash.with_components(simhash.near_duplicates(spark.createDataFrame(clean, schema)).select("doc_id", "fp"))
    assert len(single) == groups.select("root").distinct().count() and set(single) <= set(clean)
    assert set(mixed) <= set(single) and max(mixed.count(r) for r in mixed) <= 2
    whole = [p for p in pieces if p[1] == 0]  # the first piece of every document taken
    assert len(whole) == len(mixed) and sum(p[2] for p in pieces) == sum(p[4] for p in whole)
    assert sorted(str(p[0]) for p in whole) == sorted(str(r[0]) for r in mixed)


def test_without_the_subpackage(tmp_path):
    """The rest imports and registers its queries when the folders and the pipeline are gone."""
    import shutil

    for name in ("plumbline", "oracle"):
        shutil.copytree(os.path.join(ROOT, name), tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 200 and set(e.oracle_sql()) == set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120,
                   env={**os.environ, "PYTHONPATH": str(tmp_path)})
