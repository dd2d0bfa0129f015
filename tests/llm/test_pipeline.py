from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from conftest import DATA
from test_llm import CLASH, ODD, near_brute, targets_brute

import corpus_pipeline
from loregraph.llm import exact_dedup, mixing, near_dedup, toxicity


def test_stages(spark, tmp_path):
    """Each stage against its operator's own result on the stage's input."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "sentencepiece"]
    kept = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept[name] = (before, docs)
        if name != "sentencepiece":
            assert docs.columns == columns
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    a, b = kept["toxicity"]
    assert ids(b) == ids(toxicity.toxicity(a, labels).where("predicted = 0"))
    a, b = kept["exact_dedup"]
    assert ids(b) == ids(exact_dedup.exact_dedup(a).where("kept"))
    a, b = kept["near_dedup"]
    assert ids(b) == ids(near_dedup.near_duplicates(a, 5, 80).where("kept"))
    a, b = kept["mixing"]
    assert b.count() == mixing.mix(a).agg({"copies": "sum"}).first()[0]
    a, b = kept["sentencepiece"]
    assert ids(a) == ids(b)
    assert b.where("not round_trip").count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0


def test_stages_by_brute_force(spark, tmp_path):
    """What the stages after the classifier keep, against plain programs over each stage's own input."""
    docs, kept = spark.read.parquet(f"{DATA}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = docs.collect()
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = (before, docs.collect())
    before, after = kept["exact_dedup"]
    first = {}
    for r in before:
        t = re.sub(r"[\x20\x09-\x0D]+", " ", r["text"])
        first[t] = min(first.get(t, r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(first.values())
    before, after = kept["near_dedup"]
    groups = near_brute([(r["doc_id"], r["text"]) for r in before], 5, 80)
    assert sorted(r["doc_id"] for r in after) == [i for i, (_, c) in groups.items() if i == c]
    before, after = kept["mixing"]
    whole = {r["doc_id"]: r for r in before}
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for i, r in whole.items()}
    of, taken = defaultdict(int), defaultdict(int)
    for i, r in whole.items():
        of[r["source"]] += size[i]
    copies = Counter(r["doc_id"] for r in after)
    assert all(whole[r["doc_id"]] == r for r in after)
    assert all(n <= 3 for i, n in copies.items() if size[i])
    for i, n in copies.items():
        taken[whole[i]["source"]] += n * size[i]
    for source, goal in targets_brute(dict(of)).items():
        largest = max(size[i] for i, r in whole.items() if r["source"] == source)
        assert abs(taken[source] - goal) <= max(0.02 * goal, largest / 2), source


@pytest.mark.parametrize("data", [ODD, []], ids=["odd", "empty"])
def test_stages_on_odd_tables(spark, tmp_path, data):
    """Nulls, empty and long texts, repeated rows and ids, no rows, columns of any name."""
    docs = spark.createDataFrame([(i, t, s, "en", 0) for i, t, s in data], "doc_id long, text string, source string, lang string, n_chars long")
    for c in CLASH:
        if c not in docs.columns:
            docs = docs.selectExpr("*", f"1 as `{c}`")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "sentencepiece":
            assert docs.columns == columns, name
        if name == "exact_dedup":
            assert docs.count() == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, _ in data})
    assert "round_trip" in docs.columns
