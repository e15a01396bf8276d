from __future__ import annotations

import random

import corpus_pipeline
import pytest
from llm_cases import documents, empty

from gaugeloom.session import stage


@pytest.fixture(scope="module")
def steps(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = [docs]
    for _, apply in corpus_pipeline.STAGES:
        out.append(stage(apply(spark, out[-1], small), "step"))
    return out


def test_stages_keep_the_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "quality classifier", "simhash near-dedup", "mixing", "packing",
    ]
    assert all(step.columns == steps[0].columns for step in steps[:-1])


def test_each_stage_takes_effect_and_keeps_good_documents(steps, spark, small):
    count = [s.count() for s in steps]
    good = spark.read.parquet(f"{small}/labels.parquet").filter("quality = 1").select("doc_id")
    clean = [s.join(good, "doc_id", "left_semi").count() for s in steps[:3]]
    assert count[0] > count[1] >= count[2] > count[3] and clean[2] >= 0.85 * clean[0]
    assert steps[3].select("doc_id").distinct().count() == count[3]
    ids = [{r[0] for r in s.select("doc_id").collect()} for s in steps]
    assert all(b <= a for a, b in zip(ids, ids[1:]))
    assert steps[5].select("doc_id").distinct().count() == len(ids[4])


def test_classifier_catches_what_the_rules_pass(spark, small):
    """Texts of odd words in ordinary proportions pass the rules; only the classifier knows them by their words."""
    rng = random.Random(4)
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    bad = [r["text"] for r in docs.join(labels.filter("quality = 0"), "doc_id").collect() if len(r["text"].split()) >= 10]
    words = [w for t in bad for w in t.split() if not w.isalpha()]
    assert len(words) > 100
    planted = [(10_000 + k, " ".join(rng.choice(words) for _ in range(200)), "en", "src0", 0) for k in range(20)]
    rows = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    kept = corpus_pipeline.classifier(spark, rows, small).select("doc_id").collect()
    left = {r[0] for r in kept}
    good = {r[0] for r in labels.filter("quality = 1").select("doc_id").collect()}
    assert sum(10_000 + k in left for k in range(20)) <= 2
    assert len(good & left) >= 0.95 * len(good)


def test_pieces_of_copies_are_told_apart(steps):
    pieces = steps[5].select("doc_id", "copy_id", "start").collect()
    assert len(set(pieces)) == len(pieces)
    copies = {(r["doc_id"], r["copy_id"]) for r in pieces}
    assert len(copies) == steps[4].count() > len({c[0] for c in copies})


def test_run_equals_the_stages(steps, spark, small):
    light = lambda df: sorted(map(tuple, df.drop("ids").collect()))
    assert light(corpus_pipeline.run(spark, small)) == light(steps[-1])


def test_awkward_and_empty_documents(spark, small):
    """NULLs everywhere, repeated rows, and extra columns whose names the operators use themselves."""
    for docs in (documents(spark, repeat=2), empty(spark)):
        columns, n = docs.columns, docs.count()
        for name, apply in corpus_pipeline.STAGES[:-1]:
            docs = stage(apply(spark, docs, small), "step")
            assert docs.columns == columns and (docs.count() > 0) == (n > 0)
        pieces = corpus_pipeline.packing(spark, docs, small)
        assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
