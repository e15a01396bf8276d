from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeloom.llm import forest
from gaugeloom.llm.queries import op4

KIND = "vec_id long, embedding array<float>, asks boolean, score int, id long"


def plain_nearest(rows, k):
    good = [
        (r[0], np.array(r[1], float)) for r in rows
        if r[0] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])
    ]
    out = {}
    for r in rows:
        if r[2] and any(i == r[0] for i, _ in good):
            q = np.array(r[1], float)
            near = [(-round(float(v @ q / np.linalg.norm(v) / np.linalg.norm(q)), 12), i) for i, v in good if i != r[0] and len(v) == len(q)]
            out[r[0]] = [i for _, i in sorted(set(near))[:k]]
    return out


def awkward():
    rng = np.random.default_rng(4)
    rows = [(k, rng.standard_normal(8).astype("f4").tolist(), k % 5 == 0, 1, 2) for k in range(60)]
    same = [1.0] + [0.5] * 7
    rows += [(100 + k, same, k % 5 == 0, 1, 2) for k in range(30)]
    rows += [(200, None, True, 1, 2), (201, [0.0] * 8, True, 1, 2), (202, [1.0, None] + [0.0] * 6, True, 1, 2), (203, [float("nan")] * 8, True, 1, 2)]
    rows += [(204, [float("inf")] + [0.0] * 7, True, 1, 2), (205, [], True, 1, 2), (206, [1.0, 2.0], True, 1, 2), (None, same, True, 1, 2)]
    return rows + rows[:3] + [(300, same, None, None, None)]


@pytest.mark.parametrize("shard_rows, group_queries", [(16_384, 16_384), (20, 16_384), (20, 4)])
def test_awkward_rows(spark, monkeypatch, shard_rows, group_queries):
    monkeypatch.setattr(forest, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(forest, "GROUP_QUERIES", group_queries)
    rows = awkward()
    got = {}
    for r in forest.nearest(spark.createDataFrame(rows, KIND), "asks", k=5).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    want = {q: ids for q, ids in plain_nearest(rows, 5).items() if ids}
    assert {q: [v[k] for k in sorted(v)] for q, v in got.items()} == want
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in got.values())


def test_few_rows_and_none(spark):
    few = spark.createDataFrame([(1, [1.0, 0.0], True, 0, 0), (2, [1.0, 1.0], False, 0, 0)], KIND)
    assert [tuple(r)[:3] for r in forest.nearest(few, "asks").collect()] == [(1, 1, 2)]
    assert forest.nearest(few.limit(0), "asks").count() == 0


def test_longest_prefixes_come_first():
    """What the search gives is every row under the longest shared prefix that holds enough entries."""
    rng = np.random.default_rng(8)
    own = rng.standard_normal((400, 16))
    queries = np.concatenate([own[:5], rng.standard_normal((10, 16))])
    trees = forest.Forest(own, trees=6)
    keys, asks = trees._keys(own), trees._keys(queries)
    for wanted in (1, 40, 300, 10_000):
        for q, found in enumerate(trees.candidates(queries, wanted)):
            differ = keys ^ asks[:, q][:, None]
            same = np.array([[64 - int(x).bit_length() for x in row] for row in differ])
            depth = max([x for x in range(65) if (same >= x).sum() >= wanted], default=0)
            assert set(found) == set(np.flatnonzero((same >= depth).any(axis=0)))


def recall(rows, vectors):
    ids = [r[0] for r in vectors]
    unit = np.array([r[1] for r in vectors], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    at = {v: k for k, v in enumerate(ids)}
    got = {}
    for r in rows:
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
        assert r["score"] == pytest.approx(float(unit[at[r["query_id"]]] @ unit[at[r["vec_id"]]]), abs=1e-12)
    hit = 0
    for q, found in got.items():
        score = unit @ unit[at[q]]
        score[at[q]] = -9
        hit += len(found & {ids[k] for k in np.argsort(-score)[:5]})
    return hit / (5 * len(got))


def test_query_recall(spark, small):
    vectors = spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = op4(spark, small).collect()
    assert {r["query_id"] for r in rows} == {r[0] for r in vectors if r[0] % 50 == 0} and len(rows) == 50
    assert recall(rows, vectors) >= 0.9


@pytest.mark.parametrize("shard, n", [(16_384, 6000), (700, 4000)])
def test_recall_without_structure(spark, monkeypatch, shard, n):
    """One large shard, and several full ones with queries in several blocks."""
    monkeypatch.setattr(forest, "SHARD_ROWS", shard)
    monkeypatch.setattr(forest, "GROUP_QUERIES", 40)
    rng = np.random.default_rng(3)
    vectors = [(k, rng.standard_normal(32).tolist()) for k in range(n)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("asks", F.col("vec_id") % 50 == 0)
    rows = forest.nearest(frame, "asks").collect()
    assert len(rows) == n // 50 * 5 and recall(rows, vectors) >= 0.9


@pytest.mark.parametrize("n", [2, 5, 6, 30, 90])
def test_small_tables_give_all_that_is_asked(spark, n):
    rng = np.random.default_rng(n)
    frame = spark.createDataFrame([(k, rng.standard_normal(8).tolist()) for k in range(n)], "vec_id long, embedding array<double>")
    rows = forest.nearest(frame.withColumn("asks", F.col("vec_id") == 0), "asks").collect()
    assert len(rows) == min(5, n - 1)
