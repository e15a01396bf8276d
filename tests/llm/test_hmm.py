from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import documents, empty, words
from pyspark.sql import functions as F

from gaugeloom.llm import hmm
from gaugeloom.llm.queries import op5


def toy(states=3, kinds=6, seed=2):
    rng = np.random.default_rng(seed)
    start, move, emit = rng.random(states), rng.random((states, states)), rng.random((kinds, states))
    return hmm.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def paths(model, seq):
    """(path, probability) of every state path."""
    for path in itertools.product(range(len(model.start)), repeat=len(seq)):
        p = model.start[path[0]] * model.emit[seq[0], path[0]]
        for a, b, w in zip(path, path[1:], seq[1:]):
            p *= model.move[a, b] * model.emit[w, b]
        yield path, p


SEQUENCES = [np.array(x) for x in ([1, 2, 3, 5], [0], [4, 4, 1], [5, 5, 5, 0, 2])]


def test_forward_is_the_sum_over_paths():
    model = toy()
    want = [math.log10(sum(p for _, p in paths(model, s))) for s in SEQUENCES]
    assert np.allclose(hmm.log10_likelihood(model, SEQUENCES), want)


def test_expected_counts_are_those_over_paths():
    model = toy()
    emitted, moves, starts = np.zeros_like(model.emit), np.zeros_like(model.move), np.zeros_like(model.start)
    for seq in SEQUENCES:
        total = sum(p for _, p in paths(model, seq))
        for path, p in paths(model, seq):
            starts[path[0]] += p / total
            for w, k in zip(seq, path):
                emitted[w, k] += p / total
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / total
    got = hmm.expected_counts(model, SEQUENCES, [True] * len(SEQUENCES))
    for a, b in zip(got, (emitted, moves, starts)):
        assert np.allclose(a, b)


def plain_base(rows, train):
    counts = Counter()
    for text, t in zip(rows, train):
        if t:
            counts.update([w.lower() for w in words(text)] + [hmm.END])
    n, v = sum(counts.values()), len(counts)
    out = []
    for text in rows:
        own = [w.lower() for w in words(text)] + [hmm.END]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        out.append((len(own), sum(counts[w] > 0 for w in own), n, base))
    return out


@pytest.mark.parametrize("table", [1 << 17, 8])
def test_scores_on_awkward_rows(spark, monkeypatch, table):
    """With a small table of frequent words most go through the join; the result stays."""
    monkeypatch.setattr(hmm, "TABLE_WORDS", table)
    docs = documents(spark).withColumn("train", F.coalesce(F.col("doc_id") % 4 != 1, F.lit(True)))
    rows = docs.select("text", "train").collect()
    want = sorted(plain_base([r[0] for r in rows], [r[1] for r in rows]))
    got = hmm.hmm_scores(docs, "train", carry=docs.columns, rounds=2)
    have = sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got.collect())
    assert np.allclose(np.array(have), np.array(want))
    assert got.select("row.*").columns == docs.columns
    again = hmm.hmm_scores(docs, "train", carry=["doc_id"], rounds=2).collect()
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in again)


def test_words_share_their_bucket(spark):
    """Over all words and the unknown slots of the buckets, one-word texts and the end add up to one."""
    docs = spark.createDataFrame([(1, "a b a"), (2, "c")], "doc_id long, text string").withColumn("train", F.lit(True))
    texts = docs.select(F.col("text").cast("binary").alias("text"))
    counts = hmm.stage(hmm.word_counts(texts), "c")
    model, weight = hmm.train(texts, counts, rounds=1)
    n = dict((bytes(w), k) for w, k in counts.collect())
    for word in (b"a", b"b", b"c"):
        bucket = zlib.crc32(word) % hmm.BUCKETS
        assert weight[bucket] == pytest.approx(math.log10(n[word] + 0.2))
    assert weight[0] == pytest.approx(math.log10(0.1)) and weight[-1] == 0
    assert np.allclose(model.emit.sum(axis=0), 1) and np.allclose(model.move.sum(axis=1), 1)


def test_no_training_rows_and_no_rows(spark):
    docs = documents(spark).withColumn("train", F.lit(False))
    rows = hmm.hmm_scores(docs, "train", carry=["doc_id"]).collect()
    assert len(rows) == docs.count() and all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in rows)
    assert hmm.hmm_scores(empty(spark).withColumn("train", F.lit(True)), "train", carry=["doc_id"]).count() == 0


def test_query(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    held = [zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in rows]
    want = {r["doc_id"]: (h, *b) for r, h, b in zip(rows, held, plain_base([r["text"] for r in rows], [not h for h in held]))}
    got = op5(spark, small).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == want[r["doc_id"]][:4]
        assert r["base_score"] == pytest.approx(want[r["doc_id"]][4], rel=1e-9)
    new = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in new) > sum(r["base_score"] for r in new)
