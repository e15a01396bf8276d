from __future__ import annotations

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import documents, empty, prose

from gaugeloom.llm import quality_classifier as quality
from gaugeloom.llm.queries import op2

LABELS = "doc_id long, quality int, toxic int"


def codes_of(texts, most=quality.WORDS):
    count = Counter(w for t in texts for w in t.split())
    order = sorted(count, key=lambda w: (-count[w], w))[:most]
    return quality._Codes({w: k for k, w in enumerate(order)})


def plain_places(texts, codes):
    """Text, row and surroundings of each word, one word after the other."""
    pool, forms = quality.index_vectors()
    for number, text in enumerate(texts):
        code = [codes[w] for w in text.split()]
        again = [k > 0 and code[k] == code[k - 1] for k in range(len(code))]
        index = [
            pool[c // quality.SHAPES % quality.POOL].astype(int) + forms[c % quality.SHAPES + quality.SHAPES * a]
            for c, a in zip(code, again)
        ]
        for i, c in enumerate(code):
            near = sum((index[j] for j in range(max(0, i - 2), min(len(code), i + 3)) if j != i), np.zeros(quality.DIMS, int))
            yield number, quality.WORDS if again[i] else c // (quality.POOL * quality.SHAPES), near


TEXTS = [b"a b c a a d", b"", b"e", b"a b", b" \n ", prose(1, 300).encode(), b"x x x x " * 30, prose(2, 40).encode()]


def test_shapes():
    kinds = lambda w: w.translate(quality._KIND)
    assert quality.word_shape(kinds(b"Hello,")) == b"Aa," and quality.word_shape(kinds(b"A12##")) == b"A0#"


@pytest.mark.parametrize("chunk", [4, 7, 50, 10**6])
def test_places_against_loops(monkeypatch, chunk):
    monkeypatch.setattr(quality, "CHUNK", chunk)
    monkeypatch.setattr(quality, "SLICE", 3 * chunk)
    codes = codes_of(TEXTS, 20)
    got = [(t, r, n) for part in quality._parts(iter(TEXTS), codes) for t, r, n in zip(*part)]
    want = list(plain_places(TEXTS, codes))
    assert [(t, r) for t, r, _ in got] == [(t, r) for t, r, _ in want]
    assert all((a[2] == b[2]).all() for a, b in zip(got, want))


def test_frequent_words(spark):
    docs = documents(spark)
    count = Counter(w for r in docs.select("text").collect() for w in (r[0] or "").encode().split())
    step = lambda w: int(8 * math.log2(count[w]))
    for most in (30, 200, 10**6):
        known = quality.frequent_words(docs, "text", most)
        assert 0 < len(known) <= most and sorted(known.values()) == list(range(len(known)))
        limit = min(map(step, known))
        assert set(known) == {w for w in count if step(w) >= limit}
        assert len(known) == len(count) or sum(step(w) >= limit - 1 for w in count) > most or limit > 0
    assert len(quality.frequent_words(docs, "text", 10**6)) == len(count)


def test_table_of_all_texts(spark):
    docs = documents(spark)
    texts = [(r[0] or "").encode() for r in docs.select("text").collect()]
    known = quality.frequent_words(docs, "text", 200)
    want = np.zeros((quality.WORDS, quality.DIMS), np.int64)
    for _, row, near in plain_places(texts, quality._Codes(known)):
        if row < quality.WORDS:
            want[row] += near
    assert (quality.context_table(docs, "text", known) == want).all()


def test_pooled_is_the_mean(monkeypatch):
    monkeypatch.setattr(quality, "CHUNK", 64)
    rng = np.random.default_rng(0)
    vectors, mean = rng.standard_normal((quality.WORDS, quality.DIMS)).astype(np.float32), rng.standard_normal(quality.DIMS)
    mean /= np.linalg.norm(mean)
    codes = codes_of(TEXTS, 12)
    got = quality.pooled(TEXTS, vectors, mean, codes)
    for k in range(len(TEXTS)):
        own = [(r, n) for t, r, n in plain_places(TEXTS, codes) if t == k]
        known, rare = [vectors[r] for r, _ in own if r < quality.WORDS], [n for r, n in own if r == quality.WORDS]
        want = np.zeros((2, quality.DIMS))
        if known:
            want[0] = np.mean(known, axis=0)
        if rare:
            want[1] = np.mean(rare, axis=0) - (np.mean(rare, axis=0) @ mean) * mean
        assert np.allclose(got[k], want.ravel(), atol=1e-4)


def test_memory_does_not_grow_with_a_text():
    """A text of two million words takes no more than one of two hundred thousand, beside its own bytes."""
    pool = np.random.default_rng(1).integers(0, 5000, 2_000_000)
    codes = codes_of([b" ".join(b"w%d" % k for k in range(5000))])
    vectors, mean = np.zeros((quality.WORDS, quality.DIMS), np.float32), np.zeros(quality.DIMS)
    peaks = []
    for n in (200_000, 2_000_000):
        text = b" ".join(b"w%d" % k for k in pool[:n])
        tracemalloc.start()
        quality.pooled([text], vectors, mean, codes)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.2 * peaks[0] < 150e6


def test_network_learns_and_calibrates():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((3000, 6))
    chance = 1 / (1 + np.exp(-3 * np.sin(2 * x[:, 0]) - x[:, 1]))
    y = (rng.random(3000) < chance).astype(int)
    net = quality.Network(x, y, np.arange(3000) % 5 == 0)
    p = net.probability(x)
    assert ((p > 0.5) == (chance > 0.5)).mean() > 0.85
    for low in np.arange(0, 1, 0.25):
        some = (p >= low) & (p < low + 0.25)
        assert abs(p[some].mean() - y[some].mean()) < 0.1


def scores(docs, labels, **how):
    return docs.select("doc_id", quality.quality_score(docs, labels, **how).alias("s")).collect()


def test_awkward_rows(spark):
    docs = documents(spark, repeat=2)
    labels = spark.createDataFrame([(k, int(k not in (11, 12, 13)), 0) for k in range(3, 19)] + [(4, 0, 0), (None, 1, 0), (5, None, 0), (6, 7, 0)], LABELS)
    got = scores(docs, labels)
    assert len(got) == docs.count() and all(0 <= r["s"] <= 1 for r in got)
    by = {}
    for r, t in zip(got, docs.collect()):
        by.setdefault(t["text"] or "", set()).add(r["s"])
    assert all(max(v) - min(v) < 1e-9 for v in by.values())
    assert {r["s"] for r in scores(docs, labels.limit(0))} == {0.5}
    assert scores(empty(spark), labels) == []


def test_held_out_accuracy(spark, small):
    rows = op2(spark, small).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{small}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == y for p, y in held) >= 0.9 * len(held)


def test_model_scores_other_rows(spark, small):
    """Fitted on one table, applied to another; words carry the result."""
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.QualityModel(docs, labels)
    bad = ["spam### $$$ " * 40, "A!! B!! C!! D!! E!! F!! G!! H!! " * 10]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(bad)] + [(9, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["s"] for r in rows.select("doc_id", model.score().alias("s")).collect()}
    assert len(got) == 3 and all(got[k] < quality.KEEP_FROM for k in range(2))
