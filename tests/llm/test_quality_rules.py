from __future__ import annotations

import re

import numpy as np
import pytest
from llm_cases import PLAIN, documents, empty, prose, texts

from gaugeloom.llm import quality_rules as rules
from gaugeloom.llm.queries import op10

FIVE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def plain_counts(text):
    text = text or ""
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    inside = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            inside |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


@pytest.mark.parametrize("text", [t for t in texts() if len(t or "") < 5000])
def test_counts(text):
    assert rules.text_counts((text or "").encode(), rules._Ids())[:5] == plain_counts(text)


def test_repeats_with_very_many_words(monkeypatch):
    ids = rules._Ids((str(k).encode(), k) for k in range(1 << 21))
    monkeypatch.setattr(rules, "REMEMBERED", 1 << 40)
    own = b"p q r s p q r t u v".split()
    assert rules.repeated_words(own, ids) == 6


def test_chi_square():
    assert rules._chi2_cdf(7.8147, 3) == pytest.approx(0.95, abs=1e-5)
    assert rules.chi2_quantile(0.95, 3) == pytest.approx(7.8147, abs=1e-3)


def plain_mcd(x, steps):
    """Concentration steps in numpy; the quartiles and cuts are the nearest ranks."""
    d, n = x.shape[1], len(x)
    rank = lambda v, p: np.sort(v)[max(0, int(np.ceil(p * n)) - 1)]
    quart = np.array([[rank(x[:, j], p) for p in (0.25, 0.5, 0.75)] for j in range(d)])
    center, floors = quart[:, 1], np.array(rules.FLOORS)
    inverse = np.diag(1 / np.maximum((quart[:, 2] - quart[:, 0]) / 1.349, floors) ** 2)
    factor = rules.SHARE / rules._chi2_cdf(rules.chi2_quantile(rules.SHARE, d), d + 2)
    for _ in range(steps):
        far = np.einsum("ni,ij,nj->n", x - center, inverse, x - center)
        some = x[far <= rank(far, rules.SHARE)]
        center = some.mean(axis=0)
        inverse = np.linalg.inv(factor * np.cov(some.T, bias=True) + np.diag(floors**2))
    return center, inverse


def test_estimates_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, len(rules.FEATURES))) @ rng.standard_normal((len(rules.FEATURES),) * 2)
    x[:60] += 25  # outliers that pull a plain mean and covariance
    rows = [("a", k % rules.SALTS, *map(float, r)) for k, r in enumerate(x)]
    stats = spark.createDataFrame(rows, "key string, salt int, " + ", ".join(f"{f} double" for f in rules.FEATURES))
    got = rules.robust_estimates(stats).first()["p"]
    center, inverse = plain_mcd(x, rules.STEPS)
    assert np.allclose(got["center"], center) and np.allclose(np.reshape(got["inverse"], inverse.shape), inverse)
    far = np.einsum("ni,ij,nj->n", x - center, inverse, x - center)
    assert far[:60].min() > far[60:].max()


def test_awkward_rows_and_fallback(spark):
    docs = documents(spark)
    got = rules.quality_rules(docs, carry=docs.columns)
    rows = got.collect()
    assert len(rows) == docs.count() and got.select("row.*").columns == docs.columns
    for r in rows:
        want = plain_counts(r["row"]["text"]) if len(r["row"]["text"] or "") < 5000 else None
        if want:
            assert tuple(r[c] for c in FIVE) == want
            assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        limit = rules.chi2_quantile(1 - rules.TAIL, len(rules.FEATURES))
        assert r["kept"] == (not r["base_failed"] and r["distance2"] <= limit)
    assert rules.quality_rules(empty(spark), carry=["doc_id"]).count() == 0


def test_small_sources_share_and_outliers_go(spark):
    rows = [(k, prose(k, 90), "en", f"s{k % 40}", 0) for k in range(280)]
    rows += [(1000 + k, " ".join(w + "#$%&*" for w in prose(k, 90).split()), "en", "s1", 0) for k in range(12)]
    got = rules.quality_rules(spark.createDataFrame(rows, PLAIN), carry=["doc_id"]).collect()
    kept = {r["row"]["doc_id"]: r["kept"] for r in got}
    assert not any(kept[1000 + k] for k in range(12))
    assert sum(kept[k] for k in range(280)) >= 278


def test_small_tables_are_judged_too(spark):
    """Fewer rows than any group needs: all good rows make the estimate, and rare languages meet it as well."""
    rows = [(k, prose(k, 90), "en" if k % 3 else f"l{k}", f"s{k % 9}", 0) for k in range(60)]
    rows += [(1000 + k, " ".join(w + "#$%&*" for w in prose(k, 90).split()), f"r{k}", None, 0) for k in range(3)]
    got = rules.quality_rules(spark.createDataFrame(rows, PLAIN), carry=["doc_id"]).collect()
    assert all(r["distance2"] is not None for r in got)
    kept = {r["row"]["doc_id"]: r["kept"] for r in got}
    assert [kept[1000 + k] for k in range(3)] == [False] * 3 and all(kept[k] for k in range(60))


def test_query(spark, small):
    text = dict(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    rows = op10(spark, small).collect()
    assert len(rows) == len(text)
    for r in rows:
        if len(text[r["doc_id"]]) < 5000:
            assert tuple(r[c] for c in FIVE) == plain_counts(text[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"]) and (r["base_failed"] or r["distance2"] is not None)
