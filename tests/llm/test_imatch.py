from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from checks.compare import connect, differ
from llm_cases import documents, empty, prose, texts
from pyspark.sql import functions as F

from gaugeloom.llm import imatch
from gaugeloom.llm.queries import ORACLES, QUERIES

LOWER = str.maketrans(imatch.UPPER, imatch.LOWER)


def plain_terms(text):
    return {t for t in re.split(r"[\x00-/:-`{-\x7f]+", (text or "").translate(LOWER)) if t}


def plain_prints(bodies, corpus):
    """(level, signatures by level and subset) of each text, from sets."""
    df = Counter(t for c in corpus for t in plain_terms(c))
    known = {t for t, n in df.items() if 2 <= n <= max(2, 0.05 * len(corpus))}
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    out = []
    for body in bodies:
        own = plain_terms(body)
        level = (len(own) // 16).bit_length() - 1 if len(own) >= 32 else 0
        own = {t: int(md5(t)[:8], 16) for t in own}
        own = {t: h for t, h in own.items() if h < 1 << (32 - level)}
        own = {t: h for t, h in own.items() if t in known} or own
        signs = []
        for up in range(4):
            for k in range(16):
                some = sorted(t for t, h in own.items() if h >> (28 - level - up) == k)
                signs.append(md5(" ".join(some))[:4] if some else "-")
        out.append(" ".join([f"{level:02d}", *signs]))
    return out


def plain_likeness(a, b):
    if a == b:
        return 1.0
    shift = int(b[:2]) - int(a[:2])
    sign = lambda x, k: x.split(" ")[1 + k]
    pairs = [(sign(a, k), sign(b, k - 16 * shift)) for k in range(64) if 0 <= k - 16 * shift < 64]
    some = [p for p in pairs if p != ("-", "-")]
    return sum(x == y for x, y in some) / len(some) if some else 0.0


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    out = [prose(k, rng.randrange(1, 900)) for k in range(120)] + texts()
    return out + [out[5] + " and more", out[7], out[7], "Ünïque wörds 北京 only"]


def frame(spark, corpus):
    return spark.createDataFrame([(k, t) for k, t in enumerate(corpus)], "doc_id long, text string")


def test_fingerprints_against_sets(spark, corpus):
    docs = frame(spark, corpus).withColumn("other", F.reverse("text"))
    got = {r["row"]["doc_id"]: r for r in imatch.fingerprints(docs, ["text", "other"], ["doc_id"]).collect()}
    assert [got[k]["fp0"] for k in range(len(corpus))] == plain_prints(corpus, corpus)
    assert [got[k]["fp1"] for k in range(len(corpus))] == plain_prints([t and t[::-1] for t in corpus], corpus)
    assert len({x["fp0"][:2] for x in got.values()}) > 4


def test_likeness(spark, corpus):
    prints = plain_prints(corpus, corpus)
    pairs = [(a, b) for a in prints[::3] for b in prints[::4]]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", imatch.likeness("a", "b").alias("s")).collect()
    assert all(r["s"] == pytest.approx(plain_likeness(r["a"], r["b"]), abs=1e-12) for r in rows)


def test_edits_stay_near_and_others_far(spark, corpus):
    """A quarter of a text replaced by another's words leaves a good part of the signatures."""
    rng = random.Random(9)
    words = [f"{a}{b}{c}" for a in "bdfglmnprst" for b in "aeiou" for c in ("n", "ra", "lis", "mot", "ke", "sto")]
    one = [" ".join(rng.choice(words) + rng.choice(words) for _ in range(rng.randrange(60, 2000))) for _ in range(300)]
    docs = [t[: len(t) - len(t) // 4] + one[(k + 1) % 300][: len(t) // 4] for k, t in enumerate(one)]
    prints = plain_prints(one + docs, one + docs)
    near = [plain_likeness(prints[k], prints[300 + k]) for k in range(300)]
    far = [plain_likeness(prints[k], prints[(k + 1) % 300]) for k in range(300)]
    assert sum(n > f for n, f in zip(near, far)) >= 295 and sorted(near)[150] > 0.3 and sorted(far)[285] < 0.1


@pytest.mark.parametrize("keys", [[], [5], [None], list(range(40)), [3, 3, 3, None, None, -7, 10**12, 5000, 1024, 1023, 2048, 99 * 1024**2]])
def test_next_row(spark, keys):
    rows = [(k, f"text {n % 4}" if n % 5 else None) for n, k in enumerate(keys)]
    docs = spark.createDataFrame(rows, "id long, body string").repartition(3)
    got = imatch.with_next(docs, "id", "body").collect()
    plain = [(k, t or "") for k, t in rows]
    order = sorted(plain, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = Counter((*a, *b) for a, b in zip(order, order[1:] + order[:1]))
    assert Counter((r["key"], r["text"], r["next_key"], r["next_text"]) for r in got) == want


def test_awkward_rows(spark):
    docs = documents(spark)
    got = imatch.fingerprints(docs, ["text"], docs.columns)
    assert got.select("row.*").columns == docs.columns
    rows = got.collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["row"]["text"] or "", set()).add(r["fp0"])
    assert all(len(v) == 1 for v in by.values())
    assert by[""] == by[" \t\n "] == {"00" + " -" * 64}
    assert imatch.fingerprints(empty(spark), ["text"], ["doc_id"]).count() == 0


def test_query_equals_sql_without_python(spark, small):
    got = QUERIES["op12_imatch_fingerprints"](spark, small)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan
    assert differ(got.toPandas(), connect(small).sql(ORACLES["op12_imatch_fingerprints"]).df()) is None
