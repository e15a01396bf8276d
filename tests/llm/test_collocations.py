from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from checks.compare import connect, differ
from llm_cases import documents, empty, prose

from gaugeloom.llm import collocations as phrases
from gaugeloom.llm.queries import ORACLES, QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=10, covered=50, top=2000):
    """Every count in one dictionary for each language."""
    count = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]", piece) if w]
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    count[lang or "und"][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in count.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        known = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        kept = []
        for p, a in known.items():
            longer = [known[q] for q in known if len(q) > len(p) and (q[:2] == p or q[1:] == p)]
            if any(100 * x >= covered * a for x in longer):
                continue
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def of(docs, **how):
    return sorted(tuple(r) for r in phrases.collocations(docs, **how).collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string")


def test_tokens():
    assert phrases.tokens("A b,c\td\n\nÉ e.".encode()) == [b"a", b"b", b".", b"c", b"d", b".", b".", "É".encode(), b"e", b".", b"."]
    assert phrases.tokens(b"") == [b"."]


def test_against_dictionaries(spark):
    rng = random.Random(5)
    word = lambda: "w%d" % int(rng.paretovariate(0.7))
    rows = []
    for k in range(400):
        text = [word() for _ in range(rng.randrange(0, 120))]
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(text) + 1)
            text[at:at] = rng.choice(["new york city", "of the", "machine learning,", "w1 w1 w1"]).split()
        rows.append((" ".join(w + rng.choice(["", "", "", ". ", "\n", "!"]) for w in text), rng.choice(["en", "de", None])))
    want = plain(rows)
    assert len(want) > 50 and {w[0] for w in want} == {"en", "de", "und"}
    assert of(frame(spark, rows)) == want
    assert of(frame(spark, rows), least=3, covered=80, top=7) == plain(rows, 3, 80, 7)


def test_hot_prefix_is_spread_and_whole(spark):
    """One pair holds most places; its many next words lie in several buckets, and the total is theirs all."""
    rows = [(f"the hot x{k % 300} tail", "en") for k in range(6000)] + [("the hot", "en")] * 50 + [(None, "en"), ("", None)]
    docs = frame(spark, rows)
    heavy = {("en", b"the"), ("en", b"hot"), ("en", b"tail")}
    text = docs.selectExpr("coalesce(lang, 'und') AS lang", "coalesce(cast(text as binary), cast('' as binary)) AS text")
    got = phrases.prefix_stripes(text.repartition(5), heavy, 64, 10).filter("prefix = 'the hot'").collect()
    assert len(got) > 10 and all(r["far"] for r in got)
    assert sum(r["total"] for r in got) == 6050
    assert sum(len(r["next"]) for r in got) == 300 and {x["c"] for r in got for x in r["next"]} == {20}
    assert of(docs) == plain(rows)


def test_texts_longer_than_a_chunk(spark, monkeypatch):
    rows = [(prose(k, 700), "en") for k in range(6)] + [("a b c " * 500, "en"), ("end", "en")]
    monkeypatch.setattr(phrases, "CHUNK", 64)
    monkeypatch.setattr(phrases, "DISTINCT", 50)
    assert of(frame(spark, rows).repartition(3)) == plain(rows)


def test_awkward_rows(spark):
    docs = documents(spark, repeat=3)
    assert of(docs) == plain([(r["text"], r["lang"]) for r in docs.collect()])
    assert of(empty(spark)) == []
    assert of(frame(spark, [(None, None), ("", "en"), ("one two", "en")])) == []


def test_large_products_are_exact(spark):
    row = spark.sql("SELECT 90000000001L AS a, 90000000003L AS f1, 900000000007L AS f2")
    want = 1000000 * 90000000001**2 // (90000000003 * 900000000007)
    assert row.select(phrases._score("a", "f1", "f2").alias("s")).first()["s"] == want


def test_query_equals_sql(spark, small):
    got = QUERIES["op13_phrase_collocations"](spark, small)
    assert differ(got.toPandas(), connect(small).sql(ORACLES["op13_phrase_collocations"]).df()) is None
