from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_cases import documents, empty, words

from gaugeloom.llm import period_runs as runs
from gaugeloom.llm.queries import op11


def plain_runs(text: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, one period after the other."""
    out, n = [], len(text)
    for q in range(1, n // 3 + 1):
        at = 0
        while at + q < n:
            start = at
            while at + q < n and text[at] == text[at + q]:
                at += 1
            end = at + q
            if end - start >= max(24, 3 * q):
                smaller = (p for p in range(1, q) if q % p == 0)
                if not any(text[start : end - p] == text[start + p : end] for p in smaller):
                    out.append((start, end - start, q))
            at += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(text: list, found: list) -> list:
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    return [w for i, w in enumerate(text) if i not in gone]


def mixed(rng: random.Random) -> list[str]:
    """Pieces without order, with short and long periods, and repeats of what came before."""
    out: list[str] = []
    for _ in range(rng.randrange(1, 6)):
        kind = rng.randrange(4)
        if kind == 0:
            out += [rng.choice("abcdefghij") for _ in range(rng.randrange(60))]
        elif kind == 1:
            unit = [rng.choice("ab") for _ in range(rng.randrange(1, 9))]
            out += (unit * 90)[: rng.randrange(3, 90)]
        elif kind == 2:
            unit = [rng.choice("abcdefghijklmnopqrstuvwx") for _ in range(rng.randrange(5, 40))]
            out += (unit * 6)[: rng.randrange(len(unit), 5 * len(unit))]
        elif out:
            out += out[: rng.randrange(len(out))]
    return out


def in_chunk(texts: list[list[str]]) -> list[list[tuple[int, int, int]]]:
    ((_, held, found),) = runs._texts([" ".join(t).encode() for t in texts], runs._Ids())
    assert [len(h) for h in held] == [len(t) for t in texts]
    return [[tuple(r[1:]) for r in found.tolist() if r[0] == k] for k in range(len(texts))]


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_every_period(seed):
    rng = random.Random(seed)
    for _ in range(150):
        texts = [mixed(rng) for _ in range(rng.randrange(1, 5))]
        assert in_chunk(texts) == [plain_runs(t) for t in texts]


def test_words_of_two_letters_in_fibonacci_and_thue_morse_order():
    a, b = "a", "ab"
    while len(b) < 900:
        a, b = b, b + a
    thue = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    for text in (list(b), list(thue), list((thue[:100]) * 5), list(b[:55] * 7)):
        assert in_chunk([text]) == [plain_runs(text)]


def test_grammar_gives_back_the_text():
    """Each symbol derives the same words at all its places, and its halves are symbols or words."""
    rng = random.Random(8)
    words_ = np.array([rng.randrange(6) for _ in range(3000)] * 2)
    grammar = runs.re_pair(words_)
    assert len(grammar.start) < 2500
    for low, middle, high, places in zip(grammar.low, grammar.middle, grammar.high, grammar.places):
        assert low < middle < high
        for place in places:
            assert (words_[place : place + high - low] == words_[low:high]).all()
    pairs = set()
    last = np.r_[grammar.start[1:], len(words_)]
    for i in range(len(grammar.start) - 1):
        pairs.add((tuple(words_[grammar.start[i] : last[i]]), tuple(words_[grammar.start[i + 1] : last[i + 1]])))
    assert len(pairs) >= 0.95 * (len(grammar.start) - 1)  # pairs left hardly come again


def test_one_period_of_a_million_words_and_many_texts():
    for unit in (1, 1000):
        ((_, _, found),) = runs._texts([b" ".join(b"%d" % (i % unit) for i in range(1_000_000))], runs._Ids())
        assert found.tolist() == [[0, 0, 1_000_000, unit]]
    texts = [b"x " * k for k in range(2000)]
    found = [(first + r[0], *r[1:]) for first, _, rows in runs._texts(texts, runs._Ids()) for r in rows.tolist()]
    assert found == [(k, 0, k, 1) for k in range(24, 2000)]


def test_awkward_rows(spark):
    docs = documents(spark)
    got = runs.period_runs(docs, docs.columns)
    assert got.select("row.*").columns == docs.columns
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        text = words(r["row"]["text"])
        found = plain_runs(text)
        assert r["n_words"] == len(text) and [tuple(x) for x in r["runs"]] == found
        assert r["collapsed"].encode() == b" ".join(plain_collapse(text, found))
    assert runs.period_runs(empty(spark), ["doc_id"]).count() == 0


def test_query_against_every_period(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in op11(spark, small).collect()}
    assert len(got) == len(rows)
    planted = 0
    for doc in rows:
        text, h = words(doc["text"]), zlib.crc32(str(doc["doc_id"]).encode())
        g, n = h // 10, len(text)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = text[:a] + [text[a + (i - a) % p] for i in range(a, n)]
        if n > 3000:
            continue
        found = plain_runs(text)
        planted += bool(found) and h % 10 == 0
        r = got[doc["doc_id"]]
        assert r["n_runs"] == len(found)
        assert r["runs_sha256"] == hashlib.sha256("".join("%d,%d,%d\n" % x for x in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(plain_collapse(text, found))).hexdigest()
        if not found:
            assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (None,) * 4
            continue
        top = found[0]
        for x in found:
            top = x if x[1] * top[2] > top[1] * x[2] else top
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (*top, 1000 * top[1] // top[2])
    assert planted >= 5
