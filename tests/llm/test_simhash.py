from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from llm_cases import PLAIN, documents, empty, texts, words

from gaugeloom.llm.components import connected
from gaugeloom.llm.queries import op9
from gaugeloom.llm.simhash import Tree, fingerprint_links, keep_one, link_shard, near_duplicates, simhash


def plain_simhash(text):
    own = [w.lower() for w in words(text)]
    if not own:
        return 0
    grams = [b" ".join(own[i : i + 3]) for i in range(len(own) - 2)] or [b" ".join(own)]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def groups_of(values, bits=3):
    """Brute force: label of each value, the smallest position reachable."""
    label = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= bits:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


@pytest.mark.parametrize("text", texts())
def test_fingerprint(text):
    assert simhash((text or "").encode()) == plain_simhash(text)


def dense(seed, n):
    rng = random.Random(seed)
    centers = [rng.getrandbits(64) for _ in range(n // 8)]
    out = set(centers)
    while len(out) < n:
        out.add(rng.choice(centers) ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(1, 7))) % (1 << 64))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_shard_links_span_the_groups(seed):
    values = dense(seed, 500)
    links = link_shard(np.array(values, np.uint64), np.array([], np.uint64), 3)
    assert all(bin(values[a] ^ values[b]).count("1") <= 3 for a, b in links)
    label = list(range(len(values)))
    for a, b in links:
        a, b = label[a], label[b]
        label = [min(a, b) if x in (a, b) else x for x in label]
    assert label == groups_of(values)
    assert len(links) == len(values) - len(set(label))


def test_every_close_pair_meets_in_a_shard():
    values = dense(5, 1500)
    array = np.array(values, np.uint64)
    tree = Tree(array, 8)
    assert tree.shards > 3
    home = np.zeros(len(values), int)
    for shard, at in tree.visited(array, 0):
        home[at] = shard
    seen = {s: set(at) for s, at in tree.visited(array, 3)}
    for i in range(0, len(values), 7):
        for j in range(len(values)):
            if bin(values[i] ^ values[j]).count("1") <= 3:
                assert i in seen[home[j]] and j in seen[home[i]]


def test_links_over_many_shards(spark, monkeypatch):
    import gaugeloom.llm.simhash as module

    monkeypatch.setattr(module, "SHARD_ROWS", 128)
    values = dense(9, 900)
    prints = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    links = [(int(np.int64(a).view(np.uint64)), int(np.int64(b).view(np.uint64))) for a, b in fingerprint_links(prints).collect()]
    at = {v: i for i, v in enumerate(values)}
    label = list(range(len(values)))
    for a, b in links:
        a, b = label[at[a]], label[at[b]]
        label = [min(a, b) if x in (a, b) else x for x in label]
    assert label == groups_of(values)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 100)]
    got = dict(connected(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 100}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_on_awkward_rows(spark):
    docs = documents(spark)
    rows = docs.select("doc_id", "text").collect()
    prints = [plain_simhash(r["text"]) for r in rows]
    label = groups_of(prints)
    ids = {k: min([r["doc_id"] for r, x in zip(rows, label) if x == k and r["doc_id"] is not None], default=None) for k in label}
    want = sorted(((r["doc_id"], ids[k]) for r, k in zip(rows, label)), key=str)
    got = sorted(((r["row"]["doc_id"], r["component_id"]) for r in near_duplicates(docs).collect()), key=str)
    assert got == want
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(label))
    assert near_duplicates(empty(spark)).count() == 0 and keep_one(empty(spark)).count() == 0


def test_only_null_ids_keep_a_row(spark):
    docs = spark.createDataFrame([(None, "x y z", None, None, None)] * 2, PLAIN)
    assert [r["component_id"] for r in near_duplicates(docs).collect()] == [None, None]
    assert keep_one(docs).count() == 1


def test_query_against_brute_force(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_simhash(r["text"]) for r in rows]
    label = groups_of(prints)
    low = {k: min(r["doc_id"] for r, x in zip(rows, label) if x == k) for k in set(label)}
    want = {r["doc_id"]: (f"{p:016x}", low[k]) for r, p, k in zip(rows, prints, label)}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op9(spark, small).collect()} == want
