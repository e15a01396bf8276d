from __future__ import annotations

import zlib

import numpy as np
import pytest
from llm_cases import PLAIN, documents, empty, prose
from pyspark.sql import functions as F

from gaugeloom.llm.kd_shards import TIE_BITS, grow, kd_shards, write_shards
from gaugeloom.llm.queries import op6


def check(rows, shards, near):
    sizes = np.zeros(shards)
    slots = {}
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sizes.max() - sizes.min() <= near
    return sizes


def test_awkward_rows(spark):
    docs = documents(spark)
    got = kd_shards(docs, carry=docs.columns, shards=3)
    rows = got.collect()
    assert len(rows) == docs.count() and got.select("row.*").columns == docs.columns
    for r in rows:
        text = (r["row"]["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 1, zlib.crc32(text))
    assert {r["shard"] for r in rows} <= {0, 1, 2}
    assert kd_shards(empty(spark), carry=["doc_id"], shards=4).count() == 0
    assert {r["shard"] for r in kd_shards(docs.limit(1), carry=["doc_id"], shards=4).collect()} <= {0, 1, 2, 3}


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_sizes_are_near_equal_with_a_hot_source_and_copies(spark, shards):
    rows = [(k, prose(k, 30 + k % 50), "en", f"s{k % 7}", 0) for k in range(600)]
    rows += [(7, prose(1, 60), "en", "hot", 0)] * 400  # one row, many times
    got = kd_shards(spark.createDataFrame(rows, PLAIN), carry=["doc_id"], shards=shards).collect()
    assert len(got) == 1000
    check(got, shards, 2.5 * max(r["size"] for r in got))


def test_target_bytes_and_files(spark, tmp_path):
    docs = spark.createDataFrame([(k, prose(k, 40), "en", "s", 0) for k in range(200)], PLAIN)
    total = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0]
    placed = kd_shards(docs, carry=docs.columns, target_bytes=total // 4 + 1)
    assert placed.select("shard").distinct().count() == 4
    write_shards(placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 200 and set(back.columns) == {*docs.columns, "shard", "slot"}


def test_query(spark, small):
    rows = op6(spark, small).collect()
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}
    sizes = check(rows, 16, 2.5 * max(r["size"] for r in rows))
    assert len(sizes) == 16 and len(rows) == spark.read.parquet(f"{small}/documents.parquet").count()


def plain_tree(keys, size, shards):
    """Rows of each shard in the tree's order, by sorting every node along its widest dimension."""
    whole = [max(1, int(np.ptp(keys[:, i]))) for i in range(keys.shape[1])]

    def split(rows, n):
        if n == 1 or not len(rows):
            return [rows] + [rows[:0]] * (n - 1)
        own = keys[rows]
        wide = [int(np.ptp(own[:, i])) / whole[i] for i in range(keys.shape[1])]
        dim = wide.index(max(wide))
        order = rows[np.argsort(own[:, dim], kind="stable")]
        upto = np.cumsum(size[order])
        target = int(upto[-1]) * (n // 2) / n
        k = min(int(np.searchsorted(upto, target)), len(order) - 1)
        cut = k if abs(upto[k] - size[order[k]] - target) < abs(upto[k] - target) else k + 1
        return split(order[:cut], n // 2) + split(order[cut:], n - n // 2)

    return split(np.arange(len(keys)), shards)


@pytest.mark.parametrize("shards, seed", [(2, 1), (7, 2), (16, 3)])
def test_tree_against_plain_recursion(spark, shards, seed):
    """Widest dimensions and weighted medians, with hot values, a constant dimension and ties."""
    rng = np.random.default_rng(seed)
    n = 900
    values = np.stack([rng.choice([5, 900, 70_000], n, p=[0.6, 0.3, 0.1]), rng.integers(0, 1 << 32, n), np.full(n, 3)], 1)
    tie, size = rng.permutation(1 << 16)[:n], rng.integers(1, 60, n)
    size[:3] = 2_000
    rows = [(*map(int, v), int(t), int(w)) for v, t, w in zip(values, tie, size)]
    frame = spark.createDataFrame(rows, "a long, b long, c long, tie long, size long").repartition(5)
    tree = grow(frame, ["a", "b", "c"], shards)
    keys = values << TIE_BITS | tie[:, None]
    leaf, leaves, todo = tree.place(keys), [], [0]
    while todo:
        node = todo.pop()
        if tree.dim[node] < 0:
            leaves.append(node)
        else:
            todo += [tree.right[node], tree.left[node]]
    assert len(leaves) == shards
    for node, want in zip(leaves, plain_tree(keys, size, shards)):
        assert set(np.flatnonzero(leaf == node)) == set(want)
