"""SimHash near-duplicates: fingerprints in vantage-point shards, exact links, components.

Copies share a fingerprint, so the search runs over distinct fingerprints. A vantage-point tree fitted
on a bounded sample deals them into shards: inside or outside the median Hamming distance from each
vantage point. By the triangle inequality two fingerprints within `max_bits` can only be parted by a
boundary that both are near, so each fingerprint also visits the later shards its ball reaches. A task
searches one shard with a vantage-point tree of its own and keeps only links that join two groups: a
dense group costs members minus one links, never all pairs, and blocks whose members already belong
together are not compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.common import row_of, utf8
from gaugeloom.llm.components import connected
from gaugeloom.session import stage

SHARD_ROWS = 32_768
SAMPLE_PER_SHARD = 64
#: Fingerprints that the upper tree is fitted on at most; all of them are dealt out by it.
SAMPLE_MOST = 1 << 20
LEAF_ROWS = 48
BLOCK_CELLS = 1 << 21
PIECE = 1 << 16


def simhash(text: bytes, shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one text.

    A bit is set if over half of the XXH64 values (seed 42) of the word shingles have it set.
    Fewer words than a shingle: the whole sequence; no word: zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    n = len(words) - shingle + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, n, PIECE):
        part = words[at : at + PIECE + shingle - 1]
        grams = map(b" ".join, zip(*(part[k:] for k in range(shingle))))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprint(text: str, shingle: int = 3) -> Column:
    """The fingerprint of a text column as a signed long."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            got = np.fromiter((simhash(x, shingle) for x in texts), np.uint64, len(texts))
            yield pd.Series(got.view(np.int64))

    return of(utf8(text))


def _distance(values: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(values ^ point).astype(np.int16)


def _vantage(values: np.ndarray, rng: np.random.Generator) -> np.uint64:
    """Of a few members the one whose distances to some others vary most."""
    some = values if len(values) <= 256 else values[rng.integers(0, len(values), 256)]
    tried = values[rng.integers(0, len(values), 4)]
    return tried[int(np.argmax([_distance(some, p).var() for p in tried]))]


class Tree:
    """The upper tree: inner nodes (point, radius, inside, outside), leaves are shard numbers."""

    def __init__(self, sample: np.ndarray, shards: int) -> None:
        self.shards = 0
        self.root = self._grow(sample, shards, np.random.default_rng(9))

    def _leaf(self) -> int:
        self.shards += 1
        return self.shards - 1

    def _grow(self, values: np.ndarray, shards: int, rng: np.random.Generator):
        if shards <= 1 or len(values) < 2:
            return self._leaf()
        point = _vantage(values, rng)
        far = _distance(values, point)
        radius = int(np.sort(far)[(len(far) - 1) // 2])
        if (far <= radius).all():
            radius -= 1
        if not (inside := far <= radius).any():
            return self._leaf()
        return (
            point, radius,
            self._grow(values[inside], shards // 2, rng),
            self._grow(values[~inside], shards - shards // 2, rng),
        )

    def visited(self, values: np.ndarray, reach: int) -> list[tuple[int, np.ndarray]]:
        """(shard, positions in `values`) of the shards that a ball of radius `reach` meets."""
        out, todo = [], [(self.root, np.arange(len(values)))]
        while todo:
            node, at = todo.pop()
            if not isinstance(node, tuple):
                out.append((node, at))
                continue
            point, radius, inside, outside = node
            far = _distance(values[at], point)
            todo.append((inside, at[far <= radius + reach]))
            todo.append((outside, at[far > radius - reach]))
        return out


class Groups:
    """Labels of nodes that links have joined, and the links that joined two labels."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)
        self.members: dict[int, list[int]] = {}
        self.links: list[tuple[int, int]] = []

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        a, b = self.label[left], self.label[right]
        new = np.flatnonzero(a != b)
        if not len(new):
            return
        _, first = np.unique(a[new] * len(self.label) + b[new], return_index=True)
        for k in new[first]:
            x, y = int(self.label[left[k]]), int(self.label[right[k]])
            if x == y:
                continue
            own = self.members.pop(x, [x])
            other = self.members.pop(y, [y])
            if len(own) < len(other):
                x, own, other = y, other, own
            self.label[other] = x
            self.members[x] = own + other
            self.links.append((int(left[k]), int(right[k])))


def link_shard(home: np.ndarray, visitors: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Positions in home + visitors of links that span every group of linked fingerprints.

    Every pair of a home member with a home member or visitor within `max_bits` is joined, by a link
    or by a chain of them. The search walks a vantage-point tree over the home members.
    """
    values = np.concatenate([home, visitors])
    groups, rng = Groups(len(values)), np.random.default_rng(5)
    todo = [(np.arange(len(values)), np.arange(len(home)))]
    while todo:
        asks, own = todo.pop()
        if not len(asks) or not len(own):
            continue
        label = groups.label[own[0]]
        if (groups.label[own] == label).all() and (groups.label[asks] == label).all():
            continue
        split = None
        if len(own) > LEAF_ROWS:
            point = _vantage(values[own], rng)
            far, ask = _distance(values[own], point), _distance(values[asks], point)
            near_own, near_ask = own[far <= max_bits // 2], asks[ask <= max_bits - max_bits // 2]
            if len(near_own) and len(near_ask):  # near the same point, so near each other
                first = np.full(len(near_ask), near_own[0])
                groups.join(near_ask, first)
                groups.join(near_own, np.full(len(near_own), near_ask[0]))
            radius = int(np.sort(far)[(len(far) - 1) // 2])
            if (far <= radius).all():
                radius -= 1
            if (far <= radius).any():
                split = far <= radius
        if split is not None:
            todo.append((asks[ask > radius - max_bits], own[~split]))
            todo.append((asks[ask <= radius + max_bits], own[split]))
            continue
        step = max(1, BLOCK_CELLS // len(own))
        for at in range(0, len(asks), step):
            some = asks[at : at + step]
            close = np.bitwise_count(values[some][:, None] ^ values[own][None, :]) <= max_bits
            i, j = np.nonzero(close)
            groups.join(some[i], own[j])
    return groups.links


def fingerprint_links(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (a, b) that span every group of the distinct signed fingerprints in column `fp`.

    Two fingerprints are joined by a chain of links exactly if a chain of pairs at `max_bits` or
    fewer differing bits joins them. An empty table gives no links.
    """
    shards = -(-prints.count() // SHARD_ROWS)
    size = min(SAMPLE_PER_SHARD * max(1, shards), SAMPLE_MOST)
    sample = prints.orderBy(F.xxhash64("fp"), "fp").limit(size).toPandas()["fp"]
    tree = Tree(sample.to_numpy(np.int64).view(np.uint64), shards)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["fp"].to_numpy(np.int64).view(np.uint64)
            home = np.zeros(len(values), np.int64)
            for shard, at in tree.visited(values, 0):
                home[at] = shard
            for shard, at in tree.visited(values, max_bits):
                at = at[home[at] <= shard]  # a pair meets in the later of its two homes
                yield pd.DataFrame({
                    "shard": np.int64(shard), "fp": values[at].view(np.int64), "own": home[at] == shard,
                })

    def link(batch: pd.DataFrame) -> pd.DataFrame:
        own = batch["own"].to_numpy(bool)
        values = batch["fp"].to_numpy(np.int64).view(np.uint64)
        home, visitors = values[own], values[~own]
        both = np.concatenate([home, visitors]).view(np.int64)
        pairs = np.array(link_shard(home, visitors, max_bits), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": both[pairs[:, 0]], "b": both[pairs[:, 1]]})

    dealt = prints.mapInPandas(deal, "shard long, fp long, own boolean")
    return dealt.groupBy("shard").applyInPandas(link, "a long, b long")


def _grouped(
    docs: DataFrame, doc_id: str, text: str, shingle: int, max_bits: int, carry: list[str]
) -> tuple[DataFrame, DataFrame]:
    """The staged rows (row, id, fp, uid), and for each fp its component_id and root."""
    rows = stage(
        docs.select(
            row_of(docs, carry).alias("row"),
            F.col(f"`{doc_id}`").alias("id"),
            fingerprint(text, shingle).alias("fp"),
        ).withColumn("uid", F.monotonically_increasing_id()),
        "prints",
    )
    prints = stage(rows.groupBy("fp").agg(F.min("id").alias("low")), "distinct")
    roots = connected(fingerprint_links(prints.select("fp"), max_bits))
    root = F.coalesce("root", "fp").alias("root")
    each = stage(
        prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", root), "roots"
    )
    lowest = each.groupBy("root").agg(F.min("low").alias("component_id"))
    return rows, each.join(lowest, "root").select("fp", "component_id", "root")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 3,
    carry: list[str] | None = None,
) -> DataFrame:
    """Each row's columns `carry` as struct `row`, its `fp` and its `component_id`.

    `component_id` is the smallest id among the rows that links of at most `max_bits` differing bits
    reach, the row itself included; copies are linked. NULL text counts as empty, and empty texts share
    fingerprint zero. NULL ids never win; a group of NULL ids alone gets NULL. Repeated rows each keep a
    row. An empty table gives an empty result.
    """
    rows, found = _grouped(docs, doc_id, text, shingle, max_bits, carry or [doc_id])
    return rows.join(found, "fp").select("row", "fp", "component_id")


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3
) -> DataFrame:
    """One row of each group of near-duplicates: smallest id, then first row; the columns stay.

    NULL ids come last, and each group keeps a row even then.
    """
    rows, found = _grouped(docs, doc_id, text, shingle, max_bits, docs.columns)
    first = F.min(F.struct(F.col("id").isNull().alias("no"), "id", "uid"))
    light = rows.select("id", "uid", "fp").join(found, "fp")
    kept = light.groupBy("root").agg(first.alias("first")).select(F.col("first.uid").alias("uid"))
    return rows.join(kept, "uid", "left_semi").select("row.*")


def hex_digits(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))
