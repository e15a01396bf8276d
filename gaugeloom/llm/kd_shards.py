"""Shards by a k-d tree over document metadata, split at weighted medians.

The tree grows level by level. For each node the widest dimension is taken, and the weighted median
along it is found by histograms: all tasks count bytes into a bounded number of bins, the bin that
holds the median is cut again, until it is a single value or next to nothing lies in it. Rows of equal
value are parted by a hash of the row, so that no source, language or group of copies is too heavy to
split. The driver holds the tree and one histogram for each open node.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.llm.common import n_bytes, row_of, utf8
from gaugeloom.session import stage

TIE_BITS = 30
MAX_BINS = 4096
ALL_BINS = 1 << 18
NEAR = 1e-5


def metadata(text: str, lang: str, source: str) -> dict[str, Column]:
    """Dimensions as numbers below 2**32: language, source, size and checksum of the text.

    Copies agree in all of them, so they stay together unless a cut runs through their group.
    """
    code = lambda c: F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary"))
    return {
        "d_lang": code(lang),
        "d_source": code(source),
        "d_size": F.least(n_bytes(text), F.lit((1 << 32) - 1)),
        "d_text": F.crc32(utf8(text)),
    }


@dataclass
class Tree:
    """Arrays of nodes; leaves have dimension -1. A row goes left if its key is at most the cut."""

    dim: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    shards: list[int] = field(default_factory=lambda: [1])

    def split(self, node: int, dim: int, cut: int) -> None:
        n = self.shards[node]
        for side, part in ((self.left, n // 2), (self.right, n - n // 2)):
            side[node] = len(self.dim)
            for values, first in zip((self.dim, self.cut, self.left, self.right, self.shards), (-1, 0, 0, 0, part)):
                values.append(first)
        self.dim[node], self.cut[node] = dim, cut

    def place(self, keys: np.ndarray) -> np.ndarray:
        """The leaf of each row of keys (one column for each dimension)."""
        dim, cut, left, right = (np.array(x, np.int64) for x in (self.dim, self.cut, self.left, self.right))
        at = np.zeros(len(keys), np.int64)
        while (open_ := np.flatnonzero(dim[at] >= 0)).size:
            now = at[open_]
            value = keys[open_, dim[now]]
            at[open_] = np.where(value <= cut[now], left[now], right[now])
        return at


def _keys(batch: pd.DataFrame, names: list[str]) -> np.ndarray:
    """Each dimension's value above the row's tie-break."""
    values = batch[names].to_numpy(np.int64)
    return (values << TIE_BITS) | batch["tie"].to_numpy(np.int64)[:, None]


def _extents(rows: DataFrame, tree: Tree, names: list[str]) -> pd.DataFrame:
    """Weight, and least and greatest key by dimension, of each leaf."""
    kind = "node long, weight long, " + ", ".join(f"lo{i} long, hi{i} long" for i in range(len(names)))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = _keys(batch, names)
            frame = pd.DataFrame({"node": tree.place(keys), "weight": batch["size"].to_numpy()})
            for i in range(len(names)):
                frame[f"lo{i}"] = frame[f"hi{i}"] = keys[:, i]
            ways = {"weight": "sum"} | {f"{w}{i}": f for i in range(len(names)) for w, f in (("lo", "min"), ("hi", "max"))}
            yield frame.groupby("node", as_index=False).agg(ways)[["node", "weight", *list(ways)[1:]]]

    parts = [f(f"{w}{i}").alias(f"{w}{i}") for i in range(len(names)) for w, f in (("lo", F.min), ("hi", F.max))]
    found = rows.mapInPandas(each, kind).groupBy("node").agg(F.sum("weight").alias("weight"), *parts)
    return found.toPandas().set_index("node")


def _histogram(rows: DataFrame, tree: Tree, names: list[str], search: dict[int, dict], bins: int) -> pd.DataFrame:
    """Weight by node and bin of the range that each open node searches."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = _keys(batch, names)
            node = tree.place(keys)
            for n in np.unique(node):
                if (s := search.get(int(n))) is None:
                    continue
                own = node == n
                at = (keys[own, s["dim"]] - s["lo"]) // s["width"]
                fits = (at >= 0) & (at < bins)
                weight = np.bincount(at[fits], batch["size"].to_numpy()[own][fits], bins).astype(np.int64)
                some = np.flatnonzero(weight)
                yield pd.DataFrame({"node": n, "bin": some, "weight": weight[some]})

    found = rows.mapInPandas(each, "node long, bin long, weight long")
    return found.groupBy("node", "bin").agg(F.sum("weight").alias("weight")).toPandas()


def _medians(rows: DataFrame, tree: Tree, names: list[str], search: dict[int, dict]) -> dict[int, int]:
    """The cut of each open node: keys up to it weigh the left side's share."""
    cuts: dict[int, int] = {}
    while search:
        bins = max(16, min(MAX_BINS, ALL_BINS // len(search)))
        for s in search.values():
            s["width"] = max(1, -(-(s["hi"] - s["lo"] + 1) // bins))
        seen = _histogram(rows, tree, names, search, bins)
        for node, own in seen.groupby("node"):
            s, own = search[node], own.sort_values("bin")
            upto = s["below"] + own["weight"].cumsum().to_numpy()
            k = min(int(np.searchsorted(upto, s["target"])), len(own) - 1)
            weight = int(own["weight"].iloc[k])
            low = s["lo"] + int(own["bin"].iloc[k]) * s["width"]
            before = int(upto[k]) - weight
            if s["width"] == 1 or weight <= NEAR * s["total"]:
                nearer = abs(before - s["target"]) < abs(int(upto[k]) - s["target"])
                cuts[node] = low - 1 if nearer else low + s["width"] - 1
                del search[node]
            else:
                s |= {"lo": low, "hi": low + s["width"] - 1, "below": before}
    return cuts


def grow(rows: DataFrame, names: list[str], shards: int) -> Tree:
    """The tree over staged rows with columns `names`, `tie` and `size`."""
    tree, whole = Tree(shards=[shards]), None
    while any(d < 0 and n > 1 for d, n in zip(tree.dim, tree.shards)):
        found = _extents(rows, tree, names)
        if whole is None:
            whole = [max(1, int(found[f"hi{i}"].max() - found[f"lo{i}"].min())) for i in range(len(names))] if len(found) else []
        search: dict[int, dict] = {}
        for node in [k for k, d in enumerate(tree.dim) if d < 0 and tree.shards[k] > 1]:
            if node not in found.index:
                tree.split(node, 0, 0)  # a node without rows: all its shards stay empty
                continue
            own = found.loc[node]
            dim = max(range(len(names)), key=lambda i: (own[f"hi{i}"] - own[f"lo{i}"]) / whole[i])
            total, n = int(own["weight"]), tree.shards[node]
            search[node] = {
                "dim": dim, "lo": int(own[f"lo{dim}"]), "hi": int(own[f"hi{dim}"]), "below": 0,
                "total": total, "target": total * (n // 2) / n,
            }
        dims = {node: s["dim"] for node, s in search.items()}
        for node, cut in sorted(_medians(rows, tree, names, search).items()):
            tree.split(node, dims[node], cut)
    return tree


def kd_shards(
    docs: DataFrame,
    carry: list[str],
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    shards: int | None = None,
    target_bytes: int | None = None,
) -> DataFrame:
    """Each row's columns `carry` as struct `row`, its `size`, `text_crc32`, `shard` and `slot`.

    Size is the UTF-8 bytes of the text plus one; NULL text counts as empty. Give the number of shards,
    or the bytes that a shard may hold at most on average. Shards are numbered in the tree's order from 0; slots
    count a shard's rows from 0 without gaps. NULL language or source counts as the empty one. Repeated
    rows are placed each on its own. With fewer rows than shards some shards stay empty; an empty
    table gives an empty result.
    """
    dims = metadata(text, lang, source)
    names = list(dims)
    rows = stage(
        docs.select(
            row_of(docs, carry).alias("row"),
            (n_bytes(text) + 1).alias("size"),
            *[c.cast("long").alias(n) for n, c in dims.items()],
        )
        .withColumn("uid", F.monotonically_increasing_id())
        .withColumn("tie", F.xxhash64("uid").bitwiseAND((1 << TIE_BITS) - 1)),
        "metadata",
    )
    if shards is None:
        shards = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // target_bytes))
    tree = grow(rows.select(*names, "tie", "size"), names, shards)
    leaves = [k for k, d in enumerate(tree.dim) if d < 0]
    first, todo = {}, [0]
    while todo:
        node = todo.pop()
        if tree.dim[node] < 0:
            first[node] = len(first)
        else:
            todo += [tree.right[node], tree.left[node]]
    number = np.full(len(tree.dim), -1, np.int64)
    number[leaves] = [first[k] for k in leaves]

    @F.pandas_udf("int")
    def shard(*columns: pd.Series) -> pd.Series:
        batch = pd.DataFrame(dict(zip([*names, "tie"], columns)))
        return pd.Series(number[tree.place(_keys(batch, names))].astype(np.int32))

    part = F.shiftright("uid", 33)
    placed = stage(
        rows.select("row", "size", F.col("d_text").alias("text_crc32"), "uid", part.alias("part"),
                    shard(*names, "tie").alias("shard")),
        "placed",
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("uid")) - 1
    slot = (F.col("first") + F.col("inside")).alias("slot")
    return (
        placed.withColumn("inside", inside)
        .join(counts, ["shard", "part"])
        .select("row", "size", "text_crc32", "shard", slot)
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder for each shard, its rows in slot order over range-parted files."""
    flat = placed.select("row.*", "shard", "slot") if "row" in placed.columns else placed
    flat.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
