"""Approximate nearest neighbours by cosine: forests of sorted hash strings.

Distinct vectors are dealt into shards of a fixed size, distinct queries into blocks of a fixed size. A
task holds one shard's vectors, their forest and one block: for each tree a sorted array of 64-bit strings, one bit for each random hyperplane. A block of
queries descends every tree to its longest common prefix and then ascends all trees together, one bit
a step, until the subtrees under the shared prefix hold enough candidates. Candidates are compared
exactly, and a shard returns only its best for each query. Since a shard's size and its candidates do
not depend on the table, neither does the share of true neighbours found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.session import stage

TREES = 48
BITS = 64
SHARD_ROWS = 16_384
#: Entries over all trees of a shard, as a share of its rows: alike at every size. Where vectors have no
#: structure at all, some 0.53 of the rows are compared with that and 0.92 to 0.97 of the true neighbours found.
CANDIDATES = 0.85
QUERY_BLOCK = 1024
#: Distinct query vectors that meet a shard in one task, about; more of them go to further tasks.
GROUP_QUERIES = 16_384


class Forest:
    """Sorted hash strings of one shard's unit vectors, with the search over them."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, seed: int = 17) -> None:
        self.vectors = vectors
        self.planes = np.random.default_rng(seed).standard_normal((trees, vectors.shape[1], BITS))
        keys = self._keys(vectors)
        self.order = np.argsort(keys, axis=1, kind="stable")
        self.sorted = np.take_along_axis(keys, self.order, axis=1)

    def _keys(self, vectors: np.ndarray) -> np.ndarray:
        out = np.empty((len(self.planes), len(vectors)), np.uint64)
        for t, planes in enumerate(self.planes):
            out[t] = np.packbits(vectors @ planes > 0, axis=1).view(">u8").ravel()
        return out

    def _under(self, keys: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges (tree, query) of the sorted arrays that share `depth` first bits with each key."""
        rest = np.where(depth >= BITS, np.uint64(0), ~np.uint64(0) >> np.minimum(depth, BITS - 1).astype(np.uint64))
        low, high = np.empty(keys.shape, np.int64), np.empty(keys.shape, np.int64)
        for t, own in enumerate(self.sorted):
            low[t] = np.searchsorted(own, keys[t] & ~rest, side="left")
            high[t] = np.searchsorted(own, keys[t] | rest, side="right")
        return low, high

    def longest_match(self, keys: np.ndarray) -> np.ndarray:
        """The longest prefix that each query shares with a row of any tree."""
        best = np.zeros(keys.shape[1], np.int64)
        for t, own in enumerate(self.sorted):
            at = np.searchsorted(own, keys[t])
            for beside in (np.maximum(at - 1, 0), np.minimum(at, len(own) - 1)):
                differ = (own[beside] ^ keys[t]).astype(np.float64)
                # frexp gives the place of the first differing bit; rounding up may cost one bit
                same = np.where(differ == 0, BITS, BITS - np.frexp(differ)[1])
                best = np.maximum(best, np.minimum(same + 1, BITS))
        return best

    def candidates(self, queries: np.ndarray, wanted: int) -> Iterator[np.ndarray]:
        """For each query the rows under the longest prefixes that hold `wanted` entries over all trees.

        An entry is a row in one tree. All trees ascend together from the longest match, so the prefix
        length is the same in all; entries only grow on the way up, so the place to stop is found by
        halving. If even the empty prefix holds fewer, all rows come.
        """
        keys = self._keys(queries)
        up, down = np.zeros(len(queries), np.int64), self.longest_match(keys) + 1
        while (down - up > 1).any():
            depth = (up + down) // 2
            low, high = self._under(keys, depth)
            enough = (high - low).sum(axis=0) >= wanted
            up, down = np.where(enough, depth, up), np.where(enough, down, np.maximum(depth, up + 1))
        low, high = self._under(keys, up)
        for q in range(len(queries)):
            found = np.zeros(self.sorted.shape[1], bool)
            for t in range(len(self.sorted)):
                found[self.order[t, low[t, q] : high[t, q]]] = True
            yield np.flatnonzero(found)


def _usable(vector: str) -> F.Column:
    """Not NULL, no NULL or non-finite component, not zero."""
    v = F.col(vector)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    is_query: str,
    k: int = 5,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    trees: int = TREES,
    candidates: float = CANDIDATES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row where column `is_query` is true.

    Nearness is the cosine in double precision of the vectors as they are; ties go to the smaller id,
    and a row is never its own neighbour (rows with its id are the row itself). `candidates` is the number of
    entries over all trees as a share of a shard's rows; at least so many that k + 1 rows are among them. Equal vectors are
    indexed once with their k + 1 smallest ids, which is all that k neighbours can need. Vectors that
    are NULL, zero, or hold NULL or non-finite components take no part, nor do rows with a NULL id; a
    vector is only compared with those of its length. Fewer rows than k give all of them; an empty
    table gives an empty result.
    """
    plain = vectors.filter(_usable(embedding) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("id"),
        F.transform(embedding, lambda x: x.cast("double")).alias("vector"),
        F.coalesce(F.col(is_query).cast("boolean"), F.lit(False)).alias("asks"),
    )
    rows = stage(
        plain.groupBy("id", "vector").agg(F.max("asks").alias("asks"))
        .withColumn("class", F.xxhash64("vector")).withColumn("dims", F.size("vector")),
        "vectors",
    )
    by_class = Window.partitionBy("class", "vector").orderBy("id")
    first = rows.withColumn("nth", F.row_number().over(by_class)).filter(F.col("nth") <= k + 1)
    classes = stage(
        first.groupBy("class", "vector", "dims").agg(F.sort_array(F.collect_list("id")).alias("ids")), "classes"
    )
    asked = stage(
        rows.filter("asks").select("class", "vector", "dims").distinct()
        .withColumn("question", F.monotonically_increasing_id()),
        "asked",
    )
    shards = max(1, -(-classes.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // GROUP_QUERIES))
    part = lambda seed, n: F.pmod(F.xxhash64("class", F.lit(seed)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = classes.withColumn("shard", part(1, shards)).withColumn("block", each(blocks))
    asks = asked.select("question", "vector", "dims", part(2, blocks).alias("block"), each(shards).alias("shard"))

    def search(own: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(questions):
            raw = np.stack(own["vector"].to_list())
            length = np.linalg.norm(raw, axis=1)
            forest, ids = Forest(raw / length[:, None], trees), own["ids"].to_list()
            least, wanted = np.array([x[0] for x in ids]), max(trees * (k + 1), int(candidates * len(own)))
            asked = np.stack(questions["vector"].to_list())
            size, number = np.linalg.norm(asked, axis=1), questions["question"].to_numpy()
            unit = asked / size[:, None]
            for at in range(0, len(asked), QUERY_BLOCK):
                for q, found in enumerate(forest.candidates(unit[at : at + QUERY_BLOCK], wanted), at):
                    score = forest.vectors[found] @ unit[q]
                    if len(found) > 4 * k + 4:  # the best, with all that tie with the last
                        cut = np.partition(score, -(k + 1))[-(k + 1)] - 1e-12
                        found = found[score >= cut]
                    exact = raw[found] @ asked[q] / (length[found] * size[q])
                    best = np.lexsort((least[found], -exact))[: k + 1]
                    near = sorted((-exact[c], i) for c in best for i in ids[found[c]])[: k + 1]
                    out.extend((number[q], i, -s) for s, i in near)
        return pd.DataFrame(out, columns=["question", "id", "score"])

    task = ["shard", "block", "dims"]
    found = index.groupBy(task).cogroup(asks.groupBy(task))
    found = found.applyInPandas(search, "question long, id long, score double")
    best = Window.partitionBy("question").orderBy(F.desc("score"), "id")
    top = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    near = top.groupBy("question").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("near"))
    own = (
        rows.filter("asks")
        .join(asked.join(stage(near, "near"), "question"), ["class", "vector"])
        .select("id", F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k).alias("near"))
    )
    return own.select(F.col("id").alias("query_id"), F.posexplode("near").alias("pos", "found")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("found.id").alias("vec_id"), "found.score"
    )
