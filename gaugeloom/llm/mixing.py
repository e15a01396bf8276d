"""Mixing sources to target weights by Poisson replication.

A source's rate is the mean number of times one of its documents should appear for the source to get
its share of the mix. Each document draws a Poisson number with that mean by inverting the
distribution at a number hashed from its id, is repeated so often, and a sort by a second hash
shuffles all copies globally. Everything is expressions; a hot source is only a larger count. A large rate is
the sum of many draws: draws come in blocks of `DRAWS`, which are dealt out over tasks, and each block makes its
own copies, so a document that fills half the mix is many tasks' work.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.llm.common import n_bytes, row_of
from gaugeloom.session import stage

#: A draw inverts a distribution with at most this mean; larger rates are sums of several draws.
MOST = 16.0
TERMS = 96
#: Draws of one block; a block makes some `DRAWS` * `MOST` copies. Blocks in one array at most.
DRAWS = 64
SPAN = 1 << 12
#: Parts in which a document meets its blocks.
SALTS = 64


def unit(*parts: str | Column) -> Column:
    """A number in [0, 1) out of the first 52 bits of an MD5 of the parts."""
    text = F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def poisson_cdf(mean: Column) -> Column:
    """P(X <= k) for k from 0 on, as an array."""
    logs = F.array(*[F.lit(math.lgamma(k + 1)) for k in range(TERMS)])
    term = F.transform(F.sequence(F.lit(0), F.lit(TERMS - 1)), lambda k: F.exp(k * F.log(mean) - mean - F.get(logs, k)))
    return F.transform(term, lambda _, k: F.aggregate(F.slice(term, 1, k + 1), F.lit(0.0), lambda a, b: a + b))


def source_rates(docs: DataFrame, weights: Mapping[str, float], other: float, text: str, source: str) -> DataFrame:
    """For each source its bytes, target share, rate, draws for a document, and the draw's distribution."""
    name = F.coalesce(F.col(source).cast("string"), F.lit(""))
    sizes = docs.groupBy(name.alias("name")).agg(F.sum(n_bytes(text) + 1).cast("double").alias("bytes"))
    weight = F.lit(float(other))
    for key, value in weights.items():
        weight = F.when(F.col("name") == key, float(value)).otherwise(weight)
    sizes = stage(sizes.withColumn("weight", weight), "sources")
    total, heavy = sizes.agg(F.sum("bytes"), F.sum("weight")).first()
    share = F.col("weight") / (heavy or 1.0)
    rated = sizes.withColumn("share", share).withColumn("rate", share * (total or 0.0) / F.col("bytes"))
    rated = rated.withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / MOST)).cast("long"))
    return stage(rated.withColumn("cdf", poisson_cdf(F.col("rate") / F.col("draws"))), "rates")


def _drawn(rows: DataFrame, seed: int) -> DataFrame:
    """`rows` with `own`, the copies that the draws of block number `block` make."""
    draw = lambda n: unit("draw", str(seed), F.col("key"), n.cast("string"))
    # a draw's number is hashed once, outside the search in the distribution
    found = lambda u: F.size(F.filter("cdf", lambda c: c <= u))
    last = F.least(F.col("draws"), (F.col("block") + 1) * DRAWS)
    numbers = F.transform(F.sequence(F.col("block") * DRAWS + 1, last), draw)
    return rows.withColumn("own", F.aggregate(F.transform(numbers, found), F.lit(0), lambda a, b: a + b))


def _tasks(rows: DataFrame) -> int:
    """A fixed number of tasks: what small rows unfold to is no reason to pack them into few."""
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _blocks(rows: DataFrame) -> DataFrame:
    """`rows` once for each block of their draws, numbered from 0 in column `block`, dealt over tasks.

    Blocks are unfolded in spans of `SPAN` first, so that no array is longer than that.
    """
    counted = rows.withColumn("blocks", F.ceil(F.col("draws") / DRAWS))
    spans = counted.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1, F.lit(SPAN).cast("long"))))
    inside = F.sequence(F.col("first"), F.least(F.col("first") + SPAN, F.col("blocks")) - 1)
    tasks = _tasks(rows)
    unfolded = spans.repartition(tasks, "key", "first").withColumn("block", F.explode(inside)).drop("blocks", "first")
    return unfolded.repartition(tasks, "key", "block")


def _many(rows: DataFrame, seed: int) -> DataFrame:
    """The blocks of copies of `rows` with many draws: row, key, copies, before (copies of earlier blocks), own.

    The blocks of a key are numbered through by sums over spans; a row meets them in `SALTS` parts.
    """
    over, span = Window.partitionBy("key", "name"), F.floor(F.col("block") / SPAN).alias("span")
    keys = rows.select("key", "name", "draws", "cdf").distinct()
    made = stage(_drawn(_blocks(keys), seed).select("key", "name", "block", span, "own"), "blocks")
    spans = made.groupBy("key", "name", "span").agg(F.sum("own").alias("part")).select(
        "key", "name", "span", F.sum("part").over(over).alias("copies"),
        (F.sum("part").over(over.orderBy("span")) - F.col("part")).alias("past"),
    )
    inside = F.sum("own").over(Window.partitionBy("key", "name", "span").orderBy("block")) - F.col("own")
    placed = made.withColumn("inside", inside).join(spans, ["key", "name", "span"]).filter("own > 0").select(
        "key", "name", "copies", (F.col("past") + F.col("inside")).alias("before"), "own",
        F.pmod("block", F.lit(SALTS)).cast("int").alias("salt"),
    )
    salted = rows.select("row", "key", "name", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    met = salted.join(placed, ["key", "name", "salt"]).select("row", "key", "copies", "before", "own")
    return met.repartition(_tasks(rows), "key", "before")


def mix(
    docs: DataFrame, weights: Mapping[str, float], other: float = 1.0, seed: int = 0,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """All copies in their shuffled order: the document as struct `row`, `copies`, `copy`, `mix_key`.

    `weights` gives sources their weight, all others have `other`; shares are over the sources that are
    there, sizes are UTF-8 bytes of the text plus one, and the mix has about the corpus's size. A
    document that draws 0 is left out, which is the operator's feature; weight 0 leaves out a source.
    NULL text counts as empty, NULL source as the empty one, a NULL id as the empty id. Rows that share
    an id share its draws and their `mix_key`s, by which alone the order is defined; their copies may stand
    in either order. A source may be as small as one empty document: its copies then are made in
    many tasks, `copies` and `copy` are long. An empty table stays empty.
    """
    rates = source_rates(docs, weights, other, text, source)
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    rows = docs.select(
        row_of(docs).alias("row"), key.alias("key"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("name")
    ).join(rates.select("name", "draws", "cdf"), "name")
    long = F.lit(0).cast("long")
    blocks = _drawn(rows.filter(F.col("draws") <= DRAWS).withColumn("block", long), seed).filter("own > 0").select(
        "row", "key", F.col("own").cast("long").alias("copies"), long.alias("before"), "own"
    )
    if not rates.filter(F.col("draws") > DRAWS).isEmpty():
        blocks = blocks.unionByName(_many(rows.filter(F.col("draws") > DRAWS), seed))
    copies = blocks.withColumn("at", F.explode(F.sequence(F.lit(1), "own"))).withColumn("copy", F.col("at") + F.col("before"))
    order = F.md5(F.concat_ws("|", F.lit("order"), F.lit(str(seed)), "key", F.col("copy").cast("string")))
    return copies.select("row", "copies", "copy", order.alias("mix_key")).orderBy("mix_key")
