"""Chat formatting: cumulative snapshots collapse to maximal conversations, which are then rendered.

Logs often hold a conversation many times, once for each turn it grew by. The rows of a turn hash to one
term, the terms of all turns up to a turn combine to the hash of that prefix, and a conversation whose whole
hash is the hash of a proper prefix of another is a snapshot of it. Hashes combine by exclusive or, so
prefixes are added up in blocks of turns first and then over blocks: no conversation is one task.
Rendered text comes in parts of at most `PART` turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 512
PART = 64
SEEDS = (1, 2)


def _term(role: str, text: str, seed: int) -> Column:
    parts = [F.lit(seed)]
    for c in (role, text):
        parts += [F.col(c).isNull(), F.coalesce(F.col(c).cast("string"), F.lit(""))]
    return F.xxhash64(*parts)


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv, turn, p0, p1): hashes of all rows of the conversation up to the turn.

    `turns` has columns conv, turn, role and text. Equal rows count once, so a row that was logged
    twice changes nothing; several rows of one turn count as a set.
    """
    terms = [_term("role", "text", s).alias(f"t{k}") for k, s in enumerate(SEEDS)]
    rows = turns.select("conv", "turn", *terms).distinct()
    each = rows.groupBy("conv", "turn").agg(
        *[F.bit_xor(F.xxhash64(F.col("turn").isNull(), "turn", f"t{k}", F.lit(s))).alias(f"t{k}") for k, s in enumerate(SEEDS)]
    )
    # a NULL turn is the last: its block comes after all others
    each = each.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit((1 << 62))))
    inside = Window.partitionBy("conv", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = each.groupBy("conv", "block").agg(*[F.bit_xor(f"t{k}").alias(f"b{k}") for k in range(len(SEEDS))])
    blocks = blocks.select(
        "conv", "block", *[F.coalesce(F.bit_xor(f"b{k}").over(before), F.lit(0)).alias(f"b{k}") for k in range(len(SEEDS))]
    )
    run = [F.bit_xor(f"t{k}").over(inside).alias(f"i{k}") for k in range(len(SEEDS))]
    own = each.select("conv", "turn", "block", *run).join(blocks, ["conv", "block"])
    return own.select("conv", "turn", *[F.col(f"i{k}").bitwiseXOR(F.col(f"b{k}")).alias(f"p{k}") for k in range(len(SEEDS))])


def maximal(turns: DataFrame) -> DataFrame:
    """(conv) of the conversations that no longer one begins with; of equal ones the smallest id."""
    prefix = prefix_hashes(turns)
    last = turns.groupBy("conv").agg(F.max(F.struct(F.col("turn").isNull().alias("none"), "turn")).alias("end"))
    last = last.select("conv", F.col("end.turn").alias("end"))
    ends = prefix.join(last, "conv").withColumn("whole", F.col("turn").eqNullSafe(F.col("end")))
    whole = ends.filter("whole").groupBy("p0", "p1").agg(F.min("conv").alias("conv"))
    proper = ends.filter("NOT whole").select("p0", "p1").distinct()
    return whole.join(proper, ["p0", "p1"], "left_anti").select("conv")


def render(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The maximal conversations: conv_id, `part` (from 0 by `PART` turn numbers), `n_turns`, `text`.

    A turn is rendered as `<|role|>`, a line break, its text, `<|end|>` and a line break, in order of turn,
    role, text; the parts of a conversation in order are its whole text. A conversation that is a
    cumulative snapshot of a longer one, or a copy, is left out. Rows of NULL conversation belong to
    none and are left out; a NULL turn is the last (part -1); NULL role or text is rendered empty
    but differs from empty when compared. Negative turns have parts below -1. Equal rows count once. An empty table
    gives an empty result.
    """
    turns = conversations.select(
        F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    ).filter("conv IS NOT NULL")
    kept = turns.join(maximal(turns), "conv", "left_semi")
    part = F.floor(F.col("turn") / PART)
    part = F.when(F.col("turn").isNull(), -1).when(part < 0, part - 1).otherwise(part).cast("long")
    row = F.struct(F.col("turn").isNull().alias("none"), "turn", "role", "text")
    said = kept.groupBy("conv", part.alias("part")).agg(F.sort_array(F.collect_set(row)).alias("rows"))
    piece = lambda r: F.concat(
        F.lit("<|"), F.coalesce(r["role"], F.lit("")), F.lit("|>\n"), F.coalesce(r["text"], F.lit("")), F.lit("<|end|>\n")
    )
    return said.select(
        F.col("conv").alias(conv_id), "part", F.size("rows").alias("n_turns"),
        F.array_join(F.transform("rows", piece), "").alias("text"),
    )
