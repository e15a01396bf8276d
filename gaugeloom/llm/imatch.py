"""Document fingerprints by I-Match over randomised lexicon subsets.

The lexicon holds the terms whose inverse document frequency lies in a band: terms of one document only and
terms of very many say little about likeness. A term's hash deals the lexicon at random into parts, twice as
many at each level, and the first `SUBSETS` parts of a level are its lexicon subsets. A text is fingerprinted
at `LEVELS` levels, the first chosen by its number of terms so that a subset holds one or two of them: each
signature is a hash of the sorted distinct terms that fall into the subset. An edit changes only the
signatures whose subsets it touches, so the share of equal ones tells how like two texts are, at any length.

All steps are expressions. Document frequencies count all terms of all texts; only the terms of a text's
own subsets, some 16 to 32, travel to the lexicon and back.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.llm.common import row_of
from gaugeloom.session import stage

SUBSETS = 16
LEVELS = 4
#: The band: in two documents at least, and in at most this share of them (an idf of 3 or more).
LEAST_DOCS = 2
MOST_SHARE = 0.05
#: Hex digits of a signature, and what stands for a subset without terms.
DIGITS = 4
NONE = "-"
#: Ascending keys of one block of `with_next`.
BLOCK = 1024
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text: str) -> Column:
    """Distinct stretches of letters and digits, A-Z lower-cased; all signs beyond ASCII are letters here."""
    plain = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_distinct(F.array_remove(F.split(plain, "[\\x00-/:-`{-\\x7f]+"), ""))


def level_of(count: Column) -> Column:
    """The level at which a subset holds one to two of so many terms; 0 for few."""
    return F.when(count >= 2 * SUBSETS, F.length(F.bin(F.floor(count / SUBSETS))) - 1).otherwise(0)


def _marked(term: Column) -> Column:
    return F.md5(term.cast("binary"))


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is computed once for a row, though inner functions use it often."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _sampled(found: str, level: str) -> Column:
    """The terms that any subset of this level holds: those whose hash begins with so many zero bits."""
    limit = F.when(F.col(level) > 0, F.lower(F.lpad(F.hex(F.expr(f"shiftleft(1L, 32 - {level})")), 8, "0"))).otherwise("g")
    return _once(limit, lambda top: F.filter(found, lambda t: _marked(t) < top))


def _signatures(own: str, level: str) -> Column:
    """`level` and the signatures of the subsets of this level and the next ones, parted by spaces.

    `own` has the terms and their part at the last level; a part of a level is two of the next.
    """
    sign = lambda told: F.when(told == "", NONE).otherwise(F.substring(F.md5(told.cast("binary")), 1, DIGITS))

    def of_level(up: int) -> Column:
        wide = 1 << (LEVELS - 1 - up)
        told = lambda some, k: F.array_join(
            F.transform(F.filter(some, lambda x: F.floor(x["part"] / wide) == k), lambda x: x["term"]), " "
        )
        inside = F.filter(own, lambda x: x["part"] < SUBSETS * wide)
        every = _once(inside, lambda some: F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda k: told(some, k)))
        return F.transform(every, sign)

    return F.array_join(F.concat(F.array(F.lpad(F.col(level).cast("string"), 2, "0")), *map(of_level, range(LEVELS))), " ")


def likeness(one: str, two: str) -> Column:
    """Share of equal signatures among the subsets in which one of two fingerprints has terms, at the levels
    both have: 1.0 for equal fingerprints, 0.0 for texts that share no level."""
    level = lambda c: F.substring(c, 1, 2).cast("int")
    shift = level(two) - level(one)
    n = (LEVELS - F.abs(shift)) * SUBSETS
    after = lambda c, by: F.slice(F.split(c, " "), 2 + F.greatest(by, F.lit(0)) * SUBSETS, n)
    step = 1 << 16  # counts subsets with terms, and in the higher bits those with equal signatures
    met = F.zip_with(
        after(one, shift), after(two, -shift),
        lambda x, y: F.when(x != y, 1).when(x == NONE, 0).otherwise(1 + step),
    )
    total = F.aggregate(met, F.lit(0), lambda a, b: a + b)
    share = _once(total, lambda t: F.when(t > 0, F.floor(t / step) / (t % step)).otherwise(0.0))
    return F.when(F.col(one) == F.col(two), 1.0).when(F.abs(shift) >= LEVELS, 0.0).otherwise(share)


def document_frequencies(docs: DataFrame, text: str) -> DataFrame:
    """(term, df): how many rows hold each term; summed up in part before the shuffle."""
    return docs.select(F.explode(terms(text)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def fingerprints(
    docs: DataFrame, texts: Sequence[str], carry: Sequence[str], least: int = LEAST_DOCS, most: float = MOST_SHARE,
    lexicon_of: DataFrame | None = None,
) -> DataFrame:
    """Each row's columns `carry` as struct `row`, and fingerprints `fp0`, `fp1`, ... of its columns `texts`.

    The lexicon comes from the first of `texts` in `lexicon_of` (`docs` where that is not given): terms of
    `least` rows or more and at most the share `most` of them. A text none of whose terms in question are in the
    lexicon is fingerprinted by those terms as they are, so short texts have fingerprints too. Equal texts have
    equal fingerprints. NULL text counts as empty; texts without any term share the fingerprint without
    signatures. Repeated rows count as often as they come, and an empty table stays empty. A text's terms are one
    array in one row, however long it is.
    """
    source = docs if lexicon_of is None else lexicon_of
    numbers = range(len(texts))
    found = docs.select(row_of(docs, carry).alias("row"), *[terms(t).alias(f"t{k}") for k, t in enumerate(texts)])
    found = found.select("*", *[level_of(F.size(f"t{k}")).alias(f"l{k}") for k in numbers])
    marks = stage(
        found.select(
            "row", *[f"l{k}" for k in numbers], *[_sampled(f"t{k}", f"l{k}").alias(f"t{k}") for k in numbers]
        ).withColumn("uid", F.monotonically_increasing_id()),
        "marks",
    )
    counted = stage(document_frequencies(source, texts[0]).filter(F.col("df") >= least), "lexicon")
    top = F.greatest(F.lit(float(least)), F.lit(most * source.count()))

    asked = F.array_distinct(F.concat(*[F.col(f"t{k}") for k in numbers]))
    asks = marks.select("uid", F.explode(asked).alias("term"))
    # what very many rows hold goes first: few terms, each of which would be one key's work
    asks = asks.join(counted.filter(F.col("df") > top).select("term"), "term", "left_anti")
    known = asks.join(counted.filter(F.col("df") <= top).select("term"), "term")
    known = known.groupBy("uid").agg(F.collect_list("term").alias("known"))
    placed = marks.join(known, "uid", "left").withColumn("known", F.coalesce("known", F.array().cast("array<string>")))

    def numbered(k: int) -> Column:
        inside = F.array_intersect(f"t{k}", "known")
        own = F.sort_array(F.when(F.size(inside) > 0, inside).otherwise(F.col(f"t{k}")))
        h = lambda t: F.conv(F.substring(_marked(t), 1, 8), 16, 10).cast("long")
        wide = F.expr(f"shiftleft(1L, {29 - LEVELS} - l{k})")
        return _once(wide, lambda w: F.transform(own, lambda t: F.struct(t.alias("term"), F.floor(h(t) / w).alias("part"))))

    own = placed.select("row", *[f"l{k}" for k in numbers], *[numbered(k).alias(f"t{k}") for k in numbers])
    return own.select("row", *[_signatures(f"t{k}", f"l{k}").alias(f"fp{k}") for k in numbers])


def _before(blocks: DataFrame) -> DataFrame:
    """(block, before): each block with the one before it, the first with the last. Blocks are ordered in groups
    of `BLOCK`, and the groups' own edges once more."""
    groups = blocks.withColumn("group", F.floor(F.col("block") / BLOCK))
    edges = groups.groupBy("group").agg(F.max("block").alias("last"))
    order = Window.partitionBy("all").orderBy("group")
    end = edges.agg(F.max("last").alias("end")).withColumn("all", F.lit(0))
    edges = edges.withColumn("all", F.lit(0)).withColumn("past", F.lag("last").over(order))
    edges = edges.join(end, "all").select("group", F.coalesce("past", "end").alias("past"))
    inside = groups.withColumn("near", F.lag("block").over(Window.partitionBy("group").orderBy("block")))
    return inside.join(edges, "group").select("block", F.coalesce("near", "past").alias("before"))


def with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, next_key, next_text): each row with the next one by `key`, the last with the first.

    `key` is a whole number; NULL keys come first, and rows that share a key follow by their text. NULL text counts
    as empty. Rows are put in order in blocks of `BLOCK` key values, and a block's last row meets a copy of
    the first row of the next block that has any, so no task holds all. A single row is its own next.
    """
    lowest = -(1 << 60)
    rows = docs.select(
        F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    ).withColumn("block", F.coalesce(F.floor(F.col("key") / BLOCK), F.lit(lowest)))
    first = F.min(F.struct(F.col("key").isNotNull().alias("some"), "key", "text")).alias("first")
    firsts = stage(rows.groupBy("block").agg(first), "firsts")
    copies = firsts.join(_before(firsts.select("block")), "block").select(
        "first.key", "first.text", F.col("before").alias("block"), F.lit(True).alias("copy")
    )
    order = Window.partitionBy("block").orderBy("copy", "key", "text")
    both = rows.withColumn("copy", F.lit(False)).unionByName(copies)
    led = both.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in ("key", "text")])
    return led.filter(~F.col("copy")).drop("copy", "block")
