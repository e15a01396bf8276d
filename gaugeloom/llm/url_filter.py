"""URL rules by Bloom filter cascades.

A list of keys is encoded in levels: the first holds the listed keys, the second those keys of the
corpus that the first lets through by mistake, the third the listed keys that the second holds by
mistake, and so on until a level makes no mistake on the corpus. As the levels are built against all
keys that the corpus can ask for, membership is exact, and asking takes a few hashes of the key: no join.
The levels are literals in the plan; `MAX_BITS` bounds them, and a longer list is refused.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.session import stage

FIRST_HASHES = 8
MAX_BITS = 1 << 26
MAX_LEVELS = 64


@dataclass
class Level:
    bits: Column  # array of longs, a literal
    size: int
    hashes: int
    seed: int

    def has(self, key: Column) -> Column:
        found = F.lit(True)
        for place in places(key, self.size, self.hashes, self.seed):
            word = F.get(self.bits, F.shiftright(place, 6).cast("int"))
            found = found & (F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1)
        return found


def places(key: Column, size: int, hashes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(1000 * seed + j)), F.lit(size)) for j in range(hashes)]


def build_level(keys: DataFrame, count: int, hashes: int, seed: int) -> Level:
    """The Bloom filter of `count` distinct keys in column `key`."""
    size = 64 * max(1, math.ceil(count * hashes / math.log(2) / 64))
    if size > MAX_BITS:
        raise ValueError(f"a level of {size} bits is over the bound of {MAX_BITS}: split the list")
    place = F.explode(F.array(*places(F.col("key"), size, hashes, seed))).alias("place")
    bit = F.expr("shiftleft(1L, cast(pmod(place, 64) as int))")
    words = keys.select(place).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = dict(words.collect())  # bounded by MAX_BITS
    literal = ", ".join(f"{found.get(k, 0)}L" if found.get(k, 0) > -(1 << 63) else "shiftleft(1L, 63)" for k in range(size // 64))
    return Level(F.expr(f"array({literal})"), size, hashes, seed)


class Cascade:
    """Exact membership in `listed` for every key of `universe` (both with a column `key`)."""

    def __init__(self, listed: DataFrame, universe: DataFrame) -> None:
        inside = stage(listed.filter("key IS NOT NULL").distinct(), "listed")
        self.levels: list[Level] = []
        count = inside.count()
        if not count:
            return
        self.levels.append(build_level(inside, count, FIRST_HASHES, 0))
        through = universe.filter(self.levels[0].has(F.col("key"))).distinct()
        holds, other = stage(through.join(inside, "key", "left_anti"), "mistakes"), inside
        while count := holds.count():
            if len(self.levels) == MAX_LEVELS:
                raise ValueError("the cascade does not end: a key is both listed and not")
            self.levels.append(build_level(holds, count, 1, len(self.levels)))
            holds, other = stage(other.filter(self.levels[-1].has(F.col("key"))), "mistakes"), holds

    def has(self, key: Column) -> Column:
        """Is the key listed? Levels are asked in turn; the first that lacks it decides."""
        found = F.lit(False)
        for level in reversed(self.levels):
            found = level.has(key) & ~found
        return found


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host in lower case and path of a URL; both empty without `://`."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _keys(labels: Sequence[int], lengths: Sequence[int]) -> Column:
    """Host suffixes and path starts that a rule could have, most labels and longest first."""
    n = F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1
    keys = [
        F.when((n >= m) & (F.length("path") >= k), F.concat(F.substring_index("host", ".", -m), F.substring("path", 1, k)))
        for m in sorted(labels, reverse=True) for k in sorted(lengths, reverse=True)
    ]
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(action, key) of rules written as host and path, like `("block", "example.com/de/")`."""
    return spark.createDataFrame([(a, k) for a, k in rules], "action string, key string")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """`pages` columns as struct `row`, `host`, `path`, `rule` and `verdict`.

    A rule fits its host and all subdomains if the path starts with the rule's path; the longest rule
    wins, of equally long ones the one with more host labels, and block before allow for the same key.
    No rule: `rule` is NULL and the verdict allow, as the URL is on no list. A NULL URL or one without
    `://` has empty host and path and so no rule. Repeated rows get the same verdict; an empty table
    stays empty. `rules` has columns `action` (allow or block) and `key`; its distinct label counts and
    path lengths say which keys a URL asks for, so very long URLs ask for no more than others.
    """
    host, path = host_and_path(url)
    kinds = rules.filter("instr(key, '/') > 0").select(
        F.size(F.split(F.substring_index("key", "/", 1), r"\.")).alias("labels"),
        (F.length("key") - F.instr("key", "/") + 1).alias("length"),
    )
    labels = [r[0] for r in kinds.select("labels").distinct().collect()]
    lengths = [r[0] for r in kinds.select("length").distinct().collect()]
    fields = [F.col(f"`{c}`") for c in pages.columns]
    rows = pages.select(F.struct(*fields).alias("row"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("keys", _keys(labels, lengths))
    universe = rows.select(F.explode("keys").alias("key"))
    lists = {a: Cascade(rules.filter(F.col("action") == a).select("key"), universe) for a in ("block", "allow")}
    longest = lambda xs: F.aggregate(
        xs, F.lit(None).cast("string"),
        lambda best, x: F.when(best.isNull() | (F.length(x) > F.length(best)), x).otherwise(best),
    )
    judged = rows.withColumn("rule", longest(F.filter("keys", lambda k: lists["block"].has(k) | lists["allow"].has(k))))
    blocked = F.col("rule").isNotNull() & lists["block"].has(F.col("rule"))
    return judged.select("row", "host", "path", "rule", F.when(blocked, "block").otherwise("allow").alias("verdict"))
