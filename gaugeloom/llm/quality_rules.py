"""Quality rules: counts of each text, plain limits, and robust multivariate outliers.

Every text gives counts, the counts give a vector of transformed statistics, and for each language
and source a minimum-covariance-determinant estimate says how far a vector is from the bulk. The
estimate starts from medians and quartiles and takes concentration steps: the `SHARE` of rows nearest
by Mahalanobis distance gives the next centre and covariance, whose determinant never grows. All
steps are grouped aggregates over all rows, so a source with a third of them is summed before it is
shuffled; only one row of sums for each group goes to numpy.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.common import row_of, utf8
from gaugeloom.session import stage

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_upper",
]
SYMBOLS = b"#*$%&|<>"
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SPACE = b" \t\n\v\f\r"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FEATURES = ["f_words", "f_length", "f_symbols", "f_lines", "f_repeats", "f_marks", "f_upper"]
#: Smallest standard deviation that counts, by feature: regularises groups with no spread.
FLOORS = [0.3, 0.05, 0.25, 0.3, 0.3, 0.15, 0.15]
SHARE = 0.75
STEPS = 4
MIN_ROWS = 200
#: Parts that rows of one group are dealt into when they meet their group's estimate.
SALTS = 64
TAIL = 1e-9
REMEMBERED = 400_000
#: Key of the estimate over all good rows.
WHOLE = "whole"


class _Ids(dict):
    """Numbers for words; below 2**21, so that three fit into 63 bits."""

    def __missing__(self, word: bytes) -> int:
        self[word] = got = len(self)
        return got


def repeated_words(words: list[bytes], ids: _Ids) -> int:
    """Words inside windows of three words that occur twice or more, the first one included."""
    if len(words) < 4:
        return 0
    if len(ids) + len(words) > REMEMBERED:
        ids.clear()
    at = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    if len(ids) < 1 << 21:
        window = (at[:-2] << 42) | (at[1:-1] << 21) | at[2:]
    else:  # one text with over two million different words
        pair = np.unique(np.stack([at[:-1], at[1:]], 1), axis=0, return_inverse=True)[1].ravel()
        window = pair[:-1] * (len(ids) + 1) + at[2:]
    order = np.argsort(window, kind="stable")
    same = np.diff(window[order]) == 0
    twice = np.zeros(len(window), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(len(at), bool)
    for k in range(3):
        inside[k : k + len(window)] |= twice
    return int(inside.sum())


def text_counts(text: bytes, ids: _Ids) -> tuple[int, ...]:
    """The counts named in `COUNTS` of one UTF-8 text."""
    words = text.split()
    if not words:
        return (0,) * len(COUNTS)
    solid = text.translate(None, SPACE)
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    repeats = repeated_words(words, ids)
    return (
        len(words),
        len(solid.decode("utf-8", "replace")),
        len(solid) - len(solid.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeats,
        len(lines),
        len(solid) - len(solid.translate(None, MARKS)),
        len(solid) - len(solid.translate(None, UPPER)),
    )


def counts(text: str) -> Column:
    """A struct with the counts of a text column."""

    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ids = _Ids()
        for texts in batches:
            got = np.array([text_counts(x, ids) for x in texts], np.int64)
            yield pd.DataFrame(got.reshape(-1, len(COUNTS)), columns=COUNTS)

    return of(utf8(text))


def base_failed() -> Column:
    """The plain limits: under 50 words, or over half of them repeated."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _features() -> list[Column]:
    chars, words, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("word_chars", "n_words", "n_lines"))
    share = lambda part, whole, small=0.02: F.log(part / whole + small)
    return [
        F.log1p(F.col("n_words")),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        share(F.col("n_symbols"), chars),
        share(F.col("n_dup_lines"), lines, 0.2),
        share(F.col("n_repeat_words"), words, 0.2),
        share(F.col("n_marks"), chars),
        share(F.col("n_upper"), chars),
    ]


def _chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution function by its series."""
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= x / n
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a)) if x > 0 else 0.0


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_cdf(mid, k) < p else (low, mid)
    return high


def _group_keys(stats: DataFrame, min_rows: int) -> DataFrame:
    """`key` of the estimate: the language and source; small ones share their language's rest, small
    rests share one for all, and where even that is small it is made from all good rows of the corpus.
    NULL counts as the empty text."""
    each = stats.filter("NOT base_failed").groupBy("g_lang", "g_source").agg(F.count(F.lit(1)).alias("n"))
    rest = F.when(F.col("n") < min_rows, F.col("n"))
    by_lang = each.groupBy("g_lang").agg(F.sum(rest).alias("rest"))
    key = (
        F.when(F.col("n") >= min_rows, F.concat_ws("\x1f", F.lit("source"), "g_lang", "g_source"))
        .when(F.col("rest") >= min_rows, F.concat_ws("\x1f", F.lit("lang"), "g_lang"))
        .otherwise("all")
    )
    keys = stage(each.join(by_lang, "g_lang").select("g_lang", "g_source", "n", key.alias("key")), "groups")
    few = (keys.filter("key = 'all'").agg(F.sum("n")).first()[0] or 0) < min_rows
    return keys.withColumn("key", F.when(F.lit(few) & (F.col("key") == "all"), WHOLE).otherwise(F.col("key"))).drop("n")


def _salted(groups: DataFrame) -> DataFrame:
    """A row of each group for each salt. Joined by group and salt, a hot group is many tasks' work, and
    what is summed up by group afterwards is summed up in part before it is shuffled."""
    return groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _distance(params: str = "p") -> Column:
    """Squared Mahalanobis distance of the features to the parameters in struct `params`."""
    d = len(FEATURES)
    off = [F.col(f) - F.col(params)["center"][i] for i, f in enumerate(FEATURES)]
    total = F.lit(0.0)
    for i in range(d):
        for j in range(i, d):
            total = total + (1 if i == j else 2) * F.col(params)["inverse"][i * d + j] * off[i] * off[j]
    return total


def _start(stats: DataFrame) -> DataFrame:
    """Medians, and quartile ranges as standard deviations."""
    quart = [F.percentile_approx(f, [0.25, 0.5, 0.75], 2000).alias(f) for f in FEATURES]
    found = stats.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *quart)
    center = F.array(*[F.col(f)[1] for f in FEATURES])
    d, cells = len(FEATURES), []
    for i in range(d):
        for j in range(d):
            spread = (F.col(FEATURES[i])[2] - F.col(FEATURES[i])[0]) / 1.349
            cells.append(F.lit(0.0) if i != j else 1 / F.greatest(spread, F.lit(FLOORS[i])) ** 2)
    return found.select("key", F.struct("n", center.alias("center"), F.array(*cells).alias("inverse")).alias("p"))


def _sums() -> list[Column]:
    d = len(FEATURES)
    pairs = [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])) for i in range(d) for j in range(i, d)]
    return [
        F.count(F.lit(1)).cast("double").alias("h"),
        F.array(*[F.sum(f) for f in FEATURES]).alias("one"),
        F.array(*pairs).alias("two"),
    ]


def _estimate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Centre and inverse covariance of one row of sums for each group."""
    d = len(FEATURES)
    cut = chi2_quantile(SHARE, d)
    factor = SHARE / _chi2_cdf(cut, d + 2)  # makes the trimmed covariance right for normal rows
    for batch in batches:
        out = []
        for key, n, h, one, two in batch[["key", "n", "h", "one", "two"]].itertuples(index=False):
            mean = np.asarray(one) / h
            cov = np.zeros((d, d))
            cov[np.triu_indices(d)] = np.asarray(two) / h
            cov = np.triu(cov) + np.triu(cov, 1).T - np.outer(mean, mean)
            inverse = np.linalg.inv(factor * cov + np.diag(np.square(FLOORS)))
            out.append((key, {"n": n, "center": mean.tolist(), "inverse": inverse.ravel().tolist()}))
        yield pd.DataFrame(out, columns=["key", "p"])


def robust_estimates(stats: DataFrame, steps: int = STEPS) -> DataFrame:
    """(key, p): centre and inverse covariance of each group after the concentration steps.

    `stats` has columns key, salt (from 0 below `SALTS`) and the features.
    """
    params = stage(_start(stats), "mcd")
    for _ in range(steps):
        far = stats.join(_salted(params), ["key", "salt"]).withColumn("d2", _distance())
        cut = far.groupBy("key").agg(
            F.percentile_approx("d2", SHARE, 2000).alias("cut"), F.first("p.n").alias("n")
        )
        sums = far.join(_salted(cut), ["key", "salt"]).filter("d2 <= cut").groupBy("key").agg(F.first("n").alias("n"), *_sums())
        kind = "key string, p struct<n: long, center: array<double>, inverse: array<double>>"
        params = stage(sums.mapInPandas(_estimate, kind), "mcd")
    return params


def quality_rules(
    docs: DataFrame,
    carry: list[str],
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_rows: int = MIN_ROWS,
    tail: float = TAIL,
) -> DataFrame:
    """Each row's columns `carry` as struct `row`, its counts, `base_failed`, `distance2` and `kept`.

    A row is kept unless it fails the plain limits or its squared robust distance passes the
    chi-square quantile of `tail`. NULL text counts as empty (it fails), NULL language or source as
    the empty one. Sources with under `min_rows` good rows are judged with the rest of their
    language, small rests with all other rests, and those, if fewer than that, by all good rows of the corpus,
    however few: the floors of the spreads keep that estimate from being narrow. Only rows that fail the
    limits in a group without a good row have no `distance2`. Copies and repeated rows get the same verdict. An
    empty table stays empty.
    """
    stats = stage(
        docs.select(
            row_of(docs, carry).alias("row"),
            F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("g_lang"),
            F.coalesce(F.col(source).cast("string"), F.lit("")).alias("g_source"),
            counts(text).alias("counts"),
        )
        .select("row", "g_lang", "g_source", "counts.*")
        .withColumn("base_failed", base_failed())
        .withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        .select("*", *[x.alias(f) for f, x in zip(FEATURES, _features())]),
        "stats",
    )
    keys = _group_keys(stats, min_rows)
    good = stats.filter("NOT base_failed").join(_salted(keys), ["g_lang", "g_source", "salt"])
    good = good.select("key", "salt", *FEATURES)
    if not keys.filter(F.col("key") == WHOLE).isEmpty():
        good = good.filter(F.col("key") != WHOLE).unionByName(good.withColumn("key", F.lit(WHOLE)))
    params = robust_estimates(good)
    limit = chi2_quantile(1 - tail, len(FEATURES))
    by_group = keys.join(params, "key")
    judged = stats.join(_salted(by_group), ["g_lang", "g_source", "salt"], "left").withColumn("distance2", _distance())
    kept = ~F.col("base_failed") & (F.coalesce("distance2", F.lit(0.0)) <= limit)
    return judged.select("row", *COUNTS, "base_failed", "distance2", kept.alias("kept"))
