"""Phrase collocations by the stripes pattern.

A prefix of words keys a stripe, an associative counter of the words that come next. Tasks build the
stripes of their texts chunk by chunk, a shuffle brings the stripes of a prefix together, and they are merged
elementwise. The empty prefix's stripe counts words; a two-word prefix's stripe, which also counts the places
where a piece ends, gives by its total how often the two words stand together, by its entries how often each
extension does, and by its largest entry whether an extension subsumes the prefix. Stripes travel many to a
row, by bucket of their prefix; a stripe whose two words are both among the few heavy words of the corpus is
spread over buckets by its next words as well, so no prefix is one task's work.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.llm.common import n_bytes, utf8
from gaugeloom.session import stage

#: Tokens whose stripes are built at once.
CHUNK = 1 << 19
#: Different words a task counts before it gives its counts out.
DISTINCT = 300_000
#: A word is heavy from this share of all words on, so there are at most 1 / HEAVY of them.
HEAVY = 1 / 2048
#: Buckets that a heavy prefix's next words are dealt over, and bytes of text for each bucket.
SPREAD = 64
BUCKET_BYTES = 8 << 20
LEAST_BUCKETS = 64
#: Stands for the end of a piece among tokens; the text's own signs of that kind all become it.
STOP = b"."

_SIGNS = bytes(
    STOP[0] if b in b".,;:!?\n\v\f\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


def tokens(text: bytes) -> list[bytes]:
    """Words of all pieces in order, A-Z lower-cased, with a `STOP` wherever a piece ends."""
    return (text.translate(_SIGNS).replace(STOP, b" . ") + b" .").split()


class _Ids(dict):
    """Numbers of one language's words in a numbering that languages share; 0 is the stop."""

    def __init__(self, lang: str, names: list[bytes], langs: list[str]) -> None:
        super().__init__({STOP: 0})
        self.lang, self.names, self.langs = lang, names, langs

    def __missing__(self, word: bytes) -> int:
        self[word] = got = len(self.names)
        self.names.append(word)
        self.langs.append(self.lang)
        return got


class _Vocabulary:
    """Words of several languages under one numbering."""

    def __init__(self) -> None:
        self.names, self.langs = [STOP], [""]
        self.by_lang: dict[str, _Ids] = {}

    def numbers(self, lang: str, text: bytes) -> np.ndarray:
        ids = self.by_lang.get(lang)
        if ids is None:
            ids = self.by_lang[lang] = _Ids(lang, self.names, self.langs)
        found = tokens(text)
        return np.fromiter(map(ids.__getitem__, found), np.int64, len(found))


def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, f): the merged stripe of the empty prefix. `rows` has columns lang and text (bytes)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, parts, size = _Vocabulary(), np.zeros(0, np.int64), [], 0

        def summed() -> np.ndarray:
            own = np.bincount(np.concatenate([*parts, np.zeros(1, np.int64)]), minlength=len(words.names))
            own[: len(counts)] += counts
            return own

        def out() -> pa.RecordBatch:
            columns = [pa.array(words.langs[1:], pa.string()), pa.array(words.names[1:], pa.binary()).cast(pa.string())]
            return pa.RecordBatch.from_arrays([*columns, pa.array(counts[1:])], ["lang", "word", "f"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                parts.append(words.numbers(lang, text.as_py()))
                size += len(parts[-1])
                if size >= CHUNK:
                    counts, parts, size = summed(), [], 0
                    if len(words.names) > DISTINCT:
                        yield out()
                        words, counts = _Vocabulary(), np.zeros(0, np.int64)
        counts = summed()
        if len(words.names) > 1:
            yield out()

    found = rows.mapInArrow(each, "lang string, word string, f long")
    return found.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _stripes(
    parts: list[np.ndarray], words: _Vocabulary, heavy: set[tuple[str, bytes]], buckets: int
) -> pa.RecordBatch | None:
    """The stripes of all two-word prefixes of a chunk, as rows of a bucket and a language.

    A row holds its stripes' entries as three arrays' bytes: the lengths of `prefix next`, these texts end to end,
    and their counts. Of each part the last two tokens only follow others.
    """
    token = np.concatenate(parts)
    ends = np.cumsum([len(p) for p in parts])
    starts = np.ones(len(token), bool)
    starts[ends - 1] = starts[ends - 2] = False
    at = np.flatnonzero(starts)
    at = at[(token[at] > 0) & (token[at + 1] > 0)]
    if not len(at):
        return None
    pair, rank = np.unique(token[at] << 32 | token[at + 1], return_inverse=True)
    entry, count = np.unique(rank.ravel() << 32 | token[at + 2], return_counts=True)
    prefix, after = entry >> 32, entry & 0xFFFFFFFF
    first, second = pair >> 32, pair & 0xFFFFFFFF
    kinds = sorted(words.by_lang)
    place = {x: k for k, x in enumerate(kinds)}
    lang = np.array([place.get(x, 0) for x in words.langs], np.int64)
    mark = np.array([zlib.crc32(w, zlib.crc32(x.encode())) for w, x in zip(words.names, words.langs)], np.uint64)
    common = np.array([(x, w) in heavy for w, x in zip(words.names, words.langs)])
    home = (mark[first] * np.uint64(0x9E3779B97F4A7C15) ^ mark[second] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(20)
    far = (common[first] & common[second])[prefix]
    bucket = home[prefix] + np.where(far, 1 + mark[after] % np.uint64(SPREAD), 0).astype(np.uint64)
    bucket = (bucket % np.uint64(buckets)).astype(np.int64)
    row = (bucket * len(kinds) + lang[first][prefix]) * 2 + far
    order = np.argsort(row, kind="stable")
    row, prefix, after, count = row[order], prefix[order], after[order], count[order].astype(np.int32)
    cuts = np.r_[np.flatnonzero(np.r_[True, row[1:] != row[:-1]]), len(row)]
    names = pa.array(words.names, pa.binary())
    told = pc.binary_join_element_wise(names.take(pa.array(first)), names.take(pa.array(second)), b" ")
    told = pc.binary_join_element_wise(told.take(pa.array(prefix)), names.take(pa.array(after)), b" ")
    offsets = np.frombuffer(told.buffers()[1], np.int32)[: len(told) + 1]
    data, length = told.buffers()[2].to_pybytes(), np.diff(offsets)
    spans = [(int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:])]
    key = row[cuts[:-1]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array((key // 2 // len(kinds)).astype(np.int32)),
            pa.array(key % 2 == 1),
            pa.array(kinds, pa.string()).take(pa.array(key // 2 % len(kinds))),
            pa.array([length[a:b].tobytes() for a, b in spans], pa.binary()),
            pa.array([data[offsets[a] : offsets[b]] for a, b in spans], pa.binary()),
            pa.array([count[a:b].tobytes() for a, b in spans], pa.binary()),
        ],
        ["bucket", "far", "lang", "lengths", "entries", "counts"],
    )


def _merged(held: list[tuple[bytes, bytes, bytes]], far: bool, lang: str, least: int) -> pa.RecordBatch | None:
    """The stripes of one bucket and language, merged elementwise."""
    offsets = np.r_[0, np.cumsum(np.frombuffer(b"".join(x[0] for x in held), np.int32), dtype=np.int64)]
    told = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(x[1] for x in held))]
    ).dictionary_encode()
    count = np.zeros(len(told.dictionary), np.int64)
    np.add.at(count, told.indices.to_numpy(), np.frombuffer(b"".join(x[2] for x in held), np.int32))
    parts = pc.extract_regex(told.dictionary.cast(pa.large_string()), r"^(?P<prefix>[^ ]+ [^ ]+) (?P<next>.+)$")
    prefix, after = parts.field("prefix").dictionary_encode(), parts.field("next")
    of = prefix.indices.to_numpy()
    total = np.zeros(len(prefix.dictionary), np.int64)
    np.add.at(total, of, count)
    kept = np.flatnonzero((total >= least) | far)
    if not len(kept):
        return None
    number = np.full(len(total), -1, np.int64)
    number[kept] = np.arange(len(kept))
    large = np.flatnonzero((count >= least) & (number[of] >= 0) & pc.not_equal(after, STOP.decode()).to_numpy(zero_copy_only=False))
    large = large[np.argsort(number[of[large]], kind="stable")]
    cuts = np.searchsorted(number[of[large]], np.arange(len(kept) + 1))
    flat = pa.StructArray.from_arrays(
        [after.take(pa.array(large)).cast(pa.string()), pa.array(count[large])], ["next", "c"]
    )
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(kept), far)), pa.array([lang] * len(kept), pa.string()),
            prefix.dictionary.take(pa.array(kept)).cast(pa.string()), pa.array(total[kept]),
            pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), flat),
        ],
        ["far", "lang", "prefix", "total", "next"],
    )


def prefix_stripes(rows: DataFrame, heavy: set[tuple[str, bytes]], buckets: int, least: int) -> DataFrame:
    """(far, lang, prefix, total, next): merged stripes of two-word prefixes with their total.

    `next` holds the entries (next, c) of at least `least`. Stripes with a smaller total are left out but for
    those of heavy prefixes (`far`), which have a row for each bucket they were dealt over. A task merges one
    bucket's stripes of a language at a time, those of about `BUCKET_BYTES` of text.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, parts, size = _Vocabulary(), [], 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                body = np.r_[words.numbers(lang, text.as_py()), 0]
                for at in range(0, max(1, len(body) - 2), CHUNK):
                    parts.append(body[at : at + CHUNK + 2])
                    size += len(parts[-1])
                    if size >= CHUNK:
                        found = _stripes(parts, words, heavy, buckets)
                        if found is not None:
                            yield found
                        parts, size = [], 0
                if not size:
                    words = _Vocabulary()
        found = _stripes(parts, words, heavy, buckets) if parts else None
        if found is not None:
            yield found

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bucket", "far", "lang")]
            for k, now in enumerate(zip(*columns)):
                if now != key and held:
                    found = _merged(held, key[1], key[2], least)
                    if found is not None:
                        yield found
                    held = []
                key = now
                held.append(tuple(batch.column(c)[k].as_py() for c in ("lengths", "entries", "counts")))
        found = _merged(held, key[1], key[2], least) if held else None
        if found is not None:
            yield found

    kind = "bucket int, far boolean, lang string, lengths binary, entries binary, counts binary"
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # buckets go round the tasks by number: hashed, some tasks would get many
    dealt = rows.mapInArrow(build, kind).repartitionById(tasks, F.col("bucket") % tasks)
    dealt = dealt.sortWithinPartitions("bucket", "far", "lang")
    kind = "far boolean, lang string, prefix string, total long, next array<struct<next: string, c: long>>"
    return dealt.mapInArrow(merge, kind)


def _with_count(rows: DataFrame, word: str, out: str, words: DataFrame, heavy: DataFrame) -> DataFrame:
    """`rows` with the count of the word in column `word` as column `out`.

    Heavy words, at most 1 / `HEAVY` rows, are looked up in every task; all others are joined, and rows of
    heavy words, which find nothing there, are dealt over keys that no word has.
    """
    known = heavy.select("lang", F.col("word").alias(word), F.col("f").alias("_heavy"))
    salt = F.concat(F.lit(" "), F.pmod(F.xxhash64(*rows.columns), F.lit(1024)).cast("string"))
    asked = rows.join(F.broadcast(known), ["lang", word], "left").withColumn(
        "_word", F.when(F.col("_heavy").isNull(), F.col(word)).otherwise(salt)
    )
    joined = asked.join(words.select("lang", F.col("word").alias("_word"), "f"), ["lang", "_word"], "left")
    return joined.withColumn(out, F.coalesce("_heavy", "f")).drop("_heavy", "_word", "f")


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in exact arithmetic; at most 1000000, as a is the least."""
    number = lambda c: f"cast({c} as decimal(15, 0))"
    return F.expr(f"(cast(1000000 as decimal(8, 0)) * {number(a)} * {number(a)}) div ({number(left)} * {number(right)})")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, covered: int = 50, top: int = 2000
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases of two or three words.

    Texts are lower-cased (A-Z) and cut at `.,;:!?` and line ends; words are what spaces and tabs part, and
    phrases lie within a piece. A phrase with a count a of at least `least` is a candidate; of its cuts the one
    with the lowest score counts, the first of equal ones. A candidate is dropped if a longer candidate that
    holds it has at least `covered` percent of its count. Order is by score and count downwards, then by phrase
    in byte order; n is the number of the language's words. NULL text counts as empty, NULL language as
    `und`. Every row counts, repeated ones too. An empty table gives no phrases. A text's words are held
    whole in one task, its stripes are built `CHUNK` tokens at a time.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), utf8(text).alias("text"))
    size = docs.agg(F.sum(n_bytes(text))).first()[0] or 0
    words = stage(word_counts(rows), "words")
    sums = stage(words.groupBy("lang").agg(F.sum("f").alias("n")), "sums")
    n = sums.agg(F.sum("n")).first()[0] or 0
    heavy = words.filter(F.col("f") >= max(n * HEAVY, 1))
    few = {(r["lang"], r["word"].encode()) for r in heavy.select("lang", "word").collect()}  # at most 1 / HEAVY rows
    words = words.filter(F.col("f") >= least)

    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    stripes = stage(prefix_stripes(rows, few, buckets, least), "stripes")
    most = F.coalesce(F.array_max(F.transform("next", lambda x: x["c"])), F.lit(0))
    pairs = stripes.groupBy("lang", "prefix").agg(F.sum("total").alias("a"), F.max(most).alias("most"))
    pairs = stage(pairs.filter(F.col("a") >= least), "pairs")
    triples = stripes.select("lang", "prefix", F.inline("next"))

    cut = lambda c, k: F.substring_index(c, " ", k)
    triples = triples.select(
        "lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), F.col("c").alias("a"), cut("prefix", 1).alias("w1"),
        F.col("next").alias("w2"), "prefix", F.concat_ws(" ", cut("prefix", -1), "next").alias("suffix"),
    )
    triples = triples.join(pairs.select("lang", "prefix", F.col("a").alias("f12")), ["lang", "prefix"])
    triples = triples.join(pairs.select("lang", F.col("prefix").alias("suffix"), F.col("a").alias("f23")), ["lang", "suffix"])
    triples = stage(triples, "triples")
    inside = triples.groupBy("lang", F.col("suffix").alias("prefix")).agg(F.max("a").alias("before"))
    free = pairs.join(inside, ["lang", "prefix"], "left").filter(
        100 * F.greatest("most", F.coalesce("before", F.lit(0))) < covered * F.col("a")
    )
    twos = free.select(
        "lang", F.col("prefix").alias("phrase"), "a", cut("prefix", 1).alias("w1"), cut("prefix", -1).alias("w2"),
        F.lit(None).cast("long").alias("f12"), F.lit(None).cast("long").alias("f23"),
    )
    told = twos.unionByName(triples.drop("prefix", "suffix"))
    for word, out in (("w1", "f1"), ("w2", "f2")):
        told = _with_count(told, word, out, words, heavy)
    first = F.struct(
        _score("a", "f1", "coalesce(f23, f2)").alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"),
        F.coalesce("f23", "f2").alias("r"),
    )
    second = F.when(
        F.col("f12").isNotNull(),
        F.struct(_score("a", "f12", "f2").alias("score"), F.lit(2).alias("k"), F.col("f12").alias("l"), F.col("f2").alias("r")),
    )
    scored = told.select("lang", "phrase", "a", F.least(first, second).alias("cut")).select("lang", "phrase", "a", "cut.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return best.join(sums, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
