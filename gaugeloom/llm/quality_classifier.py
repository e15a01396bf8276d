"""Quality classifier: random-indexing word vectors, pooled, under a small calibrated network.

Every word has a sparse index vector of plus and minus ones, drawn by the hash of the word and of its shape;
a word's vector is the sum of the index vectors around it over the whole corpus (exact integer sums). The
most frequent words, at most `WORDS`, have their vectors in a table of bounded size, which tasks look up. A rarer
word's surroundings are nearly all in the text at hand, so there its vector is summed up on the spot. A
document is the mean vector of its frequent words beside that of its rare ones, and a two-layer network with
a temperature fitted on rows it did not learn from turns that into a probability. The network is fitted on
the driver on at most `SAMPLE` labelled documents; everything else covers all rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.common import utf8
from gaugeloom.session import stage

#: Words with a vector in the table, and rows of the pools that index vectors are drawn from.
WORDS = 1 << 15
POOL = 1 << 16
SHAPES = 1 << 9
DIMS = 64
NONZERO = 4
WINDOW = 2
#: Words worked on at once, bytes of a text that are split at once.
CHUNK = 50_000
SLICE = 1 << 18
#: Words whose codes a task keeps, and different words it counts before it gives its counts out.
REMEMBERED = 250_000
DISTINCT = 300_000
#: Labelled documents the network learns from at most, those with the lowest hash of their id.
SAMPLE = 20_000
HIDDEN = 32
#: A document is predicted to be good from this score on.
KEEP_FROM = 0.3
EPOCHS = 60

_KIND = bytes(
    97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256)
)
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)
_SPACE = re.compile(rb"[ \t-\r]")


def word_shape(kinds: bytes) -> bytes:
    """The kinds of a word's signs, runs of one collapsed, eight at most."""
    return _RUNS.sub(rb"\1", kinds)[:8]


class _Shapes(dict):
    """Numbers of shapes by the kinds of a word's signs: letters, capitals and digits as a, A and 0."""

    def __missing__(self, kinds: bytes) -> int:
        got = zlib.crc32(word_shape(kinds)) % SHAPES
        if len(self) < REMEMBERED and len(kinds) < 64:
            self[kinds] = got
        return got


def slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, those of some `SLICE` bytes at a time."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + SLICE)
        to = cut.start() if cut else len(text)
        yield text[at:to].split()
        at = to


class _Codes(dict):
    """Numbers that hold a word's row in the table (`WORDS` if rare), its pool row and its shape."""

    def __init__(self, known: dict[bytes, int]) -> None:
        self.shapes = _Shapes()
        super().__init__((word, row * POOL * SHAPES + self._index(word)) for word, row in known.items())

    def _index(self, word: bytes) -> int:
        return zlib.crc32(word) % POOL * SHAPES + self.shapes[word.translate(_KIND)]

    def __missing__(self, word: bytes) -> int:
        got = WORDS * POOL * SHAPES + self._index(word)
        if len(self) < REMEMBERED:
            self[word] = got
        return got


@cache
def index_vectors(seed: int = 23) -> tuple[np.ndarray, np.ndarray]:
    """Sparse vectors of plus and minus ones: the pool of words, and of shapes and shapes of repeated words.
    The last row of each is zero; it stands for the gap between texts."""
    rng, out = np.random.default_rng(seed), []
    for rows in (POOL, 2 * SHAPES):
        pool = np.zeros((rows + 1, DIMS), np.int8)
        places = np.argsort(rng.random((rows, DIMS), np.float32), axis=1)[:, :NONZERO]
        pool[np.arange(rows)[:, None], places] = rng.choice(np.array([-1, 1], np.int8), (rows, NONZERO))
        out.append(pool)
    return out[0], out[1]


def _parts(texts: Iterator[bytes], codes: _Codes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words of texts laid end to end, some `CHUNK` at a time: text number, row, and the sum of the index
    vectors within `WINDOW` words of the same text. A word like the one before it counts as a rare one, since
    what lies around it there says more than its usual surroundings. A text of any length takes as many parts
    as it needs."""
    pool, forms = index_vectors()
    gap = np.full(WINDOW, -1, np.int64)
    before = WINDOW + 1  # one word more than the window, so that its first word knows the one before it
    code, text = [gap[:1], gap], [gap[:1], gap]
    size = before

    def sums(done: bool) -> tuple[np.ndarray, ...]:
        """The inner words of what is held; the outer ones only lie around them."""
        flat, own = np.concatenate([*code, *([gap] if done else [])]), np.concatenate([*text, *([gap] if done else [])])
        again = np.zeros(len(flat), np.int64)
        again[1:] = (flat[1:] == flat[:-1]) & (own[1:] == own[:-1])
        away = flat < 0
        index = pool[np.where(away, POOL, flat // SHAPES % POOL)]
        index += forms[np.where(away, 2 * SHAPES, flat % SHAPES + SHAPES * again)]
        near = np.zeros_like(index)
        for k in range(1, WINDOW + 1):
            near[k:] += index[:-k]
            near[:-k] += index[k:]
        inner = np.arange(before, len(flat) - WINDOW)
        inner = inner[~away[inner]]
        row = np.where(again[inner], WORDS, flat[inner] // (POOL * SHAPES))
        return flat, own, (own[inner], row, near[inner])

    for number, body in enumerate(texts):
        for words in slices(body):
            for at in range(0, len(words), CHUNK):
                some = words[at : at + CHUNK]
                code.append(np.fromiter(map(codes.__getitem__, some), np.int64, len(some)))
                text.append(np.full(len(some), number))
                size += len(some)
                if size >= CHUNK:
                    flat, own, found = sums(False)
                    yield found
                    code, text = [flat[-before - WINDOW :]], [own[-before - WINDOW :]]
                    size = before + WINDOW
        code.append(gap)
        text.append(gap)
        size += WINDOW
    yield sums(True)[2]


def add_contexts(table: np.ndarray, part: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
    """Add to each frequent word's row what lies around its places."""
    _, row, near = part
    some = np.flatnonzero(row < WORDS)
    order = some[np.argsort(row[some].astype(np.uint16), kind="stable")]
    own = row[order]
    if len(own):
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        table[own[first]] += np.add.reduceat(near[order], first, axis=0, dtype=np.int32)


def frequent_words(docs: DataFrame, text: str, most: int = WORDS) -> dict[bytes, int]:
    """Row of each of the most frequent words, counted over all texts: those above the lowest limit, in steps of
    an eighth of a power of two, that leaves at most `most`."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter[bytes] = Counter()
        out = lambda: pa.RecordBatch.from_arrays(
            [pa.array(count.keys(), pa.binary()), pa.array(count.values(), pa.int64())], ["word", "n"]
        )
        for batch in batches:
            for body in batch.column("text"):
                for words in slices(body.as_py()):
                    count.update(words)
                if len(count) > DISTINCT:
                    yield out()
                    count.clear()
        yield out()

    counts = docs.select(utf8(text).alias("text")).mapInArrow(each, "word binary, n long")
    step = F.floor(8 * F.log2(F.col("n").cast("double"))).alias("step")
    words = stage(counts.groupBy("word").agg(F.sum("n").alias("n")).select("word", step), "words")
    left, limit = most, 1 << 10
    for r in words.groupBy("step").count().orderBy(F.desc("step")).collect():  # at most 512 rows
        left -= r["count"]
        if left < 0:
            break
        limit = r["step"]
    known = words.filter(F.col("step") >= limit).select("word").toArrow()["word"].to_pylist()
    return {word: k for k, word in enumerate(sorted(known))}


def context_table(docs: DataFrame, text: str, known: dict[bytes, int]) -> np.ndarray:
    """Context sums of the words `known`: one long for each row and dimension, of a size no corpus changes."""
    names = [f"v{k}" for k in range(DIMS)]
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, table = _Codes(shared.value), np.zeros((WORDS, DIMS), np.int64)
        for part in _parts((body.as_py() for batch in batches for body in batch.column("text")), codes):
            add_contexts(table, part)
        some = np.flatnonzero(table.any(axis=1))
        columns = [pa.array(some), *(pa.array(table[some, k]) for k in range(DIMS))]
        yield pa.RecordBatch.from_arrays(columns, ["key", *names])

    found = docs.select(utf8(text).alias("text")).mapInArrow(each, "key long, " + ", ".join(f"{n} long" for n in names))
    sums = found.groupBy("key").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    table, key = np.zeros((WORDS, DIMS)), sums["key"].to_numpy()
    for k, name in enumerate(names):
        table[key, k] = sums[name].to_numpy()
    shared.destroy()
    return table


def word_vectors(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows, after the corpus's mean direction is taken out, and that direction; rare rows stay short."""
    mean = table.sum(axis=0)
    mean /= max(np.linalg.norm(mean), 1e-9)
    rest = table - np.outer(table @ mean, mean)
    rest /= np.linalg.norm(rest, axis=1, keepdims=True) + 20
    return rest.astype(np.float32), mean


def pooled(texts: list[bytes], vectors: np.ndarray, mean: np.ndarray, codes: _Codes) -> np.ndarray:
    """Mean vector of a text's frequent words beside that of its rare ones; zeros where there are none.

    A rare word's vector is what lies around it in the text, without the mean direction.
    """
    sums, count = np.zeros((len(texts), 2, DIMS)), np.zeros((len(texts), 2))
    for text, row, near in _parts(iter(texts), codes):
        for half, some in enumerate((np.flatnonzero(row < WORDS), np.flatnonzero(row >= WORDS))):
            if not len(some):
                continue
            own = text[some]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            what, kind = (near[some], np.int32) if half else (vectors[row[some]], np.float32)
            sums[own[first], half] += np.add.reduceat(what, first, axis=0, dtype=kind)
            count[own[first], half] += np.diff(np.r_[first, len(own)])
    sums /= np.maximum(count, 1)[:, :, None]
    sums[:, 1] -= np.outer(sums[:, 1] @ mean, mean)
    return sums.reshape(len(texts), 2 * DIMS).astype(np.float32)


class Network:
    """Standardised inputs, tanh layer, one output, divided by a temperature."""

    def __init__(self, inputs: np.ndarray, labels: np.ndarray, check: np.ndarray, seed: int = 29) -> None:
        """`check` marks the rows that only the temperature sees."""
        rng = np.random.default_rng(seed)
        self.mean = inputs.mean(axis=0, dtype=np.float64)
        self.spread = inputs.std(axis=0, dtype=np.float64) + 1e-6
        width = inputs.shape[1]
        self.parts = [
            rng.standard_normal((width, HIDDEN)) / np.sqrt(width), np.zeros(HIDDEN),
            rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1),
        ]
        self.temperature = 1.0
        x, y = self._scaled(inputs), labels.astype(np.float64)
        self._fit(x[~check], y[~check], rng)
        if check.any():
            z = self._logit(x[check])
            tried = np.geomspace(0.25, 8, 81)
            loss = [np.logaddexp(0, np.where(y[check] > 0, -z / t, z / t)).mean() for t in tried]
            self.temperature = float(tried[int(np.argmin(loss))])

    def _scaled(self, inputs: np.ndarray) -> np.ndarray:
        scaled = inputs - self.mean.astype(inputs.dtype)
        scaled /= self.spread.astype(inputs.dtype)
        return np.clip(scaled, -8, 8, out=scaled)

    def _logit(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.parts
        return np.tanh(x @ w + b) @ v + c[0]

    def _fit(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        """Adam on the log loss with a little weight decay."""
        one, two, step = [np.zeros_like(p) for p in self.parts], [np.zeros_like(p) for p in self.parts], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), 256):
                some = order[at : at + 256]
                w, b, v, c = self.parts
                hidden = np.tanh(x[some] @ w + b)
                off = (1 / (1 + np.exp(-np.clip(hidden @ v + c[0], -40, 40))) - y[some]) / len(some)
                down = np.outer(off, v) * (1 - hidden**2)
                slopes = [x[some].T @ down + 1e-3 * w, down.sum(axis=0), hidden.T @ off + 1e-3 * v, np.array([off.sum()])]
                step += 1
                for k, g in enumerate(slopes):
                    one[k] = 0.9 * one[k] + 0.1 * g
                    two[k] = 0.999 * two[k] + 0.001 * g * g
                    rate = 0.003 / (1 - 0.9**step)
                    self.parts[k] = self.parts[k] - rate * one[k] / (np.sqrt(two[k] / (1 - 0.999**step)) + 1e-8)

    def probability(self, inputs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._logit(self._scaled(inputs)) / self.temperature, -40, 40)))


class QualityModel:
    """Word vectors and network, fitted once, to score any rows with."""

    def __init__(
        self, docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
        sample: int = SAMPLE,
    ) -> None:
        """Word vectors are of all texts of `docs`; the network learns from those of them that have labels."""
        marked = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id"))
        marked = marked.agg(F.min(label).alias("y"), F.max(label).alias("most")).filter("y = most")
        chosen = marked.select("id", "y", F.xxhash64("id").alias("h")).orderBy("h", "id").limit(sample)
        known = frequent_words(docs, text)
        vectors, mean = word_vectors(context_table(docs, text, known))
        self.shared = docs.sparkSession.sparkContext.broadcast((known, vectors, mean))
        own = docs.select(F.col(doc_id).alias("id"), utf8(text).alias("text"))
        own = own.join(F.broadcast(chosen), "id").groupBy("id", "y", "h").agg(F.min("text").alias("text"))
        rows = own.select("id", "y", "h", self.vector("text").alias("x")).toArrow().sort_by([("h", "ascending"), ("id", "ascending")])
        self.network = None
        if len(rows):
            check = np.arange(len(rows)) % 5 == 4
            inputs = rows["x"].combine_chunks().flatten().to_numpy().reshape(len(rows), 2 * DIMS)
            self.network = Network(inputs, rows["y"].to_numpy(), check)

    def vector(self, text: str) -> Column:
        """The pooled vector of a text column."""
        shared = self.shared

        @F.pandas_udf("array<float>")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known, vectors, mean = shared.value
            codes = _Codes(known)
            for texts in batches:
                yield pd.Series(list(pooled(list(texts), vectors, mean, codes)))

        return of(utf8(text))

    def score(self, text: str = "text") -> Column:
        """The calibrated probability of label 1 of a text column; 0.5 where nothing was learned from."""
        shared, network = self.shared, self.network
        if network is None:
            return F.lit(0.5)

        @F.pandas_udf("double")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known, vectors, mean = shared.value
            codes = _Codes(known)
            for texts in batches:
                yield pd.Series(network.probability(pooled(list(texts), vectors, mean, codes).astype(np.float64)))

        return of(utf8(text))


def quality_score(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
    sample: int = SAMPLE,
) -> Column:
    """The calibrated probability of label 1 as a column of `docs`, trained on `docs` and `labels`.

    The network learns from at most `sample` documents with a label of 0 or 1, those of lowest id hash;
    ids labelled both ways or NULL are left out, and of rows that share an id one text is used. NULL text
    counts as empty; texts without words get the network's answer to a zero vector. Without labels
    every score is 0.5. Repeated rows get equal scores. Very long texts are worked through `SLICE` bytes and
    `CHUNK` words at a time, so beside the text itself a task's memory does not grow with them.
    """
    return QualityModel(docs, labels, text, doc_id, label, sample).score(text)
