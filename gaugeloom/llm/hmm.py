"""Hidden Markov language model over words, with exact likelihoods of whole texts.

A text is its words and one end. States emit word buckets (a checksum of the word, a bounded number
of them, so the parameters have a size that no corpus changes), and a bucket emits its words by their
corpus counts: P(text) = P(buckets | hidden Markov model) x product of P(word | bucket). Counts cover
every word of every training text. Baum-Welch rounds are one pass over all training texts each: tasks
run forward-backward over many texts at once and give expected counts, Spark sums them, and the driver
normalises a bounded table. The forward recursion of the scoring pass runs over each text whole.

Words that are frequent enough for a bounded table are looked up in the tasks; all others are joined
with the full table of counts.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.common import row_of, utf8
from gaugeloom.session import stage

STATES = 8
BUCKETS = 1 << 15
ROUNDS = 4
#: Frequent words kept in the tasks: at most so many, of at most so many bytes each.
TABLE_WORDS = 1 << 17
TABLE_BYTES = 64
#: Training runs of one text at most so long; scoring does not cut.
RUN = 512
BATCH_TOKENS = 1 << 19
COUNTED = 400_000
END = b"\n"  # no word holds white space
#: Part of each state's emissions that comes from the corpus's shares.
SMOOTH = 0.15


def bucket_of(word: bytes) -> int:
    return zlib.crc32(word) % BUCKETS


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        got = zlib.crc32(word) % BUCKETS
        if len(self) < COUNTED:
            self[word] = got
        return got


class Model:
    """Start, transition and emission probabilities; emission rows are buckets, the last is the end."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.parts = start, move, emit
        self.start, self.move, self.emit = self.parts
        self.settled = np.full(len(start), 1 / len(start))
        for _ in range(50):
            self.settled = self.settled @ move


class Columns:
    """Sequences side by side, longest first, so that each step works on a shrinking prefix."""

    def __init__(self, sequences: list[np.ndarray]) -> None:
        lengths = np.array([len(x) for x in sequences], np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        starts = np.cumsum(lengths) - lengths
        flat = np.concatenate([sequences[k] for k in self.order])
        steps = int(lengths[0]) if len(lengths) else 0
        self.active = np.searchsorted(-lengths, -np.arange(steps), side="left")
        self.first = np.concatenate([[0], np.cumsum(self.active)])
        step = np.repeat(np.arange(steps), self.active)
        rank = np.arange(self.first[-1]) - self.first[step]
        self.tokens = flat[starts[rank] + step]


def log10_likelihood(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Exact log10 probability of each bucket sequence by the scaled forward recursion."""
    side = Columns(sequences)
    total = np.zeros(len(sequences))
    a = None
    for t, n in enumerate(side.active):
        emit = model.emit[side.tokens[side.first[t] : side.first[t + 1]]]
        a = (model.start if a is None else a[:n] @ model.move) * emit
        scale = a.sum(axis=1)
        a /= scale[:, None]
        total[:n] += np.log10(scale)
    out = np.empty(len(sequences))
    out[side.order] = total
    return out


def expected_counts(
    model: Model, sequences: list[np.ndarray], fresh: list[bool]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected emissions, transitions and starts; runs that go on a text start from the settled state."""
    side = Columns(sequences)
    states = len(model.start)
    new = np.array(fresh, bool)[side.order]
    emit = model.emit[side.tokens]
    alpha, scales = np.empty_like(emit), np.empty(len(emit))
    a = None
    for t, n in enumerate(side.active):
        at = slice(side.first[t], side.first[t + 1])
        a = (np.where(new[:, None], model.start, model.settled) if a is None else a[:n] @ model.move) * emit[at]
        scales[at] = scale = a.sum(axis=1)
        a /= scale[:, None]
        alpha[at] = a
    emit /= scales[:, None]
    moves, ahead = np.zeros((states, states)), None
    back = model.move.T.copy()
    for t in range(len(side.active) - 1, -1, -1):
        at = slice(side.first[t], side.first[t + 1])
        now, m = alpha[at], 0 if ahead is None else len(ahead)
        w = emit[at].copy()
        if m:
            moves += now[:m].T @ ahead
            behind = ahead @ back
            now[:m] *= behind
            w[:m] *= behind
        ahead = w
    alpha /= alpha.sum(axis=1, keepdims=True)
    starts = alpha[: side.active[0]][new].sum(axis=0)
    emitted = np.stack([np.bincount(side.tokens, alpha[:, k], len(model.emit)) for k in range(states)], 1)
    return emitted, moves * model.move, starts


def _runs(ids: np.ndarray) -> list[np.ndarray]:
    return [ids[k : k + RUN] for k in range(0, len(ids), RUN)]


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over the column `text`, white space standing for the end of each text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for text in batch.column("text"):
                found.update(text.as_py().lower().split())
                if len(found) > COUNTED:
                    yield rows()
                    found = Counter()
            found[END] += batch.num_rows
        if found:
            yield rows()

    return texts.mapInArrow(each, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def encoded(texts: DataFrame) -> DataFrame:
    """Column `ids`: each text's buckets and the end, two bytes each."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets = _Buckets()
        for batch in batches:
            out = []
            for text in batch["text"]:
                words = text.lower().split()
                ids = np.full(len(words) + 1, BUCKETS, "<u2")
                ids[:-1] = np.fromiter(map(buckets.__getitem__, words), "<u2", len(words))
                out.append(ids.tobytes())
            yield pd.DataFrame({"ids": out})

    return texts.mapInPandas(each, "ids binary")


def _first_model(share: np.ndarray, states: int, seed: int) -> Model:
    """States that stay, each with its own random tilt of the buckets' shares."""
    rng = np.random.default_rng(seed)
    emit = share[:, None] * np.exp(rng.standard_normal((len(share), states)))
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


def _round(coded: DataFrame, model: Model, share: np.ndarray) -> Model:
    """One Baum-Welch round over the `ids` of all training texts."""
    states = len(model.start)
    names = [f"v{k}" for k in range(states)]
    shared = coded.sparkSession.sparkContext.broadcast(model.parts)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        now = Model(*shared.value)
        emitted, moves, starts = np.zeros_like(now.emit), np.zeros_like(now.move), np.zeros_like(now.start)
        held: list[np.ndarray] = []
        fresh: list[bool] = []
        size = 0

        def add() -> None:
            nonlocal held, fresh, size
            for total, part in zip((emitted, moves, starts), expected_counts(now, held, fresh)):
                total += part
            held, fresh, size = [], [], 0

        for batch in batches:
            for coded in batch["ids"]:
                ids = np.frombuffer(coded, "<u2").astype(np.int64)
                for k, run in enumerate(_runs(ids)):
                    held.append(run)
                    fresh.append(k == 0)
                    size += len(run)
                    if size >= BATCH_TOKENS:
                        add()
        if held:
            add()
        some = np.flatnonzero(emitted.any(axis=1))
        rows = pd.DataFrame(np.concatenate([emitted[some], moves, starts[None]]), columns=names)
        rows.insert(0, "key", np.concatenate([some, -1 - np.arange(states + 1)]))
        yield rows

    kind = "key long, " + ", ".join(f"{n} double" for n in names)
    sums = coded.mapInPandas(each, kind).groupBy("key").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    shared.unpersist()
    table = np.zeros((len(share) + states + 1, states))
    if len(sums):
        table[sums["key"].to_numpy(np.int64)] += sums[names].to_numpy()  # negative keys count from the end
    emit = table[: len(share)]
    emit = emit / np.maximum(emit.sum(axis=0), 1e-9) * (1 - SMOOTH) + SMOOTH * share[:, None]
    move = table[: -states - 2 : -1][:states] + 0.1
    start = table[-states - 1] + 0.1
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _frequent(counts: DataFrame) -> pd.DataFrame:
    """The words above a count that leaves at most `TABLE_WORDS` of them."""
    level = F.when(F.col("n") < 256, F.col("n").cast("double")).otherwise(256 + F.floor(16 * F.log2("n"))).cast("long")
    short = counts.filter((F.octet_length("word") <= TABLE_BYTES) & (F.col("word") != F.lit(END))).withColumn("level", level)
    sizes = short.groupBy("level").agg(F.count(F.lit(1)).alias("m")).toPandas().sort_values("level", ascending=False)
    fits = sizes[sizes["m"].cumsum() <= TABLE_WORDS]["level"]
    return short.filter(F.col("level") >= int(fits.min() if len(fits) else 1 << 40)).select("word", "n").toPandas()


def train(texts: DataFrame, counts: DataFrame, rounds: int = ROUNDS, states: int = STATES, seed: int = 11):
    """The model, and each bucket's log10 of its words' total weight, from all of `texts`."""
    by = counts.filter(F.col("word") != F.lit(END)).groupBy((F.crc32("word") % BUCKETS).alias("b"))
    found = by.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).toPandas()
    total, kinds = np.zeros(BUCKETS), np.zeros(BUCKETS)
    total[found["b"]], kinds[found["b"]] = found["n"], found["v"]
    weight = np.append(np.log10(total + 0.1 * (kinds + 1)), 0.0)
    ends = counts.filter(F.col("word") == F.lit(END)).agg(F.sum("n")).first()[0] or 0
    share = np.append(total, ends) + 0.1
    model = _first_model(share / share.sum(), states, seed)
    coded = stage(encoded(texts), "encoded") if rounds else None
    for _ in range(rounds):
        model = _round(coded, model, share / share.sum())
    return model, weight


def hmm_scores(docs: DataFrame, training: str, carry: list[str], text: str = "text", **how) -> DataFrame:
    """Score all rows with a model of those where column `training` is true.

    Columns `carry` as struct `row`, `n_tokens`, `n_known`, `train_tokens`, `base_score` and `score`, both
    log10. Words are lower-cased from A to Z and parted by ASCII white space; the end is a token. The
    base is the smoothed share of each token by itself; the score is the hidden Markov model's. A word
    that no training text has takes its bucket's slot for unknown words. NULL text counts as empty: its
    end alone. Repeated rows count as often as they are there. Without training rows scores come from
    even shares; an empty table gives an empty result.
    """
    docs_text = docs.select(row_of(docs, carry).alias("row"), F.col(training).alias("train"), utf8(text).alias("text"))
    texts = docs_text.filter("train").select("text")
    counts = stage(word_counts(texts), "counts")
    n, v = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    ends = counts.filter(F.col("word") == F.lit(END)).agg(F.sum("n")).first()[0] or 0
    n, norm = n or 0, float(np.log10((n or 0) + 0.1 * (v + 1)))
    model, weight = train(texts, counts, **how)
    often = _frequent(counts)
    words = [bytes(w) for w in often["word"]]
    known = {
        "rows": {w: k for k, w in enumerate(words)},
        "log": np.log10(often["n"].to_numpy(np.float64) + 0.1),
        "bucket": np.array([bucket_of(w) for w in words], np.int64),
    }
    shared = docs.sparkSession.sparkContext.broadcast((model.parts, weight, known))
    row = docs_text.schema["row"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, weight, known = shared.value
        model, find = Model(*parts), known["rows"].get
        for batch in batches:
            ids, size, have, logs, rare, many, ends_at = [], [], [], [], [], [], [0]
            first = 0

            def done(last: int) -> pa.RecordBatch:
                score = log10_likelihood(model, ids) - np.array([weight[x].sum() for x in ids])
                lists = pa.ListArray.from_arrays(
                    pa.array(ends_at, pa.int32()),
                    pa.StructArray.from_arrays([pa.array(rare, pa.binary()), pa.array(many, pa.int64())], ["word", "k"]),
                )
                own = batch.column("row").slice(first, last - first)
                return pa.RecordBatch.from_arrays(
                    [own, pa.array(size, pa.int64()), pa.array(have, pa.int64()), pa.array(logs, pa.float64()),
                     pa.array(score, pa.float64()), lists],
                    ["row", "n_tokens", "have", "logs", "hmm", "rare"],
                )

            held = 0
            for k, text in enumerate(batch.column("text")):
                tokens = text.as_py().lower().split()
                at = np.fromiter((find(w, -1) for w in tokens), np.int64, len(tokens))
                seen = at >= 0
                one = np.full(len(tokens) + 1, BUCKETS, np.int64)
                one[:-1][seen] = known["bucket"][at[seen]]
                new = np.flatnonzero(~seen)
                unseen = [tokens[j] for j in new]
                one[new] = [bucket_of(w) for w in unseen]
                ids.append(one)
                size.append(len(one))
                have.append(int(seen.sum()))
                logs.append(float(known["log"][at[seen]].sum()))
                other = Counter(unseen)
                rare.extend(other)
                many.extend(other.values())
                ends_at.append(len(rare))
                held += len(one)
                if held >= 4 * BATCH_TOKENS or k == batch.num_rows - 1:
                    yield done(k + 1)
                    ids, size, have, logs, rare, many, ends_at = [], [], [], [], [], [], [0]
                    first, held = k + 1, 0

    kind = (
        f"row {row}, n_tokens long, have long, logs double, hmm double, rare array<struct<word: binary, k: long>>"
    )
    part = docs_text.select("row", "text").mapInArrow(each, kind)
    part = stage(part.withColumn("uid", F.monotonically_increasing_id()), "scored")
    other = part.select("uid", F.explode("rare").alias("r")).select("uid", "r.word", "r.k")
    c = F.coalesce("n", F.lit(0))
    more = (
        other.join(counts, "word", "left")
        .groupBy("uid")
        .agg(F.sum(F.col("k") * F.log10(c + 0.1)).alias("more"), F.sum(F.when(c > 0, F.col("k"))).alias("found"))
    )
    by_count = F.col("logs") + F.coalesce("more", F.lit(0.0))
    n_known = F.col("have") + F.coalesce("found", F.lit(0)) + F.lit(int(ends > 0))
    return part.join(more, "uid", "left").select(
        "row", "n_tokens", n_known.alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"),
        (by_count + float(np.log10(ends + 0.1)) - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("hmm") + by_count).alias("score"),
    )
