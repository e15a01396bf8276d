"""Packing along a space-filling curve.

A document's hashed word vector is projected to three dimensions and cut into cells, and the Hilbert
key of its cell says where on the curve it lies. Rows are dealt out by ranges of the key that hold about
equal bytes of text; each task sorts its range, encodes the texts and cuts the stream of ids into full
sequences, so neighbours on the curve share sequences and only the last sequence of a range needs padding.
A bin of the curve that holds more than a range, such as copies of one text or one row repeated, is dealt
row by row over as many ranges as its bytes fill.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.common import n_bytes, row_of, utf8
from gaugeloom.llm.word_bpe import WordEncoder
from gaugeloom.session import stage

SEQUENCE = 4096
END = 2
DIMS = 3
CELL_BITS = 10
HASHED = 256
RANGE_BYTES = 32 << 20
#: Bins of the curve whose bytes are counted to cut it into ranges: 2 ** BIN_BITS rows come to the driver.
BIN_BITS = 16
REMEMBERED = 500_000
BATCH_BYTES = 8 << 20


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers below 2**bits (Skilling's transform)."""
    x = cells.astype(np.int64).copy()
    n, dims = x.shape
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(dims):
            high = (x[:, i] & q) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & (q - 1))
            x[:, 0] ^= np.where(high, q - 1, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(n, np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[:, dims - 1] & q, q - 1, 0)
        q >>= 1
    x ^= turn[:, None]
    key = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = got = zlib.crc32(word) & (2 * HASHED - 1)
        return got


def curve_key(text: str, seed: int = 3) -> Column:
    """Hilbert key of a text column: words hashed with a sign into a vector, three random directions."""
    project = np.random.default_rng(seed).standard_normal((HASHED, DIMS))

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        buckets = _Buckets()
        for texts in batches:
            vectors = np.zeros((len(texts), HASHED))
            for i, text in enumerate(texts):
                words = text.lower().split()
                if len(buckets) > REMEMBERED:
                    buckets.clear()
                at = np.fromiter(map(buckets.__getitem__, words), np.int64, len(words))
                both = np.bincount(at, minlength=2 * HASHED)
                vectors[i] = both[:HASHED] - both[HASHED:]
            length = np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
            place = 1 / (1 + np.exp(-1.7 * (vectors / length) @ project))
            cells = np.minimum((place * (1 << CELL_BITS)).astype(np.int64), (1 << CELL_BITS) - 1)
            yield pd.Series(hilbert_keys(cells, CELL_BITS))

    return of(utf8(text))


def _ranges(rows: DataFrame) -> tuple[DataFrame, int]:
    """`rows` with the number of their range, and how many ranges there are.

    The curve is cut where the bytes of its bins pass multiples of `RANGE_BYTES`. A bin of half a range or
    more has ranges of its own, over which its rows are dealt by a hash of their number.
    """
    bins = F.shiftright("key", DIMS * CELL_BITS - BIN_BITS).alias("bin")
    found = sorted(tuple(r) for r in rows.groupBy(bins).agg(F.sum(F.col("size") + 1).alias("bytes")).collect())
    cuts, number, filled = [], 0, 0
    for place, size in found:
        if size >= RANGE_BYTES // 2:
            number, own = number + (filled > 0), -(-size // RANGE_BYTES)
            cuts.append((place, number, own))
            number, filled = number + own, 0
        else:
            if filled and filled + size > RANGE_BYTES:
                number, filled = number + 1, 0
            cuts.append((place, number, 1))
            filled += size
    table = rows.sparkSession.createDataFrame(cuts, "bin int, first int, own int")
    dealt = F.floor(F.pmod(F.xxhash64("uid"), F.lit(1 << 20)) * F.col("own") / (1 << 20)).cast("int")
    placed = rows.withColumn("bin", bins.cast("int")).join(F.broadcast(table), "bin")
    return placed.withColumn("range", F.col("first") + dealt).drop("bin", "first", "own"), number + (filled > 0)


def pack(
    docs: DataFrame, tokenizer: str, carry: list[str], text: str = "text", length: int = SEQUENCE
) -> DataFrame:
    """Pieces of all documents: columns `carry` as struct `row`, `start`, `ids`, `doc_tokens`,
    `sequence_id`, `offset`, and `uid`, a number of the row that tells repeated rows apart.

    A document is its ids and then id 2; `ids` are little-endian unsigned 32-bit integers. Each id
    lies in exactly one piece, `start` ids of the document come before the piece, and `offset` ids of
    the sequence. NULL text counts as empty and gives the one end id. Repeated rows are each packed.
    `sequence_id` is the range's number in the high bits and a count in the low 33. An empty table
    gives no pieces.
    """
    rows = stage(
        docs.select(
            row_of(docs, carry).alias("row"),
            utf8(text).alias("text"),
            n_bytes(text).alias("size"),
            curve_key(text).alias("key"),
            F.xxhash64(*[F.col(f"`{c}`") for c in {text: 0, **dict.fromkeys(carry)}]).alias("tie"),
        ).withColumn("uid", F.monotonically_increasing_id()),
        "curve",
    )
    placed, ranges = _ranges(rows)
    row = rows.schema["row"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sequence, filled = None, TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            encoder = encoder or WordEncoder(tokenizer)
            pieces, held = [], 0
            for k, body in enumerate(batch.column("text")):
                ids = encoder.encode(body.as_py()) + END.to_bytes(4, "little")
                total, at = len(ids) // 4, 0
                while at < total:
                    take = min(total - at, length - filled)
                    pieces.append((k, at, ids[4 * at : 4 * (at + take)], total, sequence, filled))
                    at, filled = at + take, filled + take
                    if filled == length:
                        sequence, filled = sequence + 1, 0
                held += len(ids)
                if held > BATCH_BYTES or k == batch.num_rows - 1:
                    own, *values = zip(*pieces)
                    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                    columns = [pa.array(v, t) for v, t in zip(values, kinds)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("row").take(pa.array(own)), *columns, batch.column("uid").take(pa.array(own))],
                        ["row", "start", "ids", "doc_tokens", "sequence_id", "offset", "uid"],
                    )
                    pieces, held = [], 0

    kind = f"row {row}, start long, ids binary, doc_tokens long, sequence_id long, offset long, uid long"
    ordered = placed.repartitionById(max(1, ranges), "range").sortWithinPartitions("key", "tie", "uid")
    return ordered.select("row", "text", "uid").mapInArrow(cut, kind)
