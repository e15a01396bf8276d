"""Periodic runs of words, found on grammar-compressed texts.

A text's words become numbers and Re-Pair turns them into a grammar: pairs of neighbours that occur twice
become one symbol, the more frequent ones first. Pairs are replaced in rounds, in each round all those that
come before the pairs they overlap, so a chunk of texts is compressed in a few vector operations a round;
no symbol is shared by two texts. What is left of a text, its start rule, is folded into a balanced tree.

A run that crosses no boundary between the two halves of a symbol lies inside one of them. So the runs that
cross a boundary are computed once for each symbol, on one of its places, and are moved to all places that
the symbol derives. At the lowest symbol that holds a run whole it comes out whole; pieces of it that lower
symbols gave are contained in it and go when intervals of one period are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gaugeloom.llm.common import row_of, utf8

#: A run has at least this many words and this many periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3
#: A run's words equal those a period on in a stretch of 16 or more, so on one side of any boundary
#: inside that stretch a block of 8 words comes again.
BLOCK = 8
#: Words of a chunk of texts; a longer text is a chunk of its own.
CHUNK = 250_000
REMEMBERED = 400_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = got = len(self)
        return got


def _repeated(codes: np.ndarray, among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places whose code occurs twice or more (of those marked in `among`), sorted by code and place,
    and the first of each code in that list."""
    bits = max(10, min(24, int(len(codes)).bit_length() + 2))
    bucket = ((codes.astype(np.uint64) * _ODD) >> np.uint64(64 - bits)).astype(np.int64)
    own = bucket if among is None else bucket[among]
    often = np.bincount(own, minlength=1 << bits)[bucket] > 1
    at = np.flatnonzero(often if among is None else often & among)
    at = at[np.argsort(codes[at], kind="stable")]
    new = np.r_[True, codes[at][1:] != codes[at][:-1]] if len(at) else np.zeros(0, bool)
    count = np.diff(np.r_[np.flatnonzero(new), len(at)])
    several = np.repeat(count > 1, count)
    return at[several], np.flatnonzero(new[several])


@dataclass
class Grammar:
    """Rules by number: where the first place of the symbol begins, where its halves meet and where it
    ends; `places` has all places of each symbol; `start` are the places of the symbols that are left."""

    low: np.ndarray
    middle: np.ndarray
    high: np.ndarray
    places: list[np.ndarray]
    start: np.ndarray


def re_pair(words: np.ndarray) -> Grammar:
    """The grammar of a sequence of numbers; numbers of different texts must differ.

    A round replaces every pair of symbols that occurs twice or more and comes before the pairs beside it.
    Pairs come in order of their count's power of two, then of a hash, so that no chain of neighbours
    waits long and equal stretches are replaced alike. In a row of one symbol every other pair counts.
    """
    symbol, at = words.astype(np.int64), np.arange(len(words))
    size = np.ones(int(symbol.max()) + 1 if len(symbol) else 1, np.int64)
    low, middle, high, places = [], [], [], []
    while len(symbol) > 1:
        code = symbol[:-1] << 32 | symbol[1:]
        place = np.arange(len(code))
        same = np.r_[False, code[1:] == code[:-1]]
        usable = (place - np.maximum.accumulate(np.where(same, 0, place))) % 2 == 0
        some, first = _repeated(code, usable)
        if not len(some):
            break
        count = np.diff(np.r_[first, len(some)])
        order = np.zeros(len(code) + 2, np.uint64)
        mixed = code[some].astype(np.uint64) * _ODD
        grade = np.frexp(np.repeat(count, count).astype(np.float64))[1].astype(np.uint64)
        order[some + 1] = (grade << np.uint64(57)) | (mixed >> np.uint64(7)) | np.uint64(1)
        chosen = np.flatnonzero((order[1:-1] > order[:-2]) & (order[1:-1] >= order[2:]))
        _, sample, kind = np.unique(code[chosen], return_index=True, return_inverse=True)
        one = chosen[sample]
        begin, length = at[one], size[symbol[one]] + size[symbol[one + 1]]
        low.append(begin)
        middle.append(at[one + 1])
        high.append(begin + length)
        by = np.argsort(kind, kind="stable")
        cuts = np.cumsum(np.bincount(kind, minlength=len(one)))[:-1]
        long = np.flatnonzero(length >= LEAST_WORDS)
        if len(long):
            each = np.split(at[chosen][by], cuts)
            places.extend(each[k] if length[k] >= LEAST_WORDS else one[:0] for k in range(len(one)))
        else:
            places.extend([one[:0]] * len(one))
        symbol[chosen] = len(size) + kind
        size = np.concatenate([size, length])
        left = np.ones(len(symbol), bool)
        left[chosen + 1] = False
        symbol, at = symbol[left], at[left]
    none = np.zeros(0, np.int64)
    return Grammar(*(np.concatenate([none, *x]) for x in (low, middle, high)), places, at)


def folded(start: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The start rules as balanced trees: low, middle and high of each inner node.

    `start` are the places of all symbols left, `ends` the ends of the texts, each at least one symbol long.
    """
    last = np.searchsorted(start, ends)  # symbols up to the end of each text
    first = np.r_[0, last[:-1]]
    text = np.repeat(np.arange(len(ends)), last - first)
    j = np.arange(len(start)) - first[text]
    inner = np.flatnonzero(j)
    j, text = j[inner], text[inner]
    half = j & -j
    after = np.r_[start, ends[-1:]]
    over = first[text] + j + half
    high = np.where(over >= last[text], ends[text], after[np.minimum(over, len(start))])
    return start[inner - half], start[inner], high


def _blocks(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of the block of words that begins at each place, and how far off its nearest equal is."""
    n = len(words)
    hashed = (words.astype(np.uint64) + np.uint64(1)) * _ODD
    hashed ^= hashed >> np.uint64(29)
    reach, factor = 1, int(_ODD)
    while reach < BLOCK:
        far = np.zeros(n, np.uint64)
        far[: n - reach] = hashed[reach:] if n > reach else 0
        hashed = hashed * np.uint64(factor) + far
        factor, reach = factor * factor & (1 << 64) - 1, 2 * reach
    off = np.full(n, np.iinfo(np.int64).max)
    at, first = _repeated(hashed)
    if len(at):
        step = np.diff(at)
        step[first[1:] - 1] = np.iinfo(np.int64).max
        off[at[:-1]] = step
        off[at[1:]] = np.minimum(off[at[1:]], step)
    return hashed, off


def _ahead(words: np.ndarray, at: int, period: int, high: int) -> int:
    """How many words from `at` on equal the one a period later, which must lie before `high`."""
    most, done, step = high - period - at, 0, 64
    while done < most:
        to = min(done + step, most)
        differ = words[at + done : at + to] != words[at + done + period : at + to + period]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done, step = to, 4 * step
    return max(most, 0)


def _behind(words: np.ndarray, at: int, period: int, low: int) -> int:
    """How many words before `at` equal the one a period later, down to `low`."""
    most, done, step = at - low, 0, 64
    while done < most:
        to = min(done + step, most)
        differ = (words[at - to : at - done] != words[at - to + period : at - done + period])[::-1]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done, step = to, 4 * step
    return max(most, 0)


def crossing(words: np.ndarray, blocks: np.ndarray, low: int, middle: int, high: int) -> list[tuple[int, int, int]]:
    """Runs within low to high that hold the words on both sides of `middle`: (start, end, period).

    With three periods a run reaches a period beyond the boundary on one side at least, so the boundary's
    two words come again a period later or earlier, and with them a block of words beside the boundary.
    Multiples of a period found are left out where they lie in the same stretch.
    """
    found, most = [], (high - low) // LEAST_PERIODS
    later, before = min(most, high - 1 - middle), min(most, middle - 1 - low)
    back = middle - BLOCK
    for ahead in (True, False):
        reach = later if ahead else before
        if reach < 1:
            continue
        if ahead:
            hit = blocks[middle + 1 : middle + 1 + reach] == blocks[middle]
            if back >= low:
                hit |= blocks[back + 1 : back + 1 + reach] == blocks[back]
        else:
            hit = (blocks[middle - reach : middle] == blocks[middle])[::-1]
            if back - reach >= 0:
                hit |= (blocks[back - reach : back] == blocks[back])[::-1]
            elif back > 0:
                part = (blocks[:back] == blocks[back])[::-1]
                hit[: len(part)] |= part
        periods, k = np.flatnonzero(hit) + 1, 0
        for start, end, period in found:
            inside = middle + periods < end if ahead else middle - 1 - periods >= start
            periods = periods[~((periods % period == 0) & inside)]
        while k < len(periods):
            period = int(periods[k])
            k += 1
            at = middle if ahead else middle - period
            ahead_of, behind = _ahead(words, at, period, high), _behind(words, at, period, low)
            start, end = at - behind, at + period + ahead_of
            if ahead_of and behind and end - start >= max(LEAST_WORDS, LEAST_PERIODS * period):
                found.append((start, end, period))
                rest = periods[k:]
                inside = middle + rest < end if ahead else middle - 1 - rest >= start
                periods, k = rest[~((rest % period == 0) & inside)], 0
    return found


def merged(runs: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) without those that another of the same period contains; of equal
    stretches the smallest period stays."""
    if not len(runs):
        return runs.reshape(0, 3)
    runs = np.unique(runs, axis=0)
    runs = runs[np.lexsort((-runs[:, 1], runs[:, 0], runs[:, 2]))]
    new = np.r_[True, runs[1:, 2] != runs[:-1, 2]]
    group = np.cumsum(new) - 1
    span = int(runs[:, 1].max()) + 1
    most = np.maximum.accumulate(runs[:, 1] + group * span)
    runs = runs[np.r_[True, (runs[1:, 1] + group[1:] * span) > most[:-1]]]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    fresh = np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1)]
    runs = runs[fresh]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All runs of texts laid end to end: rows (start, end, period), by start and then period.

    `words` are numbers that differ between texts, `ends` where each text ends; no text is empty.
    """
    grammar = re_pair(words)
    blocks, off = _blocks(words)
    low, middle, high = (np.concatenate(x) for x in zip((grammar.low, grammar.middle, grammar.high), folded(grammar.start, ends)))
    near = np.minimum(off[middle], np.where(middle - BLOCK >= low, off[np.maximum(middle - BLOCK, 0)], off[middle]))
    alive = (high - low >= LEAST_WORDS) & (near <= (high - low) // LEAST_PERIODS)
    out = []
    for k in np.flatnonzero(alive):
        begin = int(low[k])
        for start, end, period in crossing(words, blocks, begin, int(middle[k]), int(high[k])):
            if k < len(grammar.places):
                moved = grammar.places[k] - begin
                out.append(np.stack([start + moved, end + moved, np.full(len(moved), period)], 1))
            else:
                out.append(np.array([[start, end, period]]))
    return merged(np.concatenate(out) if out else np.zeros((0, 3), np.int64))


def _texts(texts: list[bytes], ids: _Ids) -> Iterator[tuple[int, list[list[bytes]], np.ndarray]]:
    """Chunks of texts: the first one's number, the words of each, and all runs in them as rows
    (text in the chunk, start, length, period)."""
    first, held, size = 0, [], 0
    for k, text in enumerate(texts):
        held.append(text.split())
        size += len(held[-1])
        if size < CHUNK and k + 1 < len(texts):
            continue
        if len(ids) > REMEMBERED:
            ids.clear()
        own = np.array([k for k, w in enumerate(held) if len(w) >= LEAST_WORDS], np.int64)
        found = np.zeros((0, 4), np.int64)
        if len(own):
            length = np.array([len(held[k]) for k in own])
            word = np.concatenate([np.fromiter(map(ids.__getitem__, held[k]), np.int64, len(held[k])) for k in own])
            dense = np.unique(np.repeat(np.arange(len(own)), length) << 32 | word, return_inverse=True)[1].ravel()
            ends = np.cumsum(length)
            runs = runs_of(dense, ends)
            text = np.searchsorted(ends, runs[:, 0], side="right")
            start = runs[:, 0] - (ends - length)[text]
            found = np.stack([own[text], start, runs[:, 1] - runs[:, 0], runs[:, 2]], 1)
        yield first, held, found
        first, held, size = k + 1, [], 0


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by spaces, of each run (start, length, period) only the first period."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def period_runs(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """Each row's columns `carry` as struct `row`, `n_words`, `runs` and `collapsed`.

    `runs` holds start (word number from 0), length and smallest period, all long, of every run, by start and
    then period. `collapsed` is the text's words joined by one space, without those that lie in a run after its
    first period. Words are stretches without ASCII whitespace. NULL text counts as empty: no words, no
    runs, empty `collapsed`. Every row is a document of its own, repeated rows and equal texts get equal
    results, and an empty table stays empty. A text is worked on whole in one task, however long it is, with
    about 200 bytes of memory a word; other texts share chunks of about `CHUNK` words.
    """
    spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for first, held, found in _texts(texts, ids):
                cuts = np.searchsorted(found[:, 0], np.arange(len(held) + 1))
                flat = pa.StructArray.from_arrays([pa.array(found[:, c]) for c in (1, 2, 3)], ["start", "length", "period"])
                kept = [collapsed(w, found[cuts[k] : cuts[k + 1], 1:]) for k, w in enumerate(held)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(first, len(held)),
                        pa.array([len(w) for w in held], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), flat).cast(spans),
                        pa.array(kept, pa.binary()),
                    ],
                    ["row", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(row_of(docs, carry).alias("row"), utf8(text).alias("text"))
    kind = f"row {rows.schema['row'].dataType.simpleString()}, n_words long, "
    kind += "runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    found = rows.mapInArrow(each, kind)
    return found.withColumn("collapsed", found["collapsed"].cast("string"))
