from __future__ import annotations

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import documents, empty, prose, texts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gaugeloom.llm.packing import hilbert_keys, pack
from gaugeloom.llm.queries import op7
from gaugeloom.llm.word_bpe import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(PATH)


def ids_of(whole, text, end=(2,)):
    return np.array([*whole.encode(text or "", add_special_tokens=False).ids, *end], "<u4").tobytes()


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3)])
def test_hilbert_curve_is_one_step_at_a_time(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_encoder_equals_the_tokenizer(whole):
    encoder = WordEncoder(PATH)
    odd = ["don't I'LL 'tis", "a_b 1,234 x² ½", "ÀÉ ßtraße ÷ × ΣΑΣ", "été İ   \x85 \x1c", "日本語 <|startoftext|>", "!!??...,,", "."]
    for text in [*texts(), *odd]:
        assert encoder.encode((text or "").encode()) == ids_of(whole, text, ())


def check(pieces, want, length=4096):
    """Pieces tile each row's ids, and fill sequences without gaps."""
    seqs, docs = {}, {}
    for r in pieces:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["offset"] + len(r["ids"]) // 4))
        docs.setdefault(r["row"]["doc_id"], []).append((r["start"], bytes(r["ids"]), r["doc_tokens"]))
    for spans in seqs.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= length
    for doc, parts in docs.items():
        for start in {p[0] for p in parts}:
            assert sum(p[0] == start for p in parts) >= 1
        if doc is not None and len({p[0] for p in parts}) == len(parts):
            parts.sort()
            assert b"".join(p[1] for p in parts) == want[doc] and parts[0][2] == len(want[doc]) // 4
    assert sum(len(r["ids"]) for r in pieces) == sum(map(len, want["all"]))
    return seqs


def test_awkward_rows(spark, whole):
    docs = documents(spark)
    rows = docs.collect()
    want = {r["doc_id"]: ids_of(whole, r["text"]) for r in rows}
    want["all"] = [ids_of(whole, r["text"]) for r in rows]
    got = pack(docs, PATH, carry=docs.columns, length=256)
    seqs = check(got.collect(), want, 256)
    assert sum(spans[-1][1] < 256 for spans in seqs.values()) == 1
    assert got.select("row.*").columns == docs.columns
    assert pack(empty(spark), PATH, carry=["doc_id"]).count() == 0


def test_one_row_repeated_fills_many_ranges(spark, whole, monkeypatch):
    import gaugeloom.llm.packing as module

    monkeypatch.setattr(module, "RANGE_BYTES", 1000)
    docs = spark.createDataFrame([(1, "same words over and over")] * 600, "doc_id long, text string")
    ids = ids_of(whole, "same words over and over")
    pieces = pack(docs, PATH, carry=["doc_id"], length=64).collect()
    check(pieces, {1: ids, "all": [ids] * 600}, 64)
    used = {r["sequence_id"] >> 33 for r in pieces}
    assert len(used) > 5
    assert len({(r["uid"], r["start"]) for r in pieces}) == len(pieces) and len({r["uid"] for r in pieces}) == 600


def test_ranges_hold_about_equal_bytes(spark, monkeypatch):
    """Few long texts, many short ones and a hot text: ranges are cut by bytes, and the hot one is split."""
    import gaugeloom.llm.packing as module

    monkeypatch.setattr(module, "RANGE_BYTES", 20_000)
    texts = [prose(k, 20) for k in range(900)] + [prose(1000 + k, 900) for k in range(60)] + ["one hot text " * 20] * 500
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "uid long, text string")
    rows = rows.withColumn("key", module.curve_key("text")).withColumn("size", F.octet_length("text").cast("long"))
    placed, ranges = module._ranges(rows.cache())
    sizes = {r["range"]: r["bytes"] for r in placed.groupBy("range").agg(F.sum("size").alias("bytes")).collect()}
    assert set(sizes) <= set(range(ranges)) and ranges < 2.5 * sum(sizes.values()) / 20_000
    assert max(sizes.values()) < 1.6 * 20_000
    hot = placed.filter(F.col("text").startswith("one hot")).select("range").distinct().count()
    assert hot >= 5


def test_query(spark, small, whole):
    text = dict(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    rows = op7(spark, small).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert set(by) == set(text)
    for doc, parts in by.items():
        ids = ids_of(whole, text[doc])
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) // 4
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[4 * r["start"] : 4 * at])
        assert at == len(ids) // 4
