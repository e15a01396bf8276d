from __future__ import annotations

import math
from collections import Counter

import pytest
from checks.compare import connect, differ
from llm_cases import documents, empty, prose
from pyspark.sql import functions as F

from gaugeloom.llm import mixing
from gaugeloom.llm.mixing import mix, poisson_cdf, unit
from gaugeloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("mean", [1e-6, 0.3, 1.0, 7.5, 16.0])
def test_distribution(spark, mean):
    cdf = spark.range(1).select(poisson_cdf(F.lit(mean)).alias("c")).first()["c"]
    total = 0.0
    for k, c in enumerate(cdf[:40]):
        total += math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))
        assert c == pytest.approx(total, abs=1e-12)
    assert cdf[-1] == pytest.approx(1, abs=1e-12)


def test_unit_is_even(spark):
    got = [r[0] for r in spark.range(4000).select(unit("draw", F.col("id").cast("string"))).collect()]
    assert all(0 <= u < 1 for u in got) and abs(sum(got) / 4000 - 0.5) < 0.02


def test_shares_and_counts(spark):
    """A hot source with most bytes and small ones reach their weights; large rates take several draws."""
    text = prose(1, 40)
    rows = [(k, text, "hot" if k < 1500 else f"s{k % 3}") for k in range(1800)] + [(5000 + k, text, "tiny") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(docs, {"hot": 1.0, "tiny": 2.0}, other=1.0, seed=3).select("row.*", "copies", "copy").collect()
    by = Counter(r["source"] for r in got)
    for source, weight in {"hot": 1, "s0": 1, "s1": 1, "s2": 1, "tiny": 2}.items():
        assert abs(by[source] / len(got) - weight / 6) < 0.04
    tiny = {r["doc_id"]: r["copies"] for r in got if r["source"] == "tiny"}
    mean = sum(tiny.values()) / 20
    assert abs(mean - 1820 / 6 * 2 / 20) < 6 and 5 < sum((x - mean) ** 2 for x in tiny.values()) / 20 < 90  # variance is near the mean
    for (doc, copies), n in Counter((r["doc_id"], r["copies"]) for r in got).items():
        assert copies == n


def test_awkward_rows(spark):
    docs = documents(spark)
    got = mix(docs, {"src0": 3.0, "": 2.0}, seed=1)
    assert got.select("row.*").columns == docs.columns
    rows = got.collect()
    have = {str(r) for r in docs.collect()}
    assert rows and all(str(r["row"]) in have for r in rows)
    assert [r["mix_key"] for r in rows] == sorted(r["mix_key"] for r in rows)
    assert mix(docs, {"src0": 0.0}, other=0.0).count() == 0
    assert {r["row"]["source"] for r in mix(docs, {"src1": 1.0}, other=0.0).collect()} == {"src1"}
    assert mix(empty(spark), {"src0": 3.0}).count() == 0


def test_query_equals_sql(spark, small):
    got = QUERIES["op3_poisson_mixing"](spark, small)
    assert differ(got.toPandas(), connect(small).sql(ORACLES["op3_poisson_mixing"]).df()) is None


def test_one_empty_row_as_a_source_spreads_over_many_tasks(spark):
    """Its copies come from many blocks in many tasks, are numbered through, and make up its share."""
    rows = [(k, prose(k % 7, 400), "big") for k in range(200)] + [(999, "", "tiny"), (999, None, "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(docs, {}, seed=5).select("row.*", "copies", "copy", "mix_key").withColumn("task", F.spark_partition_id())
    tiny = got.filter("source = 'tiny'")
    total = sum(len((t or "").encode()) + 1 for _, t, _ in rows)
    assert abs(tiny.count() / (total / 2) - 1) < 0.03  # a byte each, and half the mix
    for kind in ("text IS NULL", "text = ''"):
        one = tiny.filter(kind).agg(F.count("*").alias("n"), F.min("copy"), F.max("copy"), F.count_distinct("copy"), F.max("copies"), F.min("copies")).first()
        assert one["n"] > 10_000 and tuple(one)[1:] == (1, one["n"], one["n"], one["n"], one["n"])
    rates = mixing.source_rates(docs, {}, 1.0, "text", "source").filter("name = 'tiny'")
    blocks = mixing._blocks(rates.withColumn("key", F.lit("999"))).withColumn("task", F.spark_partition_id())
    draws = rates.first()["draws"]
    assert blocks.count() == blocks.select("block").distinct().count() == -(-draws // mixing.DRAWS)
    assert blocks.select("task").distinct().count() > 1


def test_blocks_give_what_one_block_gives(spark, monkeypatch):
    docs = spark.createDataFrame([(k, prose(k, 30), f"s{k % 2}" if k else "one") for k in range(60)], "doc_id long, text string, source string")
    light = lambda df: sorted((r["row"]["doc_id"], r["copies"], r["copy"], r["mix_key"]) for r in df.collect())
    want = light(mix(docs, {"one": 9.0}, seed=2))
    monkeypatch.setattr(mixing, "DRAWS", 1)
    monkeypatch.setattr(mixing, "SPAN", 2)
    assert light(mix(docs, {"one": 9.0}, seed=2)) == want
