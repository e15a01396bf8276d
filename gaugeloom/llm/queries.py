"""One query for each operator, over its whole tables and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.llm import oracles
from gaugeloom.llm.chat import render
from gaugeloom.llm.collocations import collocations
from gaugeloom.llm.common import ORACLES, QUERIES, held_out, query, table  # noqa: F401
from gaugeloom.llm.forest import nearest
from gaugeloom.llm.hmm import hmm_scores
from gaugeloom.llm.imatch import fingerprints, likeness, with_next
from gaugeloom.llm.kd_shards import kd_shards
from gaugeloom.llm.mixing import mix
from gaugeloom.llm.packing import pack
from gaugeloom.llm.period_runs import period_runs
from gaugeloom.llm.quality_classifier import KEEP_FROM, quality_score
from gaugeloom.llm.quality_rules import quality_rules
from gaugeloom.llm.simhash import hex_digits, near_duplicates
from gaugeloom.llm.url_filter import judge, rules_table
from gaugeloom.session import stage


#: Sources whose weight in the mix differs from 1.
WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 0.5}
MIX_SEED = 7
URL_RULES = [
    ("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"),
]


@query("op1_chat_formatting", oracles.CHAT)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(table(spark, sf_dir, "conversations"))


@query("op2_random_indexing_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out("doc_id", 5))
    scored = docs.select("doc_id", held_out("doc_id", 5).alias("held_out"), quality_score(docs, labels).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= KEEP_FROM, 1).otherwise(0))


@query("op3_poisson_mixing", oracles.mixing(WEIGHTS, MIX_SEED))
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), WEIGHTS, seed=MIX_SEED)
    return mixed.select("row.*", "copies", "copy", "mix_key")


@query("op4_hash_prefix_forest")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors.withColumn("asks", F.col("vec_id") % 50 == 0), "asks", k=5)


@query("op5_hidden_markov_scores")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out("doc_id", 10).alias("held_out"))
    scored = hmm_scores(docs.withColumn("train", ~F.col("held_out")), "train", carry=["doc_id", "held_out"])
    return scored.select("row.*", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op6_kd_tree_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards(table(spark, sf_dir, "documents"), carry=["doc_id"], shards=16)
    return placed.select(
        "row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op7_hilbert_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), carry=["doc_id"])
    return pieces.select(
        "row.doc_id", "start", F.floor(F.octet_length("ids") / 4).alias("length"),
        F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
    )


@query("op8_bloom_cascade_urls", oracles.URLS)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules_table(spark, URL_RULES))
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


@query("op9_simhash_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", hex_digits("fp").alias("fingerprint"), "component_id")


@query("op10_quality_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "distance2",
    )


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; of every tenth document by the hash of its id, words from a place on repeat with a period."""
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    hashed = docs.select(
        "doc_id", "text", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("h")
    ).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    placed = hashed.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    placed = placed.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    placed = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    word = lambda w, i: F.when(i >= F.col("a"), F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))).otherwise(w)
    changed = F.when(F.col("n") > 0, F.array_join(F.transform("words", word), " ")).otherwise(F.col("text"))
    return placed.select("doc_id", changed.alias("text"))


@query("op11_period_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = period_runs(with_periods(table(spark, sf_dir, "documents")), carry=["doc_id"])
    longer = lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = found.withColumn("best", F.reduce("runs", F.get("runs", F.lit(0)), longer))
    return best.select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_phrase_collocations", oracles.COLLOCATIONS)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


@query("op12_imatch_fingerprints", oracles.IMATCH)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    n = F.length("text")
    edited = F.concat(
        F.substring("text", 1, n - F.floor(n / 4).cast("int")), F.substring("next_text", 1, F.floor(n / 4).cast("int"))
    )
    both = with_next(docs, "doc_id", "text").select(
        F.col("key").alias("doc_id"), "text", n.cast("long").alias("n_chars"), edited.alias("edited"),
        F.xxhash64("text").alias("hash"), "next_key", F.xxhash64("next_text").alias("next_hash"),
    ).withColumn("edited_sha256", F.sha2("edited", 256))
    found = stage(
        fingerprints(both, ["text", "edited"], ["doc_id", "n_chars", "edited_sha256", "hash", "next_key", "next_hash"], lexicon_of=docs)
        .select("row.*", F.col("fp0").alias("fingerprint"), F.col("fp1").alias("edited_fingerprint")),
        "fingerprints",
    )
    after = found.groupBy(F.col("doc_id").alias("key"), F.col("hash").alias("next_hash")).agg(F.min("fingerprint").alias("next"))
    met = found.join(after, found["next_key"].eqNullSafe(after["key"]) & (found["next_hash"] == after["next_hash"]))
    return met.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"), likeness("fingerprint", "next").alias("near_next"),
    )
