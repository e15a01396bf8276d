"""The corpus pipeline: raw documents to packed training sequences in five stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.llm.common import held_out, table
from gaugeloom.llm.mixing import mix
from gaugeloom.llm.packing import pack
from gaugeloom.llm.quality_classifier import KEEP_FROM, QualityModel
from gaugeloom.llm.quality_rules import quality_rules
from gaugeloom.llm.queries import MIX_SEED, WEIGHTS
from gaugeloom.llm.simhash import keep_one
from gaugeloom.session import stage


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; NULL and empty texts fail them, equal rows fare alike."""
    return quality_rules(docs, carry=docs.columns).filter("kept").select("row.*")


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the classifier's threshold.

    The model is fitted on all documents and their labels that are not held out: among what the rules kept
    there are hardly any bad ones to learn from. NULL texts count as empty, equal texts get equal scores.
    """
    labels = table(spark, sf_dir, "labels").filter(~held_out("doc_id", 5))
    model = QualityModel(table(spark, sf_dir, "documents"), labels)
    return docs.filter(model.score() >= KEEP_FROM)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates; NULL and empty texts are one group."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their source's rate, in shuffled order; NULL sources are one of their own."""
    return mix(docs, WEIGHTS, seed=MIX_SEED).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their ids; `copy_id` tells the copies of a document apart."""
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"), carry=["doc_id"])
    return pieces.select(
        "row.doc_id", "start", F.floor(F.octet_length("ids") / 4).alias("length"), F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset", "ids", F.col("uid").alias("copy_id"),
    )


STAGES = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("simhash near-dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
