"""Training-text pipeline: documents in, packed sequences out.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one
before it kept; its result is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import keep, sized, text_hash
from eventloom.llm.decontaminate import contamination
from eventloom.llm.near_dedup import near_duplicates
from eventloom.llm.packing import pack
from eventloom.llm.quality import score_quality
from eventloom.llm.secrets import redact_secrets

#: Similarity in per cent from which documents count as near duplicates here.
NEAR_PERCENT = 80


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id and text_hash are in ``dropped``."""
    keys = sized(keep(dropped.select(F.col("doc_id").alias("dropped_id"), F.col("text_hash").alias("dropped_hash")).distinct(), "dropped"))
    same = docs["doc_id"].eqNullSafe(keys["dropped_id"]) & (text_hash() == keys["dropped_hash"])
    return docs.join(keys, same, "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go, each row by its own text."""
    return _without(docs, score_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), hashed=True).where("predicted = 0"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the smallest
    doc_id, and of several rows with it (or without ids) one. Empty texts are no
    duplicates of each other, but of rows with equal doc_id and text one stays."""
    found = keep(near_duplicates(docs, percent=NEAR_PERCENT, hashed=True), "found")
    first = found.where("kept AND comp IS NOT NULL").groupBy("comp").agg(F.min("text_hash").alias("first"), F.max("text_hash").alias("last")).where("first < last")
    others = found.where("kept").join(first, "comp").where("text_hash <> first")
    kept = _without(docs, found.where("NOT kept").select("doc_id", "text_hash").unionByName(others.select("doc_id", "text_hash")))
    several = keep(kept.groupBy("doc_id", text_hash()).agg(F.count("*").alias("c")).where("c > 1").select("doc_id", "text_hash"), "several")
    if several.isEmpty():
        return kept
    again = kept.join(several, kept["doc_id"].eqNullSafe(several["doc_id"]) & (text_hash() == several["text_hash"]), "left_semi")
    return _without(kept, several).unionByName(again.dropDuplicates(["doc_id", "text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return _without(docs, contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), hashed=True).where("contaminated"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and places."""
    return pack(docs)


STAGES = [
    ("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontaminate), ("secrets", secrets), ("packing", packing),
]

#: Learned rules, similarity links and token ids have no SQL; the tests hold
#: every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = keep(docs, name)
    return docs
