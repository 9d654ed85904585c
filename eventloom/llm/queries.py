"""Registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventloom.llm.class_lm import score_texts
from eventloom.llm.collocations import COLLOCATIONS_SQL, collocations
from eventloom.llm.common import read_table
from eventloom.llm.decontaminate import CONTAMINATION_SQL, contamination
from eventloom.llm.fill_in_middle import FILL_IN_MIDDLE_SQL, digests
from eventloom.llm.html_wrapper import extract_main_text
from eventloom.llm.near_dedup import near_duplicates
from eventloom.llm.packing import pack
from eventloom.llm.quality import score_quality
from eventloom.llm.rans import round_trip
from eventloom.llm.secrets import find_secrets
from eventloom.llm.toxicity import score_toxicity
from eventloom.llm.topk import TOP_K_SQL, top_k
from eventloom.llm.vp_tree import nearest


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read_table(spark, sf_dir, "pages"))


def op7_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(read_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"))


def op13_vp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_quality, op3_token_files, op4_near_dedup, op5_toxicity, op6_html, op7_class_lm, op8_topk, op9_decontamination,
    op10_secrets, op11_collocations, op12_fill_in_middle, op13_vp_tree)}
ORACLE: dict[str, str] = {
    "op8_topk": TOP_K_SQL, "op9_decontamination": CONTAMINATION_SQL, "op11_collocations": COLLOCATIONS_SQL,
    "op12_fill_in_middle": FILL_IN_MIDDLE_SQL}
