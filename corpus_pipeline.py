"""Cleans and packs documents: each stage works on what the one before kept.

Rules reject poor documents; of each class of near copies the smallest doc_id stays; repeated
passages are cut out; personal data are masked; what is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandloom.llm.jaccard import drop_near_copies
from demandloom.llm.packing import pack
from demandloom.llm.pii import mask_personal
from demandloom.llm.quality_rules import keep_good
from demandloom.llm.substring import drop_repeats
from demandloom.llm.tables import read
from demandloom.sources.storage import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_personal(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_copies),
    ("substring_dedup", repeated_passages),
    ("pii", personal_data),
    ("packing", packing),
]

ORACLE_SQL = None  # the last stage needs a tokenizer; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
