"""Registered queries of this package: one per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from demandloom.llm.collocations import collocations
from demandloom.llm.jaccard import jaccard_join
from demandloom.llm.packing import pack
from demandloom.llm.pii import pii_digest
from demandloom.llm.quality_rules import quality_rules
from demandloom.llm.resampling import resample
from demandloom.llm.sampled_pieces import sampled_texts
from demandloom.llm.secret_scan import secret_scan
from demandloom.llm.substring import substring_dedup
from demandloom.llm.tables import read
from demandloom.llm.token_counts import token_counts
from demandloom.llm.topk_search import topk_search
from demandloom.llm.url_filter import url_verdicts
from demandloom.llm.vector_tree import nearest_neighbours

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup(read(spark, folder, "documents"))


@query
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(read(spark, folder, "documents")).drop("failed_rule")


@query
def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii_digest(read(spark, folder, "documents"))


@query
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join(read(spark, folder, "documents"))


@query
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(read(spark, folder, "documents"))


@query
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(read(spark, folder, "documents"))


@query
def op2_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search(read(spark, folder, "embeddings"))


@query
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_verdicts(read(spark, folder, "pages")).drop("log_odds")


@query
def op6_sampled_pieces(spark: SparkSession, folder: str) -> DataFrame:
    decoded = sampled_texts(read(spark, folder, "documents"))
    return decoded.withColumn("text_sha256", F.sha2("text", 256)).drop("text")


@query
def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan(read(spark, folder, "documents"))
    return found.select("doc_id", "start", "end", F.sha2("value", 256).alias("value_sha256"), "label", F.round("probability", 6).alias("probability"), "secret")


@query
def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(read(spark, folder, "documents"))


@query
def op12_vector_tree(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_neighbours(read(spark, folder, "embeddings"))
