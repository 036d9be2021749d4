"""Reading the tables of a folder for the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def repeated_keys(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keys of more than one row, as long."""
    keys = docs.select(F.col(key).cast("long").alias(key)).filter(F.col(key).isNotNull())
    return keys.groupBy(key).count().filter("count > 1").select(key)


def one_row_each(docs: DataFrame, key: str = "doc_id", value: str = "text") -> DataFrame:
    """``key`` as long and ``value`` as string, empty for null: one row per key that is not null.

    Of rows that repeat a key the one with the smallest value counts. The check for such
    rows reads and shuffles the keys alone; the values are grouped only if there are any.
    """
    rows = docs.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(value).cast("string"), F.lit("")).alias(value)).filter(F.col(key).isNotNull())
    return rows if repeated_keys(docs, key).isEmpty() else rows.groupBy(key).agg(F.min(value).alias(value))
