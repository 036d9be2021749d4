"""Ordered target encoding: a category's code on a day is its mean demand on earlier days.

Means are drawn to that of all categories by ``PRIOR`` rows, so a level without a past has the overall mean.
A day's own demand and later ones never enter a code. Daily sums per level combine before their shuffle; running
sums go over one level's days, which the calendar bounds. No list of levels reaches the driver, so the
number of levels is not limited.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

CATEGORIES = ["store_id", "item_id"]
PRIOR = 28.0


def category_levels(training: DataFrame) -> DataFrame:
    """column, level, code: every category's levels, numbered in order."""
    levels = training.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in CATEGORIES]))).distinct()
    place = F.row_number().over(Window.partitionBy("column").orderBy("level")) - 1
    return levels.select("column", "level", place.cast("double").alias("code"))


def _code(total: Column, count: Column, overall: Column) -> Column:
    return (F.coalesce(total, F.lit(0.0)) + PRIOR * F.coalesce(overall, F.lit(0.0))) / (F.coalesce(count, F.lit(0)) + PRIOR)


def ordered_codes(training: DataFrame, column: str) -> DataFrame:
    """level, date, code of every level and day of the training rows."""
    demand = F.col("units_sold").cast("double")
    daily = training.groupBy(F.col(column).alias("level"), "date").agg(F.sum(demand).alias("total"), F.count(F.lit(1)).alias("rows"))
    days = daily.groupBy("date").agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))  # a row per day
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    overall = days.select("date", (F.sum("total").over(earlier.orderBy("date")) / F.sum("rows").over(earlier.orderBy("date"))).alias("overall"))
    own = earlier.partitionBy("level").orderBy("date")
    past = daily.select("level", "date", F.sum("total").over(own).alias("total"), F.sum("rows").over(own).alias("rows"))
    return past.join(F.broadcast(overall), "date").select("level", "date", _code(F.col("total"), F.col("rows"), F.col("overall")).alias("code"))


def encode_training(training: DataFrame) -> DataFrame:
    """Training rows with a code per category, from earlier days."""
    for column in CATEGORIES:
        codes = ordered_codes(training, column).select(F.col("level").alias(column), "date", F.col("code").alias(f"{column}_code"))
        training = training.join(codes, [column, "date"])
    return training


def final_codes(training: DataFrame) -> DataFrame:
    """column, level, code after all training days."""
    demand = F.col("units_sold").cast("double")
    levels = training.select(demand.alias("demand"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in CATEGORIES
    ]))).groupBy("column", "level").agg(F.sum("demand").alias("total"), F.count(F.lit(1)).alias("rows"))
    overall = training.agg(F.avg(demand)).scalar()
    return levels.select("column", "level", _code(F.col("total"), F.col("rows"), overall).alias("code"))


def encode(df: DataFrame, codes: DataFrame) -> DataFrame:
    """Rows with the final codes of their categories; a level unknown at training fails the job."""
    for column in CATEGORIES:
        own = codes.filter(F.col("column") == column).select(F.col("level").alias(column), F.col("code").alias("known_code"))
        unknown = F.raise_error(F.concat(F.lit(f"unknown level of {column}: "), F.col(column))).cast("double")
        df = df.join(own, column, "left").withColumn(f"{column}_code", F.coalesce("known_code", unknown)).drop("known_code")
    return df
