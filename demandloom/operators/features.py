"""Features of the pooled forecast model.

All history features share one window over (series, date): one shuffle, one sort.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, Window

from demandloom import params as P


def event_flag() -> Column:
    return (F.col("event_name_1").isNotNull() | F.col("event_name_2").isNotNull()).cast("int").alias("event_flag")


def snap_active(states: list[str]) -> Column:
    """The flag of the store's own state; 0 for a state without a flag column."""
    flag = F.lit(0)
    for state in states:
        flag = F.when(F.col("state_id") == state, F.col(f"snap_{state}")).otherwise(flag)
    return F.coalesce(flag, F.lit(0)).alias("snap_active")


def price_features() -> list[Column]:
    return [
        F.coalesce("sell_price", F.lit(0.0)).alias("sell_price"),
        F.col("sell_price").isNotNull().cast("int").alias("price_available"),
    ]


def cyclic_features() -> list[Column]:
    week = 2 * math.pi * F.col("wday") / 7
    year = 2 * math.pi * F.col("month") / 12
    return [
        F.sin(week).alias("weekday_sin"), F.cos(week).alias("weekday_cos"),
        F.sin(year).alias("month_sin"), F.cos(year).alias("month_cos"),
    ]


def known_features(states: list[str]) -> list[Column]:
    """Features known for future days."""
    return [*price_features(), event_flag(), snap_active(states), *cyclic_features()]


def history() -> Window:
    return Window.partitionBy(*P.SERIES).orderBy("date")


def lag_features() -> list[Column]:
    return [F.lag("units_sold", k).over(history()).cast("double").alias(f"lag_{k}") for k in P.LAGS]


def rolling_features() -> list[Column]:
    """Mean, spread and zero share of the previous days; null until the window is full."""
    result = []
    for days in P.ROLLING:
        frame = history().rowsBetween(-days, -1)
        full = F.count("units_sold").over(frame) == days
        zero = F.avg((F.col("units_sold") == 0).cast("int")).over(frame)
        result += [
            F.when(full, F.avg("units_sold").over(frame)).alias(f"rolling_mean_{days}"),
            F.when(full, F.stddev_samp("units_sold").over(frame)).alias(f"rolling_std_{days}"),
            F.when(full, zero).alias(f"rolling_zero_rate_{days}"),
        ]
    return result


def with_trend(df: DataFrame) -> DataFrame:
    return df.withColumn("demand_trend_7_vs_28", F.col("rolling_mean_7") - F.col("rolling_mean_28"))


def feature_table(panel: DataFrame, states: list[str] = P.SNAP_STATES) -> DataFrame:
    """Keys, date, demand and all features for every panel row."""
    keys = [*P.SERIES, "day_id", "date", "units_sold"]
    return with_trend(panel.select(*keys, *known_features(states), *lag_features(), *rolling_features()))


def training_features(features: DataFrame, start: Column) -> DataFrame:
    """Rows before the holdout with every feature present."""
    return features.filter(F.col("date") < start).dropna(subset=P.FEATURES)


def feature_summary(training: DataFrame, start: Column) -> DataFrame:
    """metric, value description of the training table, from two aggregates."""
    missing = sum((F.col(c).isNull().cast("long") for c in P.FEATURES), F.lit(0).cast("long"))
    series = training.groupBy(*P.SERIES).agg(
        F.count(F.lit(1)).alias("rows"), F.min("date").alias("first"), F.max("date").alias("last"),
        F.sum(missing).alias("missing"),
    )
    row = series.agg(
        F.sum("rows").cast("string").alias("training_rows"),
        F.count(F.lit(1)).cast("string").alias("product_store_series"),
        F.min("first").cast("string").alias("training_start_date"),
        F.max("last").cast("string").alias("training_end_date"),
        F.sum("missing").cast("string").alias("missing_feature_values"),
    ).withColumn("holdout_start_date", start.cast("string")).withColumn(
        "feature_columns", F.lit(str(len(P.FEATURES)))
    )
    names = [
        "training_rows", "product_store_series", "training_start_date", "training_end_date",
        "holdout_start_date", "feature_columns", "missing_feature_values",
    ]
    return row.select(*names).unpivot([], names, "metric", "value")
