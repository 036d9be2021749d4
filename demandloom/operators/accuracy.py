"""Forecast metrics, demand characteristics and error analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from demandloom import params as P
from demandloom.functions.metrics import accuracy, demand_pattern


def forecast_metrics(forecasts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return forecasts.groupBy(*keys).agg(*accuracy())


def metrics_overall_and_by_store(forecasts: DataFrame) -> DataFrame:
    """Both levels from one pass; store_id is null in the overall rows."""
    return forecasts.groupingSets([["model"], ["model", "store_id"]], "model", "store_id").agg(*accuracy())


def metrics_overall(forecasts: DataFrame) -> DataFrame:
    return forecast_metrics(forecasts, ["model"]).orderBy("mae", "model")


def metrics_by_store(forecasts: DataFrame) -> DataFrame:
    return forecast_metrics(forecasts, ["model", "store_id"]).orderBy("store_id", "mae", "model")


def _with_totals() -> list:
    return [
        F.sum("actual_units").alias("validation_actual_units"),
        F.sum("predicted_units").alias("validation_forecast_units"),
        *accuracy(),
    ]


def metrics_by_series(forecasts: DataFrame, characteristics: DataFrame) -> DataFrame:
    return forecasts.groupBy("model", *P.SERIES).agg(*_with_totals()).join(characteristics, P.SERIES, "left")


def metrics_comparison(earlier: DataFrame, later: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union of two metric tables; a key in both keeps its later row."""
    both = earlier.withColumn("load", F.lit(0)).unionByName(later.withColumn("load", F.lit(1)))
    values = [c for c in earlier.columns if c not in keys]
    last = both.groupBy(*keys).agg(F.max_by(F.struct(*values), "load").alias("kept"))
    return last.select(*keys, "kept.*").orderBy("mae", *keys)


def demand_characteristics(training: DataFrame) -> DataFrame:
    """Size, spread and intermittency of each series' training demand."""
    zero = F.count_if(F.col("units_sold") == 0)
    stats = training.groupBy(*P.SERIES).agg(
        F.count(F.lit(1)).alias("training_days"),
        F.sum("units_sold").alias("total_training_demand"),
        F.avg("units_sold").alias("mean"),
        F.stddev_samp("units_sold").alias("std"),
        zero.alias("zero_sales_days"),
        (100.0 * zero / F.count(F.lit(1))).alias("zero_share"),
    )
    return stats.select(
        *P.SERIES, "training_days", "total_training_demand",
        F.round("mean", 4).alias("mean_daily_demand"),
        F.round("std", 4).alias("demand_standard_deviation"),
        "zero_sales_days",
        F.round("zero_share", 4).alias("zero_sales_percentage"),
        F.round(F.try_divide(F.col("std"), F.col("mean")), 4).alias("coefficient_of_variation"),
        demand_pattern(F.col("zero_share"), F.col("mean"), P.PATTERN_FLOORS).alias("demand_pattern"),
    )


def metrics_by_pattern(forecasts: DataFrame, characteristics: DataFrame) -> DataFrame:
    """Metrics and series count by model and demand pattern.

    The series count is added to partial sums per series, so no distinct is needed.
    """
    error = F.col("predicted_units") - F.col("actual_units")
    per_series = forecasts.groupBy("model", *P.SERIES).agg(
        F.sum("actual_units").alias("actual"), F.sum("predicted_units").alias("predicted"),
        F.sum(F.abs(error)).alias("absolute"), F.sum(error * error).alias("squared"),
        F.sum(F.abs(F.col("actual_units"))).alias("size"), F.count(F.lit(1)).alias("days"),
    )
    days = F.sum("days")
    return (
        per_series.join(characteristics.select(*P.SERIES, "demand_pattern"), P.SERIES)
        .groupBy("model", "demand_pattern")
        .agg(
            F.sum("actual").alias("validation_actual_units"),
            F.sum("predicted").alias("validation_forecast_units"),
            F.round(F.sum("absolute") / days, 4).alias("mae"),
            F.round(F.sqrt(F.sum("squared") / days), 4).alias("rmse"),
            F.round((F.sum("predicted") - F.sum("actual")) / days, 4).alias("bias"),
            F.round(F.try_divide(100.0 * F.sum("absolute"), F.sum("size")), 4).alias("wape_percent"),
            F.count(F.lit(1)).alias("number_of_series"),
        )
    )


def pattern_distribution(characteristics: DataFrame) -> DataFrame:
    return characteristics.groupBy("demand_pattern").agg(
        F.count(F.lit(1)).alias("number_of_series")
    ).orderBy(F.desc("number_of_series"), "demand_pattern")


def model_winners(series_metrics: DataFrame) -> DataFrame:
    """Series won per store and model: lowest rounded mae, then the first name."""
    best = series_metrics.groupBy(*P.SERIES).agg(
        F.min_by("model", F.struct("mae", "model")).alias("best_model")
    )
    return best.groupBy("store_id", "best_model").agg(F.count(F.lit(1)).alias("series_won"))


def worst_series(series_metrics: DataFrame, model: str = "weekly_seasonal_naive", limit: int = 20) -> DataFrame:
    return series_metrics.filter(F.col("model") == model).orderBy(F.desc("mae"), *P.SERIES).limit(limit)


def best_model(overall: DataFrame) -> DataFrame:
    return overall.orderBy("mae", "model").limit(1)
