"""Baseline forecast rules, rolling-origin backtest and per-series selection.

Days are numbered backwards from the end of the data and cut into blocks of one
horizon: block 0 is the holdout, blocks 1-4 are the backtest windows. Every rule
reads only the block before the one it predicts, so one aggregate per (series,
block) plus a look at the next block supplies all rules and windows at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from demandloom import params as P
from demandloom.functions.metrics import accuracy


def _blocks(panel: DataFrame, last_day: Column, blocks: int) -> DataFrame:
    """One row per series and block: its days in order and what the rules need of it."""
    back = last_day - F.col("day_number")
    place = F.col("back") % P.HORIZON  # 0 = last day of the block
    season = [
        F.max(F.when(place == P.SEASON - 1 - k, F.col("units_sold"))).cast("double") for k in range(P.SEASON)
    ]
    return (
        panel.withColumn("back", back).filter(F.col("back") < P.HORIZON * blocks)
        .groupBy(*P.SERIES, F.floor(F.col("back") / P.HORIZON).cast("int").alias("block"))
        .agg(
            F.sort_array(
                F.collect_list(F.struct("day_number", "date", F.col("units_sold").cast("double").alias("actual_units")))
            ).alias("days"),
            F.struct(
                F.max_by("units_sold", "day_number").cast("double").alias("last_value"),
                F.avg(F.when(place < P.SEASON, F.col("units_sold"))).alias("mean_7"),
                F.avg("units_sold").alias("mean_28"),
                F.array(*season).alias("season"),
            ).alias("seen"),
        )
    )


def candidate_forecasts(panel: DataFrame, last_day: Column) -> DataFrame:
    """All rules over the holdout (block 0) and the backtest windows (blocks 1-4)."""
    earlier = Window.partitionBy(*P.SERIES).orderBy("block")
    rows = (
        _blocks(panel, last_day, P.BACKTEST_WINDOWS + 2)
        .withColumn("known", F.lead("seen").over(earlier))
        .filter(F.col("block") <= P.BACKTEST_WINDOWS)
        .select(*P.SERIES, "block", "known", F.posexplode("days").alias("step", "day"))
    )
    weekly = F.element_at("known.season", F.col("step") % P.SEASON + 1)
    predictions = [F.lit(0.0), F.col("known.last_value"), weekly, F.col("known.mean_7"), F.col("known.mean_28")]
    models = F.array(*[
        F.struct(F.lit(name).alias("model"), F.lit(rank).alias("priority"), value.alias("predicted_units"))
        for rank, (name, value) in enumerate(zip(P.RULES, predictions))
    ])
    return rows.select(
        *P.SERIES, "block", (F.col("step") + 1).alias("forecast_step"),
        F.col("day.day_number").alias("day_number"), F.col("day.date").alias("date"),
        F.col("day.actual_units").alias("actual_units"), F.inline(models),
    ).withColumn("day_id", F.concat(F.lit("d_"), F.col("day_number").cast("string")))


FORECAST_COLUMNS = ["model", *P.SERIES, "day_id", "date", "actual_units", "predicted_units"]


def rule_forecast(candidates: DataFrame, rule: str) -> DataFrame:
    """Holdout forecast of one rule."""
    return candidates.filter((F.col("block") == 0) & (F.col("model") == rule)).select(
        *P.SERIES, "forecast_step", "day_id", "date", "actual_units", "predicted_units"
    )


def baseline_forecasts(candidates: DataFrame) -> DataFrame:
    """Last-value and weekly forecasts of the holdout with their errors."""
    error = F.col("predicted_units") - F.col("actual_units")
    return candidates.filter(
        (F.col("block") == 0) & F.col("model").isin("last_value_naive", "weekly_seasonal_naive")
    ).select(
        *FORECAST_COLUMNS, error.alias("prediction_error"),
        F.abs(error).alias("absolute_error"), (error * error).alias("squared_error"),
    )


def backtest_scores(candidates: DataFrame) -> DataFrame:
    """Errors of every rule pooled over the backtest windows, per series."""
    measures = accuracy(digits=9)
    return candidates.filter(F.col("block") > 0).groupBy(
        *P.SERIES, F.col("model").alias("candidate_model"), F.col("priority").alias("model_priority")
    ).agg(*[m.alias(f"backtest_{n}") for m, n in zip(measures, ["mae", "rmse", "bias", "wape_percent"])])


def adaptive_selection(scores: DataFrame) -> DataFrame:
    """Best rule per series by (mae, rmse, rule order); scores carry 9 decimals so ties are ties."""
    order = F.struct("backtest_mae", "backtest_rmse", "model_priority")
    return scores.groupBy(*P.SERIES).agg(
        F.min_by("candidate_model", order).alias("selected_model"),
        F.min("backtest_mae").alias("backtest_mae"),
    )


def adaptive_forecasts(candidates: DataFrame, selection: DataFrame) -> DataFrame:
    """Holdout forecast of the selected rule of each series."""
    holdout = candidates.filter(F.col("block") == 0)
    chosen = selection.select(*P.SERIES, F.col("selected_model").alias("model"))
    return holdout.join(chosen, [*P.SERIES, "model"]).select(
        F.lit(P.ADAPTIVE).alias("model"), F.col("model").alias("selected_model"),
        *FORECAST_COLUMNS[1:],
    )


def adaptive_selection_metrics(forecasts: DataFrame, selection: DataFrame) -> DataFrame:
    """Selected rule, backtest error and holdout errors per series."""
    measures = accuracy(digits=9)
    holdout = forecasts.groupBy(*P.SERIES).agg(
        *[m.alias(f"validation_{n}") for m, n in zip(measures, ["mae", "rmse", "bias", "wape_percent"])]
    )
    return selection.join(holdout, P.SERIES)


def adaptive_model_distribution(selection: DataFrame) -> DataFrame:
    return selection.groupBy("store_id", "selected_model").agg(
        F.count(F.lit(1)).alias("number_of_series")
    ).orderBy("store_id", F.desc("number_of_series"), "selected_model")
