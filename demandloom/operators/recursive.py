"""Recursive multi-step forecasts: each predicted day becomes history of the next.

The state of a series is one row: its last 28 demands and the known-ahead features of
the 28 days to come, both bounded. A partition's series advance together as one matrix,
so all steps are a single narrow pass without shuffles between them. Actual demand is
carried to the output but never enters a feature.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from demandloom import params as P
from demandloom.operators.features import known_features

HISTORY = max(P.LAGS + P.ROLLING)


def forecast_state(panel: DataFrame, start: Column, states: list[str] = P.SNAP_STATES) -> DataFrame:
    """history: last demands before the holdout, oldest first; future: holdout days in order.

    The panel is cut to those days before the shuffle.
    """
    near = panel.filter(F.col("date") >= F.date_sub(start, HISTORY))
    ahead = F.col("date") >= start
    return near.select(
        *P.SERIES, "day_id", "date", F.col("units_sold").cast("double").alias("demand"), *known_features(states)
    ).groupBy(*P.SERIES).agg(
        F.sort_array(F.collect_list(F.when(~ahead, F.struct("date", "demand")))).alias("past"),
        F.sort_array(F.collect_list(F.when(ahead, F.struct(
            "date", "day_id", F.col("demand").alias("actual_units"),
            F.array(*[F.col(c).cast("double") for c in P.KNOWN_FEATURES]).alias("known"),
        )))).alias("future"),
    ).select(
        *P.SERIES, F.col("past.demand").alias("history"), F.col("future.date").alias("dates"),
        F.col("future.day_id").alias("day_ids"), F.col("future.actual_units").alias("actuals"),
        F.col("future.known").alias("known"),
    )


def history_features(history: np.ndarray) -> np.ndarray:
    """History features of one day per series, from a matrix of the previous days."""
    columns = [history[:, -k] for k in P.LAGS]
    means = {}
    for days in P.ROLLING:
        window = history[:, -days:]
        means[days] = window.mean(axis=1)
        columns += [means[days], window.std(axis=1, ddof=1), (window == 0).mean(axis=1)]
    columns.append(means[7] - means[28])
    return np.column_stack(columns)


Score = Callable[[np.ndarray], np.ndarray]


def recursive_forecast(state: DataFrame, score: Score, model: str, codes: Sequence[str] = ()) -> DataFrame:
    """Forecast every holdout day of every series.

    score maps a matrix (the state's columns named by codes, then P.FEATURES) to demand.
    """
    def advance(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            history = np.array(batch["history"].tolist(), dtype=float)
            known = np.array([[list(day) for day in days] for days in batch["known"]], dtype=float)
            own = batch[list(codes)].to_numpy(dtype=float)
            predictions = []
            for step in range(known.shape[1]):
                x = np.hstack([own, known[:, step, :], history_features(history)])
                predicted = np.maximum(score(x), 0.0)
                predictions.append(predicted)
                history = np.hstack([history[:, 1:], predicted[:, None]])
            out = batch[[*P.SERIES, "day_ids", "dates", "actuals"]].copy()
            out["predictions"] = list(np.column_stack(predictions))
            yield out

    schema = "store_id string, item_id string, day_ids array<string>, dates array<date>, actuals array<double>, predictions array<double>"
    days = state.mapInPandas(advance, schema).select(
        *P.SERIES, F.posexplode(F.arrays_zip("day_ids", "dates", "actuals", "predictions")).alias("step", "day")
    )
    return days.select(
        F.lit(model).alias("model"), (F.col("step") + 1).alias("forecast_step"), *P.SERIES,
        F.col("day.day_ids").alias("day_id"), F.col("day.dates").alias("date"),
        F.col("day.actuals").alias("actual_units"), F.col("day.predictions").alias("predicted_units"),
    )


def first_step_features(state: DataFrame) -> DataFrame:
    """The features the recursion sees on its first day, per series."""
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            history = np.array(batch["history"].tolist(), dtype=float)
            known = np.array([list(days[0]) for days in batch["known"]], dtype=float)
            out = pd.DataFrame(np.hstack([known, history_features(history)]), columns=P.FEATURES)
            out.insert(0, "item_id", batch["item_id"].to_numpy())
            out.insert(0, "store_id", batch["store_id"].to_numpy())
            yield out

    schema = "store_id string, item_id string, " + ", ".join(f"{c} double" for c in P.FEATURES)
    return state.mapInPandas(compute, schema)


def linear_score(x: np.ndarray) -> np.ndarray:
    """Stand-in model that a recursive query can reproduce: a blend of lags and the weekly mean."""
    lag_1, lag_7, mean_7 = (x[:, P.FEATURES.index(c) - len(P.FEATURES)] for c in ("lag_1", "lag_7", "rolling_mean_7"))
    return 0.2 * lag_1 + 0.3 * lag_7 + 0.4 * mean_7
