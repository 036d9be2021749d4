"""Forecast-accuracy aggregates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def accuracy(actual: str = "actual_units", predicted: str = "predicted_units", digits: int | None = 4) -> list[Column]:
    """mae, rmse, bias and wape_percent; the last is null when nothing was sold."""
    error = F.col(predicted) - F.col(actual)
    measures = {
        "mae": F.avg(F.abs(error)),
        "rmse": F.sqrt(F.avg(error * error)),
        "bias": F.avg(error),
        "wape_percent": F.try_divide(100.0 * F.sum(F.abs(error)), F.sum(F.abs(F.col(actual)))),
    }
    return [(c if digits is None else F.round(c, digits)).alias(n) for n, c in measures.items()]


def demand_pattern(zero_percentage: Column, mean: Column, floors, regular: str = "regular") -> Column:
    """Pattern of a series from its (unrounded) share of days without sales."""
    result = F.when(mean == 0, F.lit("no_training_demand"))
    for floor, name in floors:
        result = result.when(zero_percentage >= floor, F.lit(name))
    return result.otherwise(F.lit(regular))
