"""Inverse of the normal distribution as a column expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Coefficients of Acklam's rational approximation
# (relative error below 1.2e-9).
CENTRE_NUM = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
              1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
CENTRE_DEN = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
              6.680131188771972e+01, -1.328068155288572e+01, 1.0]
TAIL_NUM = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
            -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
TAIL_DEN = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
            3.754408661907416e+00, 1.0]
TAIL = 0.02425


def _poly(coefficients: list[float], x: Column) -> Column:
    result = F.lit(coefficients[0])
    for c in coefficients[1:]:
        result = result * x + F.lit(c)
    return result


def _tail(p: Column) -> Column:
    q = F.sqrt(-2.0 * F.log(p))
    return _poly(TAIL_NUM, q) / _poly(TAIL_DEN, q)


def normal_quantile(p: Column) -> Column:
    """z with P(Z <= z) = p; null outside (0, 1)."""
    centred = p - 0.5
    squared = centred * centred
    centre = centred * _poly(CENTRE_NUM, squared) / _poly(CENTRE_DEN, squared)
    return (
        F.when((p <= 0) | (p >= 1) | p.isNull(), F.lit(None).cast("double"))
        .when(p < TAIL, _tail(p))
        .when(p > 1 - TAIL, -_tail(1 - p))
        .otherwise(centre)
    )


def service_factor(shortage_cost: Column, holding_cost: Column) -> Column:
    """Newsvendor factor: quantile of the critical ratio."""
    return normal_quantile(F.try_divide(shortage_cost, shortage_cost + holding_cost))
