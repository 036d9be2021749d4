"""Stages that later work may read only if their rules hold.

A rule is an aggregate that must come to 0 (null counts as 0, as in an empty table). All rules of a
stage are observed metrics of the one job that writes it, so they cost no scan of their own; a task
that runs twice can only raise a count. A stage that breaks a rule raises ``DataQualityError`` with
its counts before anything reads it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from demandloom import params as P
from demandloom.operators.quality import DataQualityError
from demandloom.sources.storage import Layout, materialise


def fails(condition: Column) -> Column:
    """Rows for which a condition does not hold or is unknown."""
    return F.count_if(~F.coalesce(condition, F.lit(False)))


def known(*columns: str) -> dict[str, Column]:
    return {f"{c}_missing": fails(F.col(c).isNotNull()) for c in columns}


def checked_stage(
    df: DataFrame, name: str, rules: Mapping[str, Column], drop: Sequence[str] = (), layout: Layout | None = None
) -> DataFrame:
    """The written stage, less the columns that only its rules need."""
    seen = Observation()
    observed = df.observe(seen, *[rule.alias(rule_name) for rule_name, rule in rules.items()])
    written = materialise(observed.drop(*drop), name, layout)
    broken = {rule_name: count for rule_name, count in seen.get.items() if count}
    if broken:
        raise DataQualityError(f"{name}: {broken}")
    return written


# --- rules of the stages --------------------------------------------------------------------

def daily_rules() -> dict[str, Column]:
    """Every line has its store, item and day, and whole units."""
    return known("store_id", "item_id", "date", "units") | {
        "units_negative": fails(F.col("units") >= 0), "units_not_whole": F.coalesce(F.sum("fractions"), F.lit(0)),
    }


def calendar_rules() -> dict[str, Column]:
    """As many days as lie between the first and the last, and a week code for each."""
    return known("date", "wm_yr_wk") | {"days_off": F.count(F.lit(1)) - F.datediff(F.max("date"), F.min("date")) - 1}


def price_rules() -> dict[str, Column]:
    return {"price_not_positive": fails(F.col("sell_price") > 0)}


def dense_rules() -> dict[str, Column]:
    return known(*P.SERIES, "date", "day_id") | {"units_negative": fails(F.col("units_sold") >= 0)}


def forecast_rules() -> dict[str, Column]:
    return known("date", "actual_units") | {"forecast_negative": fails(F.col("predicted_units") >= 0)}


def policy_rules() -> dict[str, Column]:
    """Every series has a spread, and served and short units make up the demand."""
    served = F.col("served_units") + F.col("shortage_units") - F.col("actual_demand_units")
    return known("uncertainty_std_28") | {
        "order_negative": fails(F.col("order_quantity") >= 0), "demand_not_met_or_short": fails(F.abs(served) <= 1e-6),
    }


def target_rules() -> dict[str, Column]:
    """Every series has a price."""
    return known("average_sell_price", "priority_weight") | {
        "cost_not_positive": fails(F.col("unit_purchase_cost") > 0), "target_negative": fails(F.col("target_order_quantity") >= 0),
    }


def allocation_rules() -> dict[str, Column]:
    """Orders between 0 and the target, and costs that add up."""
    cost = F.col("operational_cost_units") - F.col("holding_cost_units") - F.col("shortage_cost_units")
    return {
        "allocation_negative": fails(F.col("allocated_order_quantity") >= 0),
        "allocation_above_target": fails(F.col("allocated_order_quantity") <= F.col("target_order_quantity")),
        "costs_do_not_add_up": fails(F.abs(cost) <= 1e-6),
    }
