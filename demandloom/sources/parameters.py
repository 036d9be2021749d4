"""Tables that record the assumptions behind a result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandloom import params as P

SCHEMA = "assumption string, value string"


def policy_assumptions(spark: SparkSession) -> DataFrame:
    return _table(spark, [
        ("forecast_horizon_days", P.HORIZON),
        ("uncertainty_lookback_days", P.UNCERTAINTY_DAYS),
        ("holding_cost_per_leftover_unit", P.HOLDING_COST),
        ("shortage_cost_per_unserved_unit", P.SHORTAGE_COST),
        ("critical_ratio", round(P.CRITICAL_RATIO, 4)),
        ("normal_service_factor", round(P.SERVICE_FACTOR, 4)),
        ("cost_unit_interpretation", "costs compare orders with each other; they are no amounts of money"),
    ])


def constrained_assumptions(spark: SparkSession, source_model: str = P.BOOSTING) -> DataFrame:
    rows = [
        ("source_forecast_model", source_model),
        ("source_inventory_policy", P.NEWSVENDOR_POLICY),
        ("procurement_cost_share_of_sell_price", P.PROCUREMENT_SHARE),
        ("minimum_target_coverage", P.MINIMUM_COVERAGE),
        ("holding_cost_per_unit", P.HOLDING_COST),
        ("shortage_cost_per_unit", P.SHORTAGE_COST),
        ("capacity_interpretation", "a store's room is a number of units, as the tables hold no sizes"),
        ("cost_interpretation", "spend follows from an assumed share of the sell price; shortage and holding costs only compare orders"),
    ]
    for name, budget, capacity in P.RESOURCE_SCENARIOS:
        rows += [(f"{name}_budget_ratio", budget), (f"{name}_capacity_ratio", capacity)]
    return _table(spark, rows)


def stochastic_assumptions(spark: SparkSession) -> DataFrame:
    rows = [
        ("stochastic_objective", "mean of shortage and holding cost over the demand scenarios"),
        ("shortage_cost_per_unit", P.SHORTAGE_COST),
        ("holding_cost_per_unit", P.HOLDING_COST),
        ("minimum_target_coverage", P.MINIMUM_COVERAGE),
        ("actual_holdout_usage", "held-out demand judges orders and never chooses them"),
    ]
    rows += [(f"demand_scenario_{n}", f"z={z}, probability={p}") for n, z, p in P.DEMAND_SCENARIOS]
    return _table(spark, rows)


def _table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame([(name, str(value)) for name, value in rows], SCHEMA)
