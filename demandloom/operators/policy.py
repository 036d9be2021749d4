"""Order policies from forecasts and their uncertainty, judged on held-out demand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from demandloom import params as P
from demandloom.functions.outcomes import fill_rate, whole_units, with_outcomes


def horizon_totals(forecasts: DataFrame) -> DataFrame:
    """Forecast and actual demand per model and series over the whole horizon."""
    return forecasts.groupBy("model", *P.SERIES).agg(
        F.sum("predicted_units").alias("forecast_total_units"),
        F.sum("actual_units").alias("actual_total_units"),
        F.min("date").alias("forecast_start"),
        F.max("date").alias("forecast_end"),
        F.countDistinct("date").alias("forecast_days"),
    )


def demand_uncertainty(panel: DataFrame, start: Column) -> DataFrame:
    """Spread of 28-day demand totals over the last 365 training days.

    The days are cut into blocks of one horizon, counted back from the holdout. A total that ends at a
    place of a block is the block's running total up to the place, plus what the block before holds
    after it; so one aggregate per (series, block) and a look at the block before give all totals.
    A total counts only if all its days are there (``present`` has a bit for each day of a block).
    """
    back = F.datediff(start, F.col("date")) - 1
    place = P.HORIZON - 1 - F.col("back") % P.HORIZON  # 0 = first day of the block
    whole = (1 << P.HORIZON) - 1
    running = [F.coalesce(F.sum(F.when(place <= k, F.col("units_sold"))), F.lit(0)) for k in range(P.HORIZON)]
    blocks = (
        panel.withColumn("back", back).filter(F.col("back").between(0, P.UNCERTAINTY_DAYS - 1))
        .filter(F.col("units_sold").isNotNull())
        .groupBy(*P.SERIES, F.floor(F.col("back") / P.HORIZON).cast("int").alias("block"))
        .agg(F.array(*running).alias("running"), F.bit_or(F.expr(f"shiftleft(1, {P.HORIZON - 1} - back % {P.HORIZON})")).alias("present"))
    )
    earlier = F.lead(F.struct("block", "running", "present")).over(Window.partitionBy(*P.SERIES).orderBy("block"))
    pairs = blocks.withColumn("earlier", earlier).withColumn(
        "before", F.when(F.col("earlier.block") == F.col("block") + 1, F.col("earlier"))
    )
    totals = []
    for k in range(P.HORIZON):
        mine = (1 << (k + 1)) - 1
        theirs = whole - mine
        rest = F.col("before.running")[P.HORIZON - 1] - F.col("before.running")[k]
        here = F.col("present").bitwiseAND(F.lit(mine)) == mine
        if theirs:
            there = F.coalesce(F.col("before.present").bitwiseAND(F.lit(theirs)) == theirs, F.lit(False))
            totals.append(F.when(here & there, F.col("running")[k] + rest))
        else:
            totals.append(F.when(here, F.col("running")[k]))
    return pairs.select(*P.SERIES, F.explode(F.array(*totals)).alias("total")).filter(
        F.col("total").isNotNull()
    ).groupBy(*P.SERIES).agg(
        F.coalesce(F.stddev_samp("total"), F.lit(0.0)).alias("uncertainty_std_28"),
        F.count(F.lit(1)).alias("uncertainty_windows"),
    )


def inventory_policies(
    totals: DataFrame, uncertainty: DataFrame, factor: float = P.SERVICE_FACTOR
) -> DataFrame:
    """Two rows per model and series: order the forecast, or add safety stock to it.

    A series without a spread (too few days) stays, with a null order in the second row.
    """
    demand = totals.select(
        F.col("model").alias("forecast_model"), *P.SERIES, "forecast_total_units",
        F.col("actual_total_units").cast("double").alias("actual_demand_units"),
    ).join(uncertainty.select(*P.SERIES, "uncertainty_std_28"), P.SERIES, "left")
    orders = demand.withColumn("service_factor", F.lit(factor)).withColumn(
        "point", whole_units(F.col("forecast_total_units"))
    ).withColumn(
        "adjusted", F.when(
            F.col("uncertainty_std_28").isNotNull(),
            whole_units(F.col("forecast_total_units") + factor * F.col("uncertainty_std_28")),
        )
    )
    policies = F.array(
        F.struct(F.lit(P.POINT_POLICY).alias("inventory_policy"), F.col("point").alias("order_quantity")),
        F.struct(F.lit(P.NEWSVENDOR_POLICY).alias("inventory_policy"), F.col("adjusted").alias("order_quantity")),
    )
    rows = orders.select(
        "forecast_model", *P.SERIES, "forecast_total_units", "actual_demand_units", "uncertainty_std_28",
        "service_factor", "point", F.inline(policies),
    ).withColumn(
        "safety_stock_units", F.greatest(F.col("order_quantity") - F.col("point"), F.lit(0).cast("long"))
    )
    return with_outcomes(rows, "order_quantity", "total_cost_units").select(
        "forecast_model", "inventory_policy", *P.SERIES, "forecast_total_units", "actual_demand_units",
        "uncertainty_std_28", "service_factor", "safety_stock_units", "order_quantity", "served_units",
        "shortage_units", "leftover_units", "fill_rate_percent", "stockout_occurred", "holding_cost_units",
        "shortage_cost_units", "total_cost_units",
    )


def policy_summary(policies: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Service and cost per group, rounded to 2 decimals after summing."""
    def total(column: str, name: str | None = None) -> Column:
        return F.sum(column).alias(name or column)
    sums = policies.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("number_of_series"),
        total("forecast_total_units", "forecast_units"), total("actual_demand_units"),
        total("order_quantity", "ordered_units"), total("served_units"), total("shortage_units"),
        total("leftover_units"), total("stockout_occurred", "stockout_series"),
        total("holding_cost_units"), total("shortage_cost_units"), total("total_cost_units"),
    )
    derived = sums.withColumn(
        "fill_rate_percent", fill_rate(F.col("served_units"), F.col("actual_demand_units"))
    ).withColumn(
        "stockout_series_percent", F.col("stockout_series") / F.col("number_of_series") * 100
    ).withColumn("average_cost_per_series", F.col("total_cost_units") / F.col("number_of_series"))
    return derived.select(*[
        F.round(n, 2).alias(n) if kind == "double" else F.col(n) for n, kind in derived.dtypes
    ])
