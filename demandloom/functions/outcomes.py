"""What an order quantity yields once demand is known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from demandloom import params as P


def whole_units(quantity: Column) -> Column:
    """Smallest whole order covering a quantity.

    Rounded to 9 decimals first: 28 x (3/7) summed in floating point is 12.000…02,
    which must order 12 units and not 13.
    """
    return F.ceil(F.round(F.greatest(F.lit(0.0), quantity), 9)).cast("long")


def fill_rate(served: Column, demand: Column) -> Column:
    """Percentage of demand served; 100 when there was none."""
    return F.when(demand == 0, F.lit(100.0)).otherwise(F.try_divide(served, demand) * 100)


def with_outcomes(df: DataFrame, ordered: str, total: str) -> DataFrame:
    """Served, short and left-over units and their costs against ``actual_demand_units``."""
    demand, quantity = F.col("actual_demand_units"), F.col(ordered).cast("double")
    return (
        df.withColumn("served_units", F.least(quantity, demand))
        .withColumn("shortage_units", F.greatest(demand - quantity, F.lit(0.0)))
        .withColumn("leftover_units", F.greatest(quantity - demand, F.lit(0.0)))
        .withColumn("fill_rate_percent", fill_rate(F.col("served_units"), demand))
        .withColumn("stockout_occurred", (F.col("shortage_units") > 0).cast("int"))
        .withColumn("holding_cost_units", F.col("leftover_units") * P.HOLDING_COST)
        .withColumn("shortage_cost_units", F.col("shortage_units") * P.SHORTAGE_COST)
        .withColumn(total, F.col("holding_cost_units") + F.col("shortage_cost_units"))
    )


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """Round every double column for display.

    Half-way cases are nudged up, so that the result does not depend on which side the
    binary value of a decimal fraction falls.
    """
    return df.select(*[
        F.round(F.col(name) + 1e-9, digits).alias(name) if kind == "double" else F.col(name) for name, kind in df.dtypes
    ])
