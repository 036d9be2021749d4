"""Series panels and the holdout boundary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from demandloom import params as P


def sales_panel(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales with their date. The calendar has one row per day: broadcast."""
    days = calendar.select("day_id", "date")
    return sales.join(F.broadcast(days), "day_id").select(*P.SERIES, "day_id", "date", "units_sold")


def full_panel(sales: DataFrame, stores: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    """Sales with store, calendar and the price of the week, null before an item is priced."""
    return (
        sales.join(F.broadcast(calendar), "day_id")
        .join(stores, "store_id")
        .join(prices, ["store_id", "item_id", "wm_yr_wk"], "left")
    )


# Blocks of one horizon, counted back from the last day: 0 is the holdout, OLDER all days that no
# forecast rule, spread or recursion looks back to.
OLDER = -(-(P.HORIZON + P.UNCERTAINTY_DAYS) // P.HORIZON)


def time_block(last_day: Column) -> Column:
    """The block of a day number: the folders of the dense stage."""
    return F.least(F.floor((last_day - F.col("day_number")) / P.HORIZON), F.lit(OLDER)).cast("int")


def newest(panel: DataFrame, days: int, first: int = 0) -> DataFrame:
    """Blocks that hold the newest ``days`` days, from block ``first`` on; reads their folders only."""
    return panel.filter(F.col("block").between(first, (days - 1) // P.HORIZON))


def before_holdout(panel: DataFrame) -> DataFrame:
    return panel.filter(F.col("block") > 0)


def holdout_boundary(panel: DataFrame, days: int = P.HORIZON) -> DataFrame:
    """First and last date of the holdout: the last ``days`` distinct dates."""
    dates = panel.select("date").distinct().orderBy(F.desc("date")).limit(days)
    return dates.agg(F.min("date").alias("holdout_start"), F.max("date").alias("holdout_end"))


def holdout_start(panel: DataFrame) -> Column:
    """Start of the holdout as a scalar subquery."""
    return holdout_boundary(panel).select("holdout_start").scalar()


def training_slice(panel: DataFrame, start: Column) -> DataFrame:
    return panel.filter(F.col("date") < start)


def holdout_slice(panel: DataFrame, start: Column) -> DataFrame:
    return panel.filter(F.col("date") >= start)
