"""Business questions over the star schema.

Sums come from the days with sales; days without are counted, not built: a series has one record per calendar day,
so its records are the calendar's days and its zeros those less the days on which it sold. ``observed`` has
store_id, item_id, date and units of the days with sales.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from demandloom import params as P


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def series_totals(observed: DataFrame) -> DataFrame:
    """store_id, item_id, units, sold_days: one row per series, combined before its only shuffle."""
    return observed.groupBy(*P.SERIES).agg(F.sum("units").alias("units"), _count(F.col("units") != 0).alias("sold_days"))


def _days(calendar: DataFrame) -> Column:
    return calendar.agg(F.count(F.lit(1))).scalar()


def dataset_coverage(observed: DataFrame, calendar: DataFrame) -> DataFrame:
    return series_totals(observed).agg(
        F.countDistinct("item_id").alias("number_of_items"),
        F.countDistinct("store_id").alias("number_of_stores"),
        F.count(F.lit(1)).alias("series"),
        F.sum("units").alias("total_units_sold"),
    ).withColumn("number_of_days", _days(calendar)).select(
        "number_of_items", "number_of_stores", "number_of_days", (F.col("series") * F.col("number_of_days")).alias("number_of_sales_records"), "total_units_sold",
    )


def _records(observed: DataFrame, calendar: DataFrame, key: str) -> DataFrame:
    """key, total_units_sold, series, records, sold: per store or item, over all calendar days."""
    return series_totals(observed).groupBy(key).agg(
        F.sum("units").alias("total_units_sold"), F.count(F.lit(1)).alias("series"), F.sum("sold_days").alias("sold"),
    ).withColumn("records", F.col("series") * _days(calendar))


def sales_by_store(observed: DataFrame, calendar: DataFrame, stores: DataFrame) -> DataFrame:
    zero = F.col("records") - F.col("sold")
    return _records(observed, calendar, "store_id").join(stores, "store_id").select(
        "store_id", "state_id", "total_units_sold",
        F.round(F.col("total_units_sold") / F.col("records"), 3).alias("average_units_per_product_day"),
        zero.alias("zero_sales_records"),
        F.round(100.0 * zero / F.col("records"), 2).alias("zero_sales_percentage"),
    ).orderBy(F.desc("total_units_sold"), "store_id")


def priced_weeks(observed: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    """Every price of a series and week with the units sold in it and the calendar days it covers.

    The calendar has one row per day: its weeks are broadcast.
    """
    weeks = F.broadcast(calendar.groupBy("wm_yr_wk").agg(F.count(F.lit(1)).alias("days")))
    dates = F.broadcast(calendar.select("date", "wm_yr_wk"))
    keys = [*P.SERIES, "wm_yr_wk"]
    weekly = observed.join(dates, "date").groupBy(*keys).agg(F.sum("units").alias("units"))
    return prices.join(weeks, "wm_yr_wk").join(weekly, keys, "left").withColumn("units", F.coalesce("units", F.lit(0)))


def revenue_by_store(priced: DataFrame) -> DataFrame:
    revenue = F.sum(F.col("units") * F.col("sell_price"))
    units = F.sum("units")
    return priced.groupBy("store_id").agg(
        F.round(revenue, 2).alias("estimated_revenue"),
        units.alias("total_units_sold"),
        F.round(F.try_divide(revenue, units), 2).alias("average_revenue_per_unit"),
    ).orderBy(F.desc("estimated_revenue"), "store_id")


def top_products_by_demand(observed: DataFrame, calendar: DataFrame, items: DataFrame, limit: int = 10) -> DataFrame:
    """Items are aggregated and cut to the top before the item dimension is joined."""
    top = _records(observed, calendar, "item_id").select(
        "item_id", "total_units_sold",
        F.round(F.col("total_units_sold") / F.col("records"), 3).alias("average_daily_units"),
        F.col("series").alias("stores_represented"),
    ).join(items.select("item_id"), "item_id", "left_semi").orderBy(
        F.desc("total_units_sold"), "item_id"
    ).limit(limit)
    return items.select("item_id", "dept_id").join(top, "item_id").orderBy(F.desc("total_units_sold"), "item_id")


def top_products_by_revenue(priced: DataFrame, limit: int = 10) -> DataFrame:
    """A price counts once for every day it holds."""
    return priced.groupBy("item_id").agg(
        F.round(F.sum(F.col("units") * F.col("sell_price")), 2).alias("estimated_revenue"),
        F.sum("units").alias("total_units_sold"),
        F.round(F.sum(F.col("days") * F.col("sell_price")) / F.sum("days"), 2).alias("average_sell_price"),
    ).orderBy(F.desc("estimated_revenue"), "item_id").limit(limit)


def _average_by(observed: DataFrame, calendar: DataFrame, keys: list[str]) -> DataFrame:
    """Every day has a record of each series; a day's units are summed before they meet the calendar."""
    daily = observed.groupBy("date").agg(F.sum("units").alias("units"))
    series = observed.select(*P.SERIES).distinct().agg(F.count(F.lit(1))).scalar()
    return (
        calendar.select("date", *keys).join(daily, "date", "left").groupBy(*keys)
        .agg(F.coalesce(F.sum("units"), F.lit(0)).alias("total_units_sold"), F.count(F.lit(1)).alias("days"))
        .withColumn("average_units_per_record", F.round(F.col("total_units_sold") / (F.col("days") * series), 3))
        .drop("days").orderBy(*keys)
    )


def monthly_demand_trend(observed: DataFrame, calendar: DataFrame) -> DataFrame:
    return _average_by(observed, calendar, ["year", "month"])


def demand_by_weekday(observed: DataFrame, calendar: DataFrame) -> DataFrame:
    return _average_by(observed, calendar, ["wday", "weekday"])


def price_data_coverage(observed: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    """Days with sales and without a price of their week. The calendar has one row per day: broadcast."""
    dates = F.broadcast(calendar.select("date", "wm_yr_wk"))
    sold = observed.filter(F.col("units") > 0).join(dates, "date").join(prices, [*P.SERIES, "wm_yr_wk"], "left")
    known = _count(F.col("sell_price").isNotNull())
    return sold.agg(
        F.count(F.lit(1)).alias("positive_sales_records"),
        known.alias("records_with_price"),
        _count(F.col("sell_price").isNull()).alias("records_without_price"),
        F.round(F.try_divide(100.0 * known, F.count(F.lit(1))), 2).alias("price_coverage_percentage"),
    )


def load_summary(observed: DataFrame, calendar: DataFrame) -> DataFrame:
    return _records(observed, calendar, "store_id").select(
        "store_id", "total_units_sold", F.round(F.col("total_units_sold") / F.col("records"), 2).alias("average_daily_units"),
    ).orderBy(F.desc("total_units_sold"), "store_id")
