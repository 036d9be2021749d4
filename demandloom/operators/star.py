"""Star-schema construction from wide sales, calendar and price tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def filter_department_stores(sales: DataFrame, dept_id: str, stores: Sequence[str]) -> DataFrame:
    return sales.filter((F.col("dept_id") == dept_id) & F.col("store_id").isin(list(stores)))


def common_items(sales: DataFrame, stores: Sequence[str], limit: int) -> DataFrame:
    """First ``limit`` items, by id, that every one of the stores sells."""
    pairs = sales.filter(F.col("store_id").isin(list(stores))).select("item_id", "store_id")
    return (
        pairs.groupBy("item_id").agg(F.countDistinct("store_id").alias("stores"))
        .filter(F.col("stores") == len(set(stores)))
        .select("item_id").orderBy("item_id").limit(limit)
    )


def require_items(items: DataFrame, wanted: int) -> DataFrame:
    """Fail the job when fewer items than wanted remain."""
    return items.filter(
        F.when(items.agg(F.count(F.lit(1))).scalar() >= wanted, F.lit(True))
        .otherwise(F.raise_error(F.lit(f"fewer than {wanted} common items")).cast("boolean"))
    )


def keep_items(sales: DataFrame, items: DataFrame) -> DataFrame:
    return sales.join(items, "item_id", "left_semi")


def item_dimension(sales: DataFrame) -> DataFrame:
    return sales.select("item_id", "dept_id", "cat_id").distinct()


def store_dimension(sales: DataFrame) -> DataFrame:
    return sales.select("store_id", "state_id").distinct()


def day_columns(wide: DataFrame) -> list[str]:
    return [name for name in wide.columns if name.startswith("d_")]


def unpivot_sales(wide: DataFrame) -> DataFrame:
    """One row per (item, store, day column)."""
    return wide.unpivot(["item_id", "store_id"], day_columns(wide), "day_id", "units_sold")


def with_day_number(sales: DataFrame) -> DataFrame:
    """Numeric position of ``d_17``: order by it, not by the text."""
    return sales.withColumn("day_number", F.regexp_replace("day_id", "^d_", "").cast("int"))


def sales_calendar(raw_calendar: DataFrame, sales: DataFrame) -> DataFrame:
    """Calendar rows whose day occurs in the sales; days are made distinct before the join."""
    return (
        raw_calendar.withColumnRenamed("d", "day_id").withColumn("date", F.to_date("date"))
        .join(sales.select("day_id").distinct(), "day_id", "left_semi")
    )


def selected_prices(prices: DataFrame, stores: DataFrame, items: DataFrame) -> DataFrame:
    """Prices of the selected stores and items."""
    return (
        prices.join(stores.select("store_id"), "store_id", "left_semi")
        .join(items.select("item_id"), "item_id", "left_semi")
        .select("store_id", "item_id", "wm_yr_wk", "sell_price")
    )
