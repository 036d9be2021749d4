"""Maps the transactional source tables onto the retail star schema.

``lineitem`` is the only table that grows without bound in rows per day. It is read
once: five columns, joined to its part and supplier, and summed to one row per
(store, item, day). The sum combines before its shuffle, so a store, item or part
with a third of all lines reaches the shuffle as at most one row per day and task;
the joins are on dimension keys with one row each, which adaptive execution splits
when a key is hot. No side is forced to broadcast: parts and suppliers grow with the
data, and the engine decides from their sizes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from demandloom import params as P
from demandloom.sources.tables import scan_filtered


@dataclass(frozen=True)
class Grain:
    """What counts as a store and as an item."""

    store: str = "region"  # or "nation"
    item: str = "brand"    # or "part"


# Fixed rule table of calendar events: (month, day, name, type).
EVENTS = [
    (1, 1, "NewYear", "National"),
    (2, 14, "ValentinesDay", "Cultural"),
    (3, 17, "StPatricksDay", "Cultural"),
    (5, 5, "Cinco De Mayo", "Cultural"),
    (7, 4, "IndependenceDay", "National"),
    (10, 31, "Halloween", "Cultural"),
    (11, 11, "VeteransDay", "National"),
    (12, 25, "Christmas", "National"),
]


def places(spark: SparkSession, folder: str, grain: Grain) -> DataFrame:
    """n_nationkey -> store_id, state_id."""
    nations = scan_filtered(spark, folder, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    regions = scan_filtered(spark, folder, "region", ["r_regionkey", "r_name"])
    name = F.col("r_name") if grain.store == "region" else F.col("n_name")
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        "n_nationkey",
        F.replace(name, F.lit(" "), F.lit("_")).alias("store_id"),
        F.substring("r_name", 1, 2).alias("state_id"),
    )


def item_lookup(spark: SparkSession, folder: str, grain: Grain) -> DataFrame:
    """p_partkey -> item_id, dept_id, cat_id."""
    parts = scan_filtered(spark, folder, "part", ["p_partkey", "p_brand"])
    if grain.item == "brand":
        number = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("long")
        item = F.replace(F.col("p_brand"), F.lit("#"), F.lit("_"))
    else:
        number = F.col("p_partkey")
        item = F.concat(F.lit("Part_"), F.col("p_partkey").cast("string"))
    return parts.select(
        "p_partkey",
        item.alias("item_id"),
        F.concat(F.lit("DEPT_"), (number % 6).cast("string")).alias("dept_id"),
        F.concat(F.lit("CAT_"), (number % 3).cast("string")).alias("cat_id"),
    )


def daily_totals(spark: SparkSession, folder: str, grain: Grain) -> DataFrame:
    """store_id, item_id, date, units, revenue, fractions: one row per day with sales.

    Lines of unknown parts, suppliers or nations stay, with a null item or store; ``fractions`` counts
    the lines whose quantity is no whole number. The stage's rules stop on both.
    """
    lines = scan_filtered(
        spark, folder, "lineitem", ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    )
    suppliers = scan_filtered(spark, folder, "supplier", ["s_suppkey", "s_nationkey"])
    items = item_lookup(spark, folder, grain).select("p_partkey", "item_id")
    stores = places(spark, folder, grain).select("n_nationkey", "store_id")
    # One table per join, so that each side's size is its file size and not a guess.
    return (
        lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey, "left")
        .join(items, lines.l_partkey == items.p_partkey, "left")
        .join(stores, F.col("s_nationkey") == stores.n_nationkey, "left")
        .groupBy("store_id", "item_id", F.to_date("l_shipdate").alias("date"))
        .agg(
            F.sum("l_quantity").cast("long").alias("units"),
            F.sum("l_extendedprice").alias("revenue"),
            F.count_if(F.col("l_quantity") != F.floor("l_quantity")).alias("fractions"),
        )
    )


def week_code(date: Column) -> Column:
    """Integer code of the week that starts on the Saturday on or before a date."""
    start = F.date_sub(date, F.dayofweek(date) % 7)
    return (F.year(start) * 100 + F.floor((F.dayofyear(start) - 1) / 7) + 1).cast("int")


def _event(position: int) -> Column:
    result = F.lit(None).cast("string")
    for event in EVENTS:
        hit = (F.month("date") == event[0]) & (F.dayofmonth("date") == event[1])
        result = F.when(hit, F.lit(event[position])).otherwise(result)
    return result


def calendar(daily: DataFrame) -> DataFrame:
    """Every day from the first to the last sale, with week, event and assistance flags."""
    days = daily.agg(F.min("date").alias("first"), F.max("date").alias("last")).select(
        F.posexplode(F.sequence("first", "last")).alias("position", "date")
    )
    mothers_day = (F.month("date") == 5) & (F.dayofweek("date") == 1) & F.dayofmonth("date").between(8, 14)
    snap = []
    for state in P.SNAP_STATES:
        offset = (ord(state[0]) + ord(state[1])) % 5
        snap.append(F.dayofmonth("date").between(1 + offset, 10 + offset).cast("int").alias(f"snap_{state}"))
    return days.select(
        F.concat(F.lit("d_"), (F.col("position") + 1).cast("string")).alias("day_id"),
        "date",
        week_code(F.col("date")).alias("wm_yr_wk"),
        F.date_format("date", "EEEE").alias("weekday"),
        (F.dayofweek("date") % 7 + 1).alias("wday"),
        F.month("date").alias("month"),
        F.year("date").alias("year"),
        _event(2).alias("event_name_1"),
        _event(3).alias("event_type_1"),
        F.when(mothers_day, F.lit("MothersDay")).alias("event_name_2"),
        F.when(mothers_day, F.lit("Cultural")).alias("event_type_2"),
        *snap,
    )


def weekly_prices(daily: DataFrame) -> DataFrame:
    """Average paid price per store, item and week; weeks without sales have no price."""
    return (
        daily.groupBy("store_id", "item_id", week_code(F.col("date")).alias("wm_yr_wk"))
        .agg(F.sum("revenue").alias("revenue"), F.sum("units").alias("units"))
        .filter(F.col("units") > 0)
        .select("store_id", "item_id", "wm_yr_wk", (F.col("revenue") / F.col("units")).alias("sell_price"))
    )


def dense_days(daily: DataFrame, days: DataFrame) -> DataFrame:
    """One row per series and calendar day, zero where nothing was sold.

    Each observed day emits the empty days up to the next one (and, if first, those
    before it), so no spine is built and nothing is joined: one shuffle per series,
    which never has more rows than the calendar has days.
    """
    first = days.agg(F.min("date")).scalar()
    last = days.agg(F.max("date")).scalar()
    history = Window.partitionBy(*P.SERIES).orderBy("date")
    spans = daily.select(*P.SERIES, F.col("date").alias("sold_on"), "units").select(
        "*",
        F.lag("sold_on").over(history.orderBy("sold_on")).alias("previous"),
        F.lead("sold_on").over(history.orderBy("sold_on")).alias("following"),
    )
    start = F.when(F.col("previous").isNull(), first).otherwise(F.col("sold_on"))
    stop = F.coalesce(F.date_sub("following", 1), last)
    return spans.select(*P.SERIES, "sold_on", "units", F.explode(F.sequence(start, stop)).alias("date")).select(
        *P.SERIES,
        "date",
        (F.datediff("date", first) + 1).alias("day_number"),
        F.when(F.col("date") == F.col("sold_on"), F.col("units")).otherwise(F.lit(0)).alias("units_sold"),
    )
