"""The written stages: buckets by series, folders by block of days, and what their readers make of them."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from demandloom import params as P
from demandloom.operators import baselines, features, gates, panel, policy, recursive
from demandloom.operators.quality import DataQualityError
from demandloom.sources.storage import Layout, drop_tables, materialise

DAY = dt.date(2020, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df, over: str) -> list[str]:
    """Exchanges of the main path that deal rows by a column; scalar subqueries on the calendar have their own."""
    return [line for line in plan(df).splitlines() if "Exchange hashpartitioning" in line and over in line]


def partition_filters(df) -> list[str]:
    return [line.split("PartitionFilters: ")[1].split("]")[0] for line in plan(df).splitlines()
            if "FileScan" in line and "/dense-" in line]


def test_training_features_deal_no_rows(ws):
    result = features.training_features(ws.features, ws.start)
    assert exchanges(result, "item_id") == []
    assert all("block" in filters for filters in partition_filters(result)) and partition_filters(result)


@pytest.mark.parametrize("stage, blocks", [
    (lambda ws: baselines.candidate_forecasts(ws.near, ws.last_day), set(range(P.BACKTEST_WINDOWS + 2))),
    (lambda ws: ws.uncertainty, set(range(1, panel.OLDER))),
    (lambda ws: recursive.forecast_state(panel.newest(ws.panel, P.HORIZON + recursive.HISTORY), ws.start), {0, 1}),
])
def test_recent_days_read_their_folders_only(ws, stage, blocks):
    result = stage(ws)
    assert partition_filters(result) and all("block" in filters for filters in partition_filters(result))
    assert exchanges(result, "item_id") == []
    files = {name.split("block=")[1].split("/")[0] for name in result.inputFiles() if "block=" in name}
    assert {int(block) for block in files} == blocks


def test_blocks_hold_the_days_they_stand_for(ws):
    start = ws.dense.agg(F.max("date")).first()[0] - dt.timedelta(P.HORIZON - 1)
    rows = ws.dense.groupBy("block").agg(F.min("date").alias("first"), F.max("date").alias("last")).collect()
    spans = {row["block"]: (row["first"], row["last"]) for row in rows}
    assert spans[0][0] == start
    for block in range(1, panel.OLDER):
        assert spans[block] == (start - dt.timedelta(28 * block), start - dt.timedelta(28 * (block - 1) + 1))
    # the oldest day of the spread lies in the last folder of its own
    assert spans[panel.OLDER][1] < start - dt.timedelta(P.UNCERTAINTY_DAYS)


def test_a_broken_bucketed_stage_stops(spark):
    rows = spark.createDataFrame([("s", "i", 1), ("s", None, 2), ("t", "i", -1)], "store_id string, item_id string, units_sold long")
    rules = gates.known("item_id") | {"negative": gates.fails(F.col("units_sold") >= 0)}
    layout = Layout(P.SERIES, 3)
    with pytest.raises(DataQualityError) as broken:
        gates.checked_stage(layout.deal(rows), "broken", rules, layout=layout)
    assert "item_id_missing': 1" in str(broken.value) and "negative': 1" in str(broken.value)


def test_layouts_keep_rows_and_leave_the_catalog(spark):
    rows = spark.createDataFrame([("s", str(k % 7), k % 3, k) for k in range(100)], "store_id string, item_id string, block int, units_sold long")
    layout = Layout(P.SERIES, 4, order=(*P.SERIES, "units_sold"), partition="block")
    empty = materialise(rows.filter("units_sold < 0"), "nothing", layout)
    assert empty.count() == 0 and set(empty.columns) == set(rows.columns)
    written = materialise(layout.deal(rows), "kept", layout)
    assert sorted(written.select(rows.columns).collect()) == sorted(rows.collect())
    assert exchanges(written.groupBy("item_id", "store_id", "block").count(), "item_id") == []
    own = {name for name in tables(spark) if "_kept_" in name or "_nothing_" in name}
    others = tables(spark) - own
    drop_tables(spark, only=sorted(own))
    assert len(own) == 2 and tables(spark) == others


def tables(spark) -> set[str]:
    return {table.name for table in spark.catalog.listTables()}


def brute_spread(days: dict[dt.date, int], start: dt.date):
    ends = [start - dt.timedelta(k) for k in range(1, P.UNCERTAINTY_DAYS + 1)]
    first = ends[-1]
    totals = []
    for end in ends:
        window = [end - dt.timedelta(k) for k in range(P.HORIZON)]
        if window[-1] >= first and all(day in days for day in window):
            totals.append(sum(days[day] for day in window))
    return (statistics.stdev(totals) if len(totals) > 1 else 0.0, len(totals)) if totals else None


@pytest.mark.parametrize("seed, length, holes", [(0, 400, 0), (1, 365, 0), (2, 366, 2), (3, 100, 1), (4, 28, 0), (5, 27, 0), (6, 600, 5)])
def test_spread_from_blocks_equals_every_window(spark, seed, length, holes):
    """Series longer and shorter than the year, and days that are missing or unknown."""
    draw = random.Random(seed)
    start = DAY + dt.timedelta(length)
    missing = set(draw.sample(range(length), holes))
    days = {DAY + dt.timedelta(k): draw.choice([0, 0, 3, 10**9 + draw.randrange(100)]) for k in range(length) if k not in missing}
    rows = [("s", "i", day, units) for day, units in days.items()]
    rows += [("s", "i", DAY + dt.timedelta(k), None) for k in list(missing)[:1]]
    rows += [("s", "i", start + dt.timedelta(k), 7) for k in range(28)]  # the holdout takes no part
    frame = spark.createDataFrame(rows, "store_id string, item_id string, date date, units_sold long")
    got = policy.demand_uncertainty(frame, F.lit(start)).collect()
    expected = brute_spread(days, start)
    if expected is None:
        assert got == []
    else:
        assert got[0].uncertainty_windows == expected[1]
        assert got[0].uncertainty_std_28 == pytest.approx(expected[0], rel=1e-9, abs=1e-6)
