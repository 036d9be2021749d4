"""Stages stop on broken rules, and nothing is lost silently."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from demandloom.operators import allocate, gates, policy
from demandloom.operators.quality import DataQualityError
from demandloom.plans import catalog
from demandloom.plans.workspace import Workspace
from tests.conftest import FOLDER

TABLES = ["region", "nation", "supplier", "part", "lineitem"]
DAY = dt.date(2001, 1, 1)


def broken_source(spark, folder, name, change):
    """The source tables with one of them changed."""
    for table in TABLES:
        if table == name:
            change(spark.read.parquet(f"{FOLDER}/{table}.parquet")).write.parquet(f"{folder}/{table}.parquet")
        else:
            shutil.copy(f"{FOLDER}/{table}.parquet", folder)
    return Workspace(spark, str(folder))


@pytest.mark.parametrize("table, change, rule", [
    ("part", lambda t: t.filter("p_partkey != 7"), "item_id_missing"),
    ("supplier", lambda t: t.filter("s_suppkey != 3"), "store_id_missing"),
    ("nation", lambda t: t.withColumn("n_regionkey", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_regionkey")).otherwise(99)), "store_id_missing"),
    ("lineitem", lambda t: t.withColumn("l_quantity", F.col("l_quantity") + F.when(F.col("l_linenumber") == 2, 0.5).otherwise(0)), "units_not_whole"),
    ("lineitem", lambda t: t.withColumn("l_shipdate", F.when(F.col("l_linenumber") != 3, F.col("l_shipdate"))), "date_missing"),
    ("lineitem", lambda t: t.withColumn("l_quantity", -F.col("l_quantity")), "units_negative"),
])
def test_broken_sources_stop_the_first_stage(spark, tmp_path, table, change, rule):
    ws = broken_source(spark, tmp_path, table, change)
    with pytest.raises(DataQualityError, match=rule):
        ws.policies
    assert "daily" not in vars(ws)


def test_rules_are_counted_in_the_writing_job(spark):
    rows = spark.createDataFrame([(1, 2.0), (2, None), (None, -1.0)], "k int, price double")
    rules = gates.known("k") | {"price": gates.fails(F.col("price") > 0)}
    seen = spark.sparkContext._jsc.sc().dagScheduler().nextJobId
    before = seen()
    with pytest.raises(DataQualityError, match=r"\{'k_missing': 1, 'price': 2\}"):
        gates.checked_stage(rows, "made", rules)
    assert seen() - before == 1
    good = gates.checked_stage(rows.filter("price > 0"), "made", rules, drop=["price"])
    assert good.columns == ["k"] and [tuple(r) for r in good.collect()] == [(1,)]


def test_empty_stages_break_no_rule(spark):
    empty = spark.createDataFrame([], "date date, wm_yr_wk int")
    assert gates.checked_stage(empty, "made", gates.calendar_rules()).count() == 0
    assert gates.checked_stage(empty.filter("false"), "made", gates.known("date")).count() == 0


def test_calendar_gaps_are_counted(spark):
    days = spark.createDataFrame([(DAY + dt.timedelta(k), 1) for k in (0, 1, 3)], "date date, wm_yr_wk int")
    with pytest.raises(DataQualityError, match="'days_off': -1"):
        gates.checked_stage(days, "made", gates.calendar_rules())


def test_series_without_spread_or_price_stay_and_stop_the_stage(spark):
    totals = spark.createDataFrame(
        [("m", "S", i, 3.0, 4) for i in "AB"], "model string, store_id string, item_id string, forecast_total_units double, actual_total_units long")
    spread = spark.createDataFrame([("S", "A", 1.0)], "store_id string, item_id string, uncertainty_std_28 double")
    policies = policy.inventory_policies(totals, spread)
    assert policies.count() == 4
    assert policies.filter("item_id = 'B' and inventory_policy = 'newsvendor_adjusted_order' and order_quantity is null").count() == 1
    with pytest.raises(DataQualityError, match="uncertainty_std_28_missing': 2"):
        gates.checked_stage(policies, "made", gates.policy_rules())
    plan = allocate.target_plan(policies.fillna(0.0, ["uncertainty_std_28"]).fillna(0, ["order_quantity"]), "m")
    prices = spark.createDataFrame([("S", "A", 2.0)], "store_id string, item_id string, average_sell_price double")
    weighted = allocate.priority_weights(plan, prices)
    assert weighted.count() == 2
    with pytest.raises(DataQualityError, match="average_sell_price_missing': 1"):
        gates.checked_stage(weighted, "made", gates.target_rules())


def test_broken_allocations_stop(spark):
    columns = ["allocated_order_quantity", "target_order_quantity", "operational_cost_units", "holding_cost_units", "shortage_cost_units"]
    rows = spark.createDataFrame([(1.0, 2.0, 3.0, 1.0, 2.0), (3.0, 2.0, 3.0, 1.0, 2.0), (-1.0, 2.0, 9.0, 1.0, 2.0)], columns)
    with pytest.raises(DataQualityError) as found:
        gates.checked_stage(rows, "made", gates.allocation_rules())
    assert all(f"'{rule}': 1" in str(found.value) for rule in gates.allocation_rules())


def test_problems_of_published_facts_are_found(spark, ws):
    tables = {name: table for name, (table, _) in catalog.bi_tables(ws, ws.allocation, ws.forecasts).items()}
    assert catalog.fact_problems(tables).filter("violations > 0").isEmpty()
    horizon = tables["fact_actual_horizon"]
    tables["fact_actual_horizon"] = horizon.unionByName(horizon.limit(1))
    tables["dim_store"] = tables["dim_store"].filter("store_id != 'ASIA'")
    tables["dim_model"] = tables["dim_model"].filter("model_id != 'adaptive_baseline'")
    found = {(r.fact_table, r.rule): r.violations for r in catalog.fact_problems(tables).filter("violations > 0").collect()}
    stores = {(fact, "store_id"): 1 for fact in catalog.FACT_RULES}
    models = {("fact_forecast_daily", "model_id"): 1, ("fact_inventory_policy", "model_id"): 1}
    assert found == stores | models | {("fact_actual_horizon", "key"): 1}
