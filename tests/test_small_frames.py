"""Hand-made frames for the cases where a plausible implementation goes wrong."""

import datetime as dt
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from demandloom import params as P
from demandloom.functions.metrics import demand_pattern
from demandloom.functions.normal import normal_quantile
from demandloom.functions.outcomes import whole_units
from demandloom.operators import accuracy, baselines, bi, features, panel, policy, quality, star
from demandloom.sources import parameters, retail, tables

DAY = dt.date(2001, 1, 1)


def series(spark, values, store="S", item="A"):
    rows = [(store, item, DAY + dt.timedelta(k), k + 1, f"d_{k + 1}", int(v)) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, "store_id string, item_id string, date date, day_number int, day_id string, units_sold long")


def candidates(spark, values):
    return baselines.candidate_forecasts(series(spark, values), F.lit(len(values)))


def test_whole_units_ignores_float_noise(spark):
    noisy = 0.0
    for _ in range(28):  # built-in sum() compensates its error
        noisy += 3 / 7
    row = spark.createDataFrame([(noisy,), (-1.0,), (12.2,)], "x double").select(whole_units(F.col("x"))).collect()
    assert noisy > 12 and [r[0] for r in row] == [12, 0, 13]


def test_normal_quantile(spark):
    points = [0.001, 0.02, 0.1, 0.5, 5 / 6, 0.99, 0.9999]
    got = spark.createDataFrame([(p,) for p in points], "p double").select("p", normal_quantile(F.col("p")).alias("z")).collect()
    for row in got:
        assert row["z"] == pytest.approx(NormalDist().inv_cdf(row["p"]), abs=1e-7)
    assert spark.range(1).select(normal_quantile(F.lit(1.0))).first()[0] is None


def test_dense_days_fills_before_between_and_after(spark):
    daily = spark.createDataFrame(
        [("S", "A", DAY + dt.timedelta(2), 5), ("S", "A", DAY + dt.timedelta(4), 1), ("S", "B", DAY, 2)],
        "store_id string, item_id string, date date, units long")
    days = spark.createDataFrame([(DAY + dt.timedelta(k),) for k in range(6)], "date date")
    rows = retail.dense_days(daily, days).orderBy("item_id", "day_number").collect()
    assert [r["units_sold"] for r in rows] == [0, 0, 5, 0, 1, 0] + [2, 0, 0, 0, 0, 0]
    assert [r["day_number"] for r in rows] == [1, 2, 3, 4, 5, 6] * 2


def test_unpivot_orders_days_as_numbers(spark):
    wide = spark.createDataFrame([("A", "S", 1, 2, 10)], "item_id string, store_id string, d_1 int, d_10 int, d_2 int")
    rows = star.with_day_number(star.unpivot_sales(wide)).orderBy("day_number").collect()
    assert [(r["day_id"], r["units_sold"]) for r in rows] == [("d_1", 1), ("d_2", 10), ("d_10", 2)]


def test_weekly_rule_repeats_the_last_season(spark):
    values = list(range(1, 169))
    rows = baselines.rule_forecast(candidates(spark, values), "weekly_seasonal_naive").orderBy("forecast_step").collect()
    season = values[-35:-28]
    assert [r["predicted_units"] for r in rows] == [season[h % 7] for h in range(28)]


def test_selection_prefers_rule_order_on_ties(spark):
    scores = baselines.backtest_scores(candidates(spark, [0] * 168))
    assert baselines.adaptive_selection(scores).first()["selected_model"] == "zero_forecast"


def test_selection_uses_rmse_before_rule_order(spark):
    rows = [("S", "A", "zero_forecast", 0, 1.0, 2.0), ("S", "A", "mean_28_days", 4, 1.0, 1.5), ("S", "A", "mean_7_days", 3, 1.0, 1.5)]
    scores = spark.createDataFrame(rows, "store_id string, item_id string, candidate_model string, model_priority int, backtest_mae double, backtest_rmse double")
    assert baselines.adaptive_selection(scores).first()["selected_model"] == "mean_7_days"


def test_backtest_never_reads_the_holdout(spark):
    before = [3, 0, 1, 4, 0, 2, 6] * 24
    changed = before[:-28] + [99] * 28
    def outcome(values):
        rows = candidates(spark, values)
        scores = sorted(map(tuple, baselines.backtest_scores(rows).collect()))
        predicted = [r[0] for r in rows.filter("block = 0").orderBy("model", "forecast_step").select("predicted_units").collect()]
        return scores, predicted
    assert outcome(before) == outcome(changed)


@pytest.mark.parametrize("zeros, mean, pattern", [
    (80.0, 1.0, "highly_intermittent"), (79.99999, 1.0, "intermittent"), (50.0, 1.0, "intermittent"),
    (20.0, 1.0, "mixed"), (19.9, 1.0, "regular"), (100.0, 0.0, "no_training_demand")])
def test_pattern_boundaries(spark, zeros, mean, pattern):
    row = spark.range(1).select(demand_pattern(F.lit(zeros), F.lit(mean), P.PATTERN_FLOORS).alias("p")).first()
    assert row["p"] == pattern


def test_all_zero_series(spark):
    row = accuracy.demand_characteristics(series(spark, [0] * 30)).first()
    assert row["coefficient_of_variation"] is None and row["demand_pattern"] == "no_training_demand"
    forecasts = series(spark, [0] * 28).select(
        F.lit("m").alias("model"), "store_id", "item_id", "date",
        F.col("units_sold").cast("double").alias("actual_units"), F.lit(0.0).alias("predicted_units"))
    assert accuracy.forecast_metrics(forecasts, ["model"]).first()["wape_percent"] is None
    spread = policy.demand_uncertainty(series(spark, [0] * 28), F.lit(DAY + dt.timedelta(28)))
    rows = policy.inventory_policies(policy.horizon_totals(forecasts), spread).collect()
    assert {r["fill_rate_percent"] for r in rows} == {100.0} and {r["uncertainty_std_28"] for r in rows} == {0.0}


def test_rolling_features_wait_for_a_full_window(spark):
    rows = series(spark, range(1, 30)).select("day_number", *features.lag_features(), *features.rolling_features()).orderBy("day_number").collect()
    assert rows[6]["rolling_mean_7"] is None and rows[7]["rolling_mean_7"] == 4.0
    assert rows[27]["lag_28"] is None and rows[28]["lag_28"] == 1.0 and rows[28]["rolling_mean_28"] == 14.5


def test_snap_of_an_unknown_state_is_zero(spark):
    df = spark.createDataFrame([("AF", 1), ("ZZ", 1)], "state_id string, snap_AF int")
    assert [r[0] for r in df.select(features.snap_active(["AF"])).collect()] == [1, 0]


def test_price_is_missing_before_the_item_is_priced(spark):
    sales = spark.createDataFrame([("A", "S", "d_1", 1), ("A", "S", "d_2", 1)], tables.FACT_SALES)
    calendar = spark.createDataFrame([("d_1", DAY, 1), ("d_2", DAY + dt.timedelta(7), 2)], "day_id string, date date, wm_yr_wk int")
    stores = spark.createDataFrame([("S", "ST")], tables.DIM_STORES)
    prices = spark.createDataFrame([("S", "A", 2, 9.5)], tables.FACT_PRICES)
    rows = panel.full_panel(sales, stores, calendar, prices).select("day_id", *features.price_features()).orderBy("day_id").collect()
    assert [(r["sell_price"], r["price_available"]) for r in rows] == [(0.0, 0), (9.5, 1)]


def test_quality_rules(spark):
    sales = series(spark, [1, 2, 3]).filter("day_number <> 2")
    calendar = series(spark, [0, 0, 0]).select("day_id", "date")
    problems = quality.day_set_problems(sales, calendar).collect()
    assert [(r["day_id"], r["problem"]) for r in problems] == [("d_2", "missing")]
    assert quality.chronology_problems(sales).count() == 1
    with pytest.raises(quality.DataQualityError):
        quality.require_empty(quality.duplicate_keys(sales, ["store_id"]), "store")
    quality.require_empty(quality.duplicate_keys(sales, ["day_id"]), "day")
    missing = quality.required_columns(spark, {"sales": (sales, ["item_id", "price", "cost"])})
    assert [r["missing_column"] for r in missing.collect()] == ["cost", "price"]
    assert quality.day_column_problems(spark, sales.select(F.lit(1).alias("d_2"))).first()[0] == "d_1 is missing"
    assert quality.day_column_problems(spark, sales.select("store_id")).first()[0] == "no day columns"
    assert quality.day_column_problems(spark, sales.select(F.lit(1).alias("d_1"))).count() == 0
    values = quality.unexpected_values(sales, "store_id", ["T"]).collect()
    assert {(r["value"], r["problem"]) for r in values} == {("S", "unexpected"), ("T", "absent")}


def test_too_few_common_items_fail(spark):
    sales = spark.createDataFrame([("A", "S"), ("A", "T"), ("B", "S")], "item_id string, store_id string")
    items = star.common_items(sales, ["S", "T"], 5)
    assert [r[0] for r in items.collect()] == ["A"]
    with pytest.raises(Exception, match="fewer than 2"):
        star.require_items(items, 2).collect()


def test_metrics_comparison_keeps_the_later_row(spark):
    schema = "model string, mae double, rmse double"
    early = spark.createDataFrame([("a", 3.0, 1.0), ("b", 2.0, 1.0)], schema)
    late = spark.createDataFrame([("a", 1.0, 5.0)], schema)
    assert [tuple(r) for r in accuracy.metrics_comparison(early, late, ["model"]).collect()] == [("a", 1.0, 5.0), ("b", 2.0, 1.0)]


def test_findings_need_unique_rows(spark):
    metrics = spark.createDataFrame([(P.ADAPTIVE, 1.0, 1.0), (P.ADAPTIVE, 1.0, 1.0), ("m", 1.0, 1.0)], "model string, mae double, rmse double")
    policies = spark.createDataFrame([("m", p, 1.0) for p in (P.POINT_POLICY, P.NEWSVENDOR_POLICY)], "forecast_model string, inventory_policy string, total_cost_units double")
    cells = spark.createDataFrame([(s, m, 0.0) for s in ("tight", "balanced") for m in P.METHODS], "scenario string, allocation_method string, operational_cost_units double")
    with pytest.raises(Exception, match="expected one match"):
        bi.key_findings(metrics, policies, cells, "m").collect()
    found = bi.key_findings(metrics.distinct(), policies, cells, "m").collect()
    assert found[3]["value_percent"] is None and found[0]["value_percent"] == 0.0


def test_parameter_tables_and_dimensions(spark):
    assert parameters.policy_assumptions(spark).count() == 7
    constrained = dict(map(tuple, parameters.constrained_assumptions(spark).collect()))
    assert len(constrained) == 14 and constrained["tight_capacity_ratio"] == "0.7"
    stochastic = dict(map(tuple, parameters.stochastic_assumptions(spark).collect()))
    assert stochastic["demand_scenario_low"] == "z=-0.5244, probability=0.2"
    assert [r[0] for r in bi.scenario_dimension(spark).collect()] == ["tight", "balanced", "near_full"]
    assert bi.model_dimension(spark).count() == 4 and bi.policy_dimension(spark).count() == 2 and bi.method_dimension(spark).count() == 3
