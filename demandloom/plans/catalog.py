"""Named queries: one per operator, over the stages of a workspace."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from demandloom import params as P
from demandloom.functions.normal import service_factor
from demandloom.functions.outcomes import rounded
from demandloom.operators import (
    accuracy, allocate, baselines, bi, boosting, encoding, features, panel, policy, quality, recursive, reports, star,
)
from demandloom.plans.workspace import Allocation, Publication, Workspace, open_workspace
from demandloom.sources import retail
from demandloom.sources.storage import stage_path
from demandloom.sources.tables import (
    FACT_PRICES, export_manifest, load_star_schema, row_counts, scan_csv, scan_filtered, scan_table, write_table,
)

Query = Callable[[Workspace], DataFrame]
CATALOG: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        CATALOG[name] = function
        return function
    return register


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return CATALOG[name](open_workspace(spark, folder))


def _checked(rows: DataFrame, violations: DataFrame) -> DataFrame:
    """checked_rows and violations in one row."""
    return rows.agg(F.count(F.lit(1)).alias("checked_rows")).withColumn(
        "violations", violations.agg(F.count(F.lit(1))).scalar()
    )


# --- sources and sinks --------------------------------------------------------------------

@query("scan_csv")
def _(ws):
    path = stage_path(ws.spark, "prices-csv")
    write_table(ws.prices, path, "csv")
    return rounded(scan_csv(ws.spark, path, FACT_PRICES), 6)


@query("scan_filtered")
def _(ws):
    return scan_filtered(
        ws.spark, ws.folder, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"],
        (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 25),
    )


@query("scan_table")
def _(ws):
    return scan_table(ws.spark, ws.folder, "supplier")


@query("write_table")
def _(ws):
    path = stage_path(ws.spark, "load-summary")
    write_table(reports.load_summary(ws.daily, ws.calendar), path, "csv")
    return ws.spark.read.schema("store_id string, total_units_sold long, average_daily_units double").csv(path, header=True)


def _star_tables(ws: Workspace) -> dict[str, DataFrame]:
    return {
        "dim_items": ws.items, "dim_stores": ws.stores, "dim_calendar": ws.calendar,
        "fact_sales": ws.sales, "fact_prices": ws.prices,
    }


@query("load_star_schema")
def _(ws):
    return row_counts(load_star_schema(_star_tables(ws), stage_path(ws.spark, "star")))


def bi_tables(
    ws: Workspace, allocations: Allocation, forecasts: DataFrame, members: Sequence[tuple] = ()
) -> dict[str, tuple[DataFrame, str]]:
    """The exported star schema with the grain of each table."""
    daily = bi.actual_daily(forecasts)
    return {
        "dim_store": (bi.store_dimension(ws.stores), "key: store_id"),
        "dim_item": (bi.item_dimension(ws.items), "key: item_id"),
        "dim_date": (bi.date_dimension(ws.calendar), "key: date"),
        "dim_model": (bi.model_dimension(ws.spark, members), "key: model"),
        "dim_inventory_policy": (bi.policy_dimension(ws.spark), "key: policy"),
        "dim_constraint_scenario": (bi.scenario_dimension(ws.spark), "key: scenario"),
        "dim_allocation_method": (bi.method_dimension(ws.spark), "key: method"),
        "fact_actual_daily": (daily, "keys: store_id, item_id, date"),
        "fact_actual_horizon": (bi.actual_horizon(daily), "keys: store_id, item_id"),
        "fact_forecast_daily": (bi.forecast_daily(forecasts), "keys: model, store_id, item_id, date"),
        "fact_inventory_policy": (bi.inventory_policy_fact(allocations.policies), "keys: model, policy, store_id, item_id"),
        "fact_constrained_allocation": (
            bi.allocation_fact(allocations.combined, allocations.model),
            "keys: scenario, method, store_id, item_id",
        ),
    }


@query("export_manifest")
def _(ws):
    return export_manifest(bi_tables(ws, ws.allocation, ws.forecasts))


# --- data quality --------------------------------------------------------------------------

@query("dq_row_counts")
def _(ws):
    """Rows of both facts against what series, days and weeks imply."""
    expected = ws.daily.select(*P.SERIES).distinct().agg(F.count(F.lit(1)).alias("series")).select(
        F.lit("fact_sales").alias("table_name"), (F.col("series") * ws.last_day).alias("expected_rows")
    ).unionByName(ws.daily.select(*P.SERIES, retail.week_code(F.col("date")).alias("w")).distinct().agg(
        F.count(F.lit(1)).alias("expected_rows")).select(F.lit("fact_prices").alias("table_name"), "expected_rows"))
    counts = row_counts({"fact_sales": ws.sales, "fact_prices": ws.prices})
    mismatches = quality.row_count_mismatches(counts, expected)
    return expected.join(counts, "table_name").withColumn(
        "mismatches", mismatches.agg(F.count(F.lit(1))).scalar()
    )


@query("dq_unique_key")
def _(ws):
    return quality.duplicate_keys(ws.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_duplicated_rows")
def _(ws):
    rows = ws.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return quality.duplicated_rows(rows, ["l_orderkey", "l_linenumber"])


@query("dq_not_null")
def _(ws):
    return quality.null_counts(ws.panel, ["units_sold", "date", "sell_price", "event_name_1", "event_name_2"])


@query("dq_value_range")
def _(ws):
    price_known = F.col("sell_price").isNull() | (F.col("sell_price") > 0)
    rules = {
        "units_not_negative": F.col("units_sold") >= 0,
        "units_at_most_40": F.col("units_sold") <= 40,
        "price_positive": price_known,
        **{f"snap_{s}_flag": F.col(f"snap_{s}").isin(0, 1) for s in P.SNAP_STATES},
    }
    quantity = F.col("l_quantity")
    lines = {"quantity_whole": quantity == F.floor(quantity), "quantity_positive": quantity > 0}
    return quality.range_violations(ws.panel, rules).unionByName(quality.range_violations(ws.table("lineitem"), lines))


@query("dq_foreign_keys")
def _(ws):
    lines = ws.table("lineitem")
    return quality.foreign_key_violations([
        ("fact_sales", ws.sales, ws.items, "item_id"), ("fact_sales", ws.sales, ws.stores, "store_id"),
        ("fact_sales", ws.sales, ws.calendar, "day_id"), ("fact_prices", ws.prices, ws.items, "item_id"),
        ("fact_prices", ws.prices, ws.stores, "store_id"), ("fact_prices", ws.prices, ws.calendar, "wm_yr_wk"),
        ("lineitem", lines.withColumnRenamed("l_orderkey", "o_orderkey"), ws.table("orders"), "o_orderkey"),
        ("lineitem", lines.withColumnRenamed("l_partkey", "p_partkey"), ws.table("part"), "p_partkey"),
        ("lineitem", lines.withColumnRenamed("l_suppkey", "s_suppkey"), ws.table("supplier"), "s_suppkey"),
        ("supplier", ws.table("supplier").withColumnRenamed("s_nationkey", "n_nationkey"), ws.table("nation"), "n_nationkey"),
        ("nation", ws.table("nation").withColumnRenamed("n_regionkey", "r_regionkey"), ws.table("region"), "r_regionkey"),
    ])


#: Key and references (to the dimension, by column) of each published fact.
FACT_RULES = {
    "fact_actual_daily": ([*P.SERIES, "date"], [("dim_store", "store_id"), ("dim_item", "item_id"), ("dim_date", "date_key")]),
    "fact_actual_horizon": (P.SERIES, [("dim_store", "store_id"), ("dim_item", "item_id")]),
    "fact_forecast_daily": (
        ["model_id", *P.SERIES, "date"],
        [("dim_model", "model_id"), ("dim_store", "store_id"), ("dim_item", "item_id"), ("dim_date", "date_key")],
    ),
    "fact_inventory_policy": (
        ["model_id", "policy_id", *P.SERIES],
        [("dim_model", "model_id"), ("dim_inventory_policy", "policy_id"), ("dim_store", "store_id"), ("dim_item", "item_id")],
    ),
    "fact_constrained_allocation": (
        ["scenario_id", "allocation_method_id", *P.SERIES],
        [("dim_constraint_scenario", "scenario_id"), ("dim_allocation_method", "allocation_method_id"), ("dim_model", "model_id"),
         ("dim_inventory_policy", "policy_id"), ("dim_store", "store_id"), ("dim_item", "item_id")],
    ),
}


def fact_problems(tables: dict[str, DataFrame]) -> DataFrame:
    """fact_table, rule, violations: duplicated keys and references without a dimension row, all facts."""
    result = None
    for name, (key, references) in FACT_RULES.items():
        checks = [quality.duplicate_keys(tables[name], key).agg(F.count(F.lit(1)).alias("violations")).select(F.lit("key").alias("rule"), "violations")]
        for dimension, column in references:
            orphans = quality.orphan_keys(tables[name], tables[dimension], [column])
            checks.append(orphans.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(column).alias("rule"), "violations"))
        for check in checks:
            part = check.select(F.lit(name).alias("fact_table"), "rule", "violations")
            result = part if result is None else result.unionByName(part)
    return result


@query("dq_published_facts")
def _(ws):
    return fact_problems({name: table for name, (table, _) in bi_tables(ws, ws.allocation, ws.forecasts).items()})


@query("dq_series_completeness")
def _(ws):
    """Series with days missing before zero days are filled in."""
    return quality.incomplete_series(ws.daily, ws.last_day)


@query("dq_series_summary")
def _(ws):
    return quality.series_summary(ws.dense)


def _observed(ws: Workspace) -> DataFrame:
    return ws.daily.join(F.broadcast(ws.calendar.select("date", "day_id")), "date").withColumn(
        "day_number", F.substring("day_id", 3, 9).cast("int"))


@query("dq_day_set")
def _(ws):
    return quality.day_set_problems(_observed(ws), ws.calendar)


@query("dq_chronological")
def _(ws):
    return quality.chronology_problems(_observed(ws))


@query("dq_allowed_values")
def _(ws):
    return quality.unexpected_values(ws.table("lineitem"), "l_returnflag", ["A", "N", "X"])


@query("dq_join_cardinality")
def _(ws):
    return quality.join_cardinality(
        ws.table("orders").withColumnRenamed("o_orderkey", "l_orderkey"), ws.table("lineitem"), ["l_orderkey"]
    )


def _totals(ws: Workspace) -> DataFrame:
    return policy.horizon_totals(ws.forecasts)


@query("dq_matching_actuals")
def _(ws):
    totals = _totals(ws)
    return _checked(totals, quality.unmatched_actuals(totals, P.ADAPTIVE, "weekly_seasonal_naive"))


@query("dq_holdout_isolation")
def _(ws):
    return quality.holdout_isolation(ws.training, ws.start, P.FEATURES)


@query("dq_limit_consistency")
def _(ws):
    rows = ws.allocation.combined
    return _checked(rows, quality.inconsistent_limits(rows))


@query("dq_cost_identity")
def _(ws):
    rows = ws.allocation.combined
    return _checked(rows, quality.cost_identity_violations(rows))


@query("dq_probability_sum")
def _(ws):
    rows = allocate.demand_scenarios(ws.allocation.targets)
    return _checked(rows, quality.probability_violations(rows, ["constraint_scenario", *P.SERIES]))


@query("dq_resource_compliance")
def _(ws):
    return rounded(quality.resource_compliance(ws.allocation.combined), 2)


@query("dq_feasible_minimum")
def _(ws):
    own = ws.allocation
    return _checked(own.limits, quality.infeasible_minimums(own.targets, own.limits))


# --- star schema ------------------------------------------------------------------------------

def _listed_sales(ws: Workspace) -> DataFrame:
    """Daily sales with item and store attributes, as the raw sales file has them."""
    return ws.daily.join(ws.items, "item_id").join(ws.stores, "store_id")


STORES_WANTED = ["AMERICA", "ASIA", "EUROPE"]


@query("filter_department_stores")
def _(ws):
    return star.filter_department_stores(_listed_sales(ws), "DEPT_3", STORES_WANTED).select(
        *P.SERIES, "dept_id", "date", "units")


@query("select_common_items")
def _(ws):
    return star.require_items(star.common_items(ws.daily, STORES_WANTED, 20), 20)


@query("keep_common_items")
def _(ws):
    kept = star.keep_items(ws.daily, star.common_items(ws.daily, STORES_WANTED, 20))
    return kept.groupBy("item_id").agg(F.sum("units").alias("units"), F.count(F.lit(1)).alias("days"))


@query("dim_items")
def _(ws):
    return star.item_dimension(_listed_sales(ws)).orderBy("item_id")


@query("dim_stores")
def _(ws):
    return star.store_dimension(_listed_sales(ws)).orderBy("store_id")


def _wide(ws: Workspace) -> DataFrame:
    """The sales file layout: a column per day. Their number is the calendar's length."""
    days = ws.calendar.count()
    return ws.sales.groupBy("item_id", "store_id").pivot(
        "day_id", [f"d_{n}" for n in range(1, days + 1)]).agg(F.first("units_sold"))


@query("unpivot_sales")
def _(ws):
    return star.unpivot_sales(_wide(ws))


@query("day_number")
def _(ws):
    return star.with_day_number(ws.sales)


@query("dim_calendar")
def _(ws):
    raw = ws.calendar.withColumnRenamed("day_id", "d").withColumn("date", F.col("date").cast("string"))
    return star.sales_calendar(raw, _observed(ws))


@query("fact_prices")
def _(ws):
    stores = ws.stores.filter(F.col("store_id").isin(STORES_WANTED))
    return rounded(star.selected_prices(ws.prices, stores, star.common_items(ws.daily, STORES_WANTED, 20)), 6)


@query("dense_panel")
def _(ws):
    return retail.dense_days(ws.daily, ws.calendar)


# --- business reports ----------------------------------------------------------------------------

@query("dataset_coverage")
def _(ws):
    return reports.dataset_coverage(ws.daily, ws.calendar)


@query("sales_by_store")
def _(ws):
    return reports.sales_by_store(ws.daily, ws.calendar, ws.stores)


def _priced(ws: Workspace) -> DataFrame:
    return reports.priced_weeks(ws.daily, ws.calendar, ws.prices)


@query("revenue_by_store")
def _(ws):
    return reports.revenue_by_store(_priced(ws))


@query("top_products_by_demand")
def _(ws):
    return reports.top_products_by_demand(ws.daily, ws.calendar, ws.items)


@query("top_products_by_revenue")
def _(ws):
    return reports.top_products_by_revenue(_priced(ws))


@query("monthly_demand_trend")
def _(ws):
    return reports.monthly_demand_trend(ws.daily, ws.calendar)


@query("demand_by_weekday")
def _(ws):
    return reports.demand_by_weekday(ws.daily, ws.calendar)


@query("price_data_coverage")
def _(ws):
    return reports.price_data_coverage(ws.daily, ws.calendar, ws.prices)


@query("load_summary")
def _(ws):
    return reports.load_summary(ws.daily, ws.calendar)


# --- panels ------------------------------------------------------------------------------------------

@query("sales_panel")
def _(ws):
    return panel.sales_panel(ws.sales, ws.calendar)


@query("full_panel")
def _(ws):
    return rounded(ws.panel.select(
        *P.SERIES, "state_id", "day_id", "date", "wm_yr_wk", "wday", "month", "event_name_1", "units_sold", "sell_price"
    ), 6)


@query("training_slice")
def _(ws):
    return panel.training_slice(panel.sales_panel(ws.sales, ws.calendar), ws.start)


@query("holdout_boundary")
def _(ws):
    return panel.holdout_boundary(panel.sales_panel(ws.sales, ws.calendar))


# --- baselines ------------------------------------------------------------------------------------------

def _rule(name: str, rule: str) -> None:
    query(name)(lambda ws: rounded(baselines.rule_forecast(ws.candidates, rule), 6))


for _name, _rule_name in zip(
    ["forecast_zero", "forecast_last_value", "forecast_weekly_seasonal", "forecast_mean_7", "forecast_mean_28"], P.RULES
):
    _rule(_name, _rule_name)


@query("baseline_forecasts")
def _(ws):
    return ws.baseline


@query("backtest_scores")
def _(ws):
    return rounded(ws.scores, 6)


@query("adaptive_selection")
def _(ws):
    return rounded(ws.selection, 6)


@query("adaptive_forecasts")
def _(ws):
    return rounded(ws.adaptive, 6)


@query("adaptive_selection_metrics")
def _(ws):
    return rounded(baselines.adaptive_selection_metrics(ws.adaptive, ws.selection), 6)


@query("adaptive_model_distribution")
def _(ws):
    return baselines.adaptive_model_distribution(ws.selection)


# --- accuracy ----------------------------------------------------------------------------------------------

@query("forecast_metrics")
def _(ws):
    return accuracy.forecast_metrics(ws.forecasts, ["model", "date"])


@query("metrics_overall")
def _(ws):
    return accuracy.metrics_overall(ws.forecasts)


@query("metrics_by_store")
def _(ws):
    return accuracy.metrics_by_store(ws.forecasts)


@query("metrics_overall_and_by_store")
def _(ws):
    return accuracy.metrics_overall_and_by_store(ws.forecasts)


@query("metrics_by_series")
def _(ws):
    return ws.series_metrics


@query("metrics_comparison")
def _(ws):
    return accuracy.metrics_comparison(
        accuracy.forecast_metrics(ws.baseline, ["model", "store_id"]),
        accuracy.forecast_metrics(ws.forecasts.filter(F.col("model") != "last_value_naive"), ["model", "store_id"]),
        ["model", "store_id"],
    )


@query("demand_characteristics")
def _(ws):
    return ws.characteristics


@query("classify_demand_pattern")
def _(ws):
    return ws.characteristics.select(*P.SERIES, "demand_pattern")


@query("metrics_by_pattern")
def _(ws):
    return accuracy.metrics_by_pattern(ws.baseline, ws.characteristics)


@query("pattern_distribution")
def _(ws):
    return accuracy.pattern_distribution(ws.characteristics)


@query("model_winners")
def _(ws):
    return accuracy.model_winners(ws.series_metrics)


@query("worst_series")
def _(ws):
    return accuracy.worst_series(ws.series_metrics)


@query("best_model")
def _(ws):
    return accuracy.best_model(accuracy.metrics_overall(ws.forecasts))


# --- features --------------------------------------------------------------------------------------------------

KEYS = [*P.SERIES, "date"]


@query("feat_event_flag")
def _(ws):
    return ws.panel.select(*KEYS, features.event_flag())


@query("feat_snap_active")
def _(ws):
    return ws.panel.select(*KEYS, features.snap_active(P.SNAP_STATES))


@query("feat_price")
def _(ws):
    return rounded(ws.panel.select(*KEYS, *features.price_features()), 6)


@query("feat_cyclic")
def _(ws):
    return rounded(ws.panel.select(*KEYS, *features.cyclic_features()), 6)


@query("feat_lags")
def _(ws):
    return ws.dense.select(*KEYS, *features.lag_features())


@query("feat_rolling")
def _(ws):
    return rounded(ws.dense.select(*KEYS, *features.rolling_features()), 6)


@query("feat_trend")
def _(ws):
    trend = features.with_trend(ws.dense.select(*KEYS, *features.rolling_features()))
    return rounded(trend.select(*KEYS, "demand_trend_7_vs_28"), 6)


@query("training_features")
def _(ws):
    return rounded(ws.training.select(*KEYS, "units_sold", *P.FEATURES), 6)


@query("feature_summary")
def _(ws):
    return features.feature_summary(ws.training, ws.start)


# --- pooled model ------------------------------------------------------------------------------------------------

@query("encode_categories")
def _(ws):
    return encoding.category_levels(ws.training)


@query("encode_targets")
def _(ws):
    """column, level, date, code: the category codes that a training day sees."""
    codes = [encoding.ordered_codes(ws.training, c).select(F.lit(c).alias("column"), "level", "date", "code") for c in encoding.CATEGORIES]
    return rounded(codes[0].unionByName(codes[1]), 6)


@query("encode_final")
def _(ws):
    """The codes that forecasts use."""
    return rounded(ws.codes, 6)


@query("fit_pooled_model")
def _(ws):
    """Training loss per round."""
    losses = ws.fitted[1]
    return ws.spark.createDataFrame([(k + 1, v) for k, v in enumerate(losses)], "round int, training_loss double")


@query("save_forecast_model")
def _(ws):
    """Forecasts of a saved and reloaded model."""
    path = stage_path(ws.spark, "model")
    boosting.save_forecast_model(ws.spark, ws.fitted[0], ws.codes, path)
    return ws.forecast_with(*boosting.load_forecast_model(ws.spark, path))


@query("recursive_features")
def _(ws):
    return rounded(recursive.first_step_features(ws.state), 6)


@query("recursive_forecast_linear")
def _(ws):
    """The recursion with a linear stand-in model."""
    return rounded(recursive.recursive_forecast(ws.state, recursive.linear_score, "linear"), 6)


@query("recursive_forecast")
def _(ws):
    return ws.boosted


@query("model_summary")
def _(ws):
    """metric, value: settings, dates and accuracy of the pooled model."""
    forest, losses = ws.fitted
    metrics = accuracy.forecast_metrics(ws.pooled.forecasts, ["model"])
    def of(model: str, name: str):
        return F.max(F.when(F.col("model") == model, F.col(name)))
    row = metrics.agg(
        *[of(P.BOOSTING, m).cast("string").alias(m) for m in ["mae", "rmse", "bias", "wape_percent"]],
        F.round(bi.improvement(of(P.ADAPTIVE, "mae"), of(P.BOOSTING, "mae")), 4).cast("string").alias(
            "mae_improvement_vs_adaptive_percent"),
    )
    settings = {
        "model": "PoissonBoostedTrees", "loss": "poisson", "feature_columns": len(boosting.INPUTS),
        "categorical_features": len(encoding.CATEGORIES), "maximum_iterations": ws.boosting_params.rounds,
        "completed_iterations": len(losses), "holdout_days": P.HORIZON, "final_training_loss": round(losses[-1], 6),
        "maximum_leaf_nodes": ws.boosting_params.max_leaves, "learning_rate": ws.boosting_params.learning_rate, **ws.seconds,
    }
    row = row.withColumns({n: F.lit(str(v)) for n, v in settings.items()}).withColumns({
        "training_rows": ws.training.agg(F.count(F.lit(1))).scalar().cast("string"),
        "holdout_start": ws.start.cast("string"),
        "holdout_end": ws.calendar.agg(F.max("date")).scalar().cast("string"),
    })
    return row.unpivot([], row.columns, "metric", "value")


# --- inventory policies -----------------------------------------------------------------------------------------------

@query("horizon_totals")
def _(ws):
    return rounded(_totals(ws), 6)


@query("demand_uncertainty")
def _(ws):
    return rounded(ws.uncertainty, 6)


@query("newsvendor_factor")
def _(ws):
    """Service factor of every series if each unit short costs a series-specific amount."""
    costs = ws.characteristics.select(*P.SERIES, (1.0 + F.col("zero_sales_days")).alias("shortage_cost"))
    ratio = F.col("shortage_cost") / (F.col("shortage_cost") + P.HOLDING_COST)
    return rounded(costs.select(
        *P.SERIES, ratio.alias("critical_ratio"),
        service_factor(F.col("shortage_cost"), F.lit(P.HOLDING_COST)).alias("service_factor"),
        F.lit(P.SERVICE_FACTOR).alias("standard_service_factor"),
    ), 6)


@query("inventory_policies")
def _(ws):
    return rounded(ws.policies, 4)


@query("policy_summary")
def _(ws):
    return policy.policy_summary(ws.policies, ["forecast_model", "inventory_policy"])


@query("policy_by_store")
def _(ws):
    return policy.policy_summary(ws.policies, ["store_id", "forecast_model", "inventory_policy"])


# --- allocation ------------------------------------------------------------------------------------------------------------

@query("target_plan")
def _(ws):
    return rounded(allocate.target_plan(ws.policies, ws.allocation.model), 6)


@query("average_prices")
def _(ws):
    return rounded(allocate.average_prices(ws.prices, ws.calendar, ws.start), 6)


@query("priority_weights")
def _(ws):
    return rounded(ws.allocation.targets, 6)


@query("resource_limits")
def _(ws):
    return rounded(ws.allocation.limits, 4)


def _registered_allocation(name: str, pick: Callable[[Allocation], DataFrame]) -> None:
    query(name)(lambda ws: rounded(pick(ws.allocation), 4))


ORDER = ["scenario", *P.SERIES, "allocated_order_quantity"]

_registered_allocation("allocate_target_shortfall", lambda a: a.shortfall.select(*ORDER))
_registered_allocation("allocate_proportional", lambda a: a.proportional.select(*ORDER))
_registered_allocation("allocation_outcomes", lambda a: a.proportional)
_registered_allocation("allocation_by_series", lambda a: a.constrained)
_registered_allocation("allocation_by_store", lambda a: allocate.allocation_by_store(a.constrained))
_registered_allocation("allocation_summary", lambda a: allocate.allocation_summary(a.constrained))
_registered_allocation(
    "allocation_diagnostics", lambda a: allocate.shortfall_diagnostics(a.shortfall, a.shortfall_prices))
_registered_allocation("demand_scenarios", lambda a: allocate.demand_scenarios(a.targets))
_registered_allocation("expected_cost_curve", lambda a: allocate.expected_cost_curve(a.targets))
_registered_allocation("allocate_expected_cost", lambda a: a.expected.select(*ORDER))
_registered_allocation("expected_cost_outcomes", lambda a: a.expected)
_registered_allocation("combined_allocations", lambda a: a.combined)
_registered_allocation("stochastic_by_store", lambda a: allocate.combined_by_store(a.combined))
_registered_allocation("stochastic_summary", lambda a: allocate.combined_summary(a.combined))
_registered_allocation(
    "stochastic_diagnostics", lambda a: allocate.expected_cost_diagnostics(a.expected, a.expected_prices))
_registered_allocation("stochastic_inputs", lambda a: allocate.reference_inputs(a.combined))


# --- reporting star schema -----------------------------------------------------------------------------------------------------

@query("bi_dim_store")
def _(ws):
    return bi.store_dimension(star.store_dimension(_listed_sales(ws)))


@query("bi_dim_item")
def _(ws):
    return bi.item_dimension(star.item_dimension(_listed_sales(ws)))


@query("bi_dim_date")
def _(ws):
    return bi.date_dimension(ws.calendar)


@query("bi_dim_model")
def _(ws):
    return bi.dimension_usage(bi.model_dimension(ws.spark), bi.forecast_daily(ws.forecasts), "model_id")


@query("bi_dim_policy")
def _(ws):
    return bi.dimension_usage(bi.policy_dimension(ws.spark), bi.inventory_policy_fact(ws.policies), "policy_id")


def _allocation_fact(ws: Workspace) -> DataFrame:
    return bi.allocation_fact(ws.allocation.combined, ws.allocation.model)


@query("bi_dim_scenario")
def _(ws):
    return bi.dimension_usage(bi.scenario_dimension(ws.spark), _allocation_fact(ws), "scenario_id")


@query("bi_dim_method")
def _(ws):
    return bi.dimension_usage(bi.method_dimension(ws.spark), _allocation_fact(ws), "allocation_method_id")


@query("bi_fact_actual_daily")
def _(ws):
    return bi.actual_daily(ws.forecasts)


@query("bi_fact_actual_horizon")
def _(ws):
    return bi.actual_horizon(bi.actual_daily(ws.forecasts))


@query("bi_fact_forecast_daily")
def _(ws):
    return rounded(bi.forecast_daily(ws.forecasts), 6)


@query("bi_fact_inventory_policy")
def _(ws):
    return rounded(bi.inventory_policy_fact(ws.policies), 4)


@query("bi_fact_allocation")
def _(ws):
    return rounded(_allocation_fact(ws), 4)


def _findings(ws: Workspace, forecasts: DataFrame, allocation: Allocation) -> DataFrame:
    return bi.key_findings(
        accuracy.forecast_metrics(forecasts, ["model"]),
        policy.policy_summary(allocation.policies, ["forecast_model", "inventory_policy"]),
        allocate.combined_summary(allocation.combined), allocation.model,
    )


@query("key_findings")
def _(ws):
    return _findings(ws, ws.forecasts, ws.allocation)


@query("chart_model_mae")
def _(ws):
    return bi.chart_model_metric(accuracy.forecast_metrics(ws.forecasts, ["model"]), "mae")


@query("chart_model_rmse")
def _(ws):
    return bi.chart_model_metric(accuracy.forecast_metrics(ws.forecasts, ["model"]), "rmse")


@query("chart_policy_cost")
def _(ws):
    return bi.chart_policy_cost(policy.policy_summary(ws.policies, ["forecast_model", "inventory_policy"]))


@query("chart_allocation_pivot")
def _(ws):
    return bi.chart_allocation_pivot(allocate.combined_summary(ws.allocation.combined))


@query("chart_service_cost")
def _(ws):
    return bi.chart_service_cost(allocate.combined_summary(ws.allocation.combined))


# --- the same with a learned model beside the rules ------------------------------------------------------------------------------

def _compared(keys: Sequence[str]) -> Callable[[Publication], DataFrame]:
    return lambda p: accuracy.metrics_comparison(
        accuracy.forecast_metrics(p.workspace.forecasts, keys), accuracy.forecast_metrics(p.learned, keys), keys,
    )


def _published(p: Publication) -> dict[str, tuple[DataFrame, str]]:
    return bi_tables(p.workspace, p.allocation, p.forecasts, p.members)


def _allocated(p: Publication) -> DataFrame:
    return bi.allocation_fact(p.allocation.combined, p.model)


PUBLISHED: dict[str, Callable[[Publication], DataFrame]] = {
    "metrics": _compared(["model"]),
    "metrics_by_store": _compared(["model", "store_id"]),
    "policy_summary": lambda p: policy.policy_summary(p.policies, ["forecast_model", "inventory_policy"]),
    "stochastic_summary": lambda p: allocate.combined_summary(p.allocation.combined),
    "key_findings": lambda p: _findings(p.workspace, p.forecasts, p.allocation),
    "bi_dim_model": lambda p: bi.dimension_usage(
        bi.model_dimension(p.workspace.spark, p.members), bi.forecast_daily(p.forecasts), "model_id"),
    "bi_dim_policy": lambda p: bi.dimension_usage(
        bi.policy_dimension(p.workspace.spark), bi.inventory_policy_fact(p.policies), "policy_id"),
    "bi_dim_method": lambda p: bi.dimension_usage(
        bi.method_dimension(p.workspace.spark), _allocated(p), "allocation_method_id"),
    "bi_fact_forecast_daily": lambda p: rounded(bi.forecast_daily(p.forecasts), 6),
    "bi_fact_inventory_policy": lambda p: rounded(bi.inventory_policy_fact(p.policies), 4),
    "bi_fact_allocation": lambda p: rounded(_allocated(p), 4),
    "export_manifest": lambda p: export_manifest(_published(p)),
    "dq_published_facts": lambda p: fact_problems({name: table for name, (table, _) in _published(p).items()}),
}


def _registered_publication(prefix: str, pick: Callable[[Workspace], Publication]) -> None:
    for name, result in PUBLISHED.items():
        query(f"{prefix}_{name}")(lambda ws, result=result: result(pick(ws)))


_registered_publication("ml", lambda ws: ws.pooled)
_registered_publication("linear", lambda ws: ws.stand_in)
