"""Stages of the analysis over one source folder.

A stage is a DataFrame; those that several later stages read are written once to the
shared folder, most of them under rules that stop the work (``checked_stage``); everything
else stays a lazy plan. The raw lines are
read by a single stage, whose result has at most one row per series and day.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from demandloom import params as P
from demandloom.operators import accuracy, allocate, baselines, boosting, encoding, features, gates, panel, policy, recursive
from demandloom.operators.gates import checked_stage
from demandloom.params import BoostingParams
from demandloom.sources import retail
from demandloom.sources.retail import Grain
from demandloom.sources.storage import Layout, freeze, materialise
from demandloom.sources.tables import scan_table

# Rows of the dense stage in a bucket: at most the second number; a small stage is cut to fill the cores.
BUCKET_ROWS = (50_000, 4_000_000)


class Workspace:
    """Lazily built stages for one source folder and grain."""

    def __init__(
        self, spark: SparkSession, folder: str, grain: Grain = Grain(),
        boosting_params: BoostingParams = BoostingParams(),
    ):
        self.spark, self.folder, self.grain = spark, folder, grain
        self.boosting_params = boosting_params
        self.seconds: dict[str, float] = {}

    def table(self, name: str) -> DataFrame:
        return scan_table(self.spark, self.folder, name)

    # --- star schema ---------------------------------------------------------------
    @cached_property
    def daily(self) -> DataFrame:
        return checked_stage(
            retail.daily_totals(self.spark, self.folder, self.grain), "daily", gates.daily_rules(), drop=["fractions"]
        )

    @cached_property
    def calendar(self) -> DataFrame:
        return checked_stage(retail.calendar(self.daily), "calendar", gates.calendar_rules())

    @cached_property
    def items(self) -> DataFrame:
        return retail.item_lookup(self.spark, self.folder, self.grain).select("item_id", "dept_id", "cat_id").distinct()

    @cached_property
    def stores(self) -> DataFrame:
        return retail.places(self.spark, self.folder, self.grain).select("store_id", "state_id").distinct()

    @cached_property
    def prices(self) -> DataFrame:
        layout = replace(self.by_series, order=(*P.SERIES, "wm_yr_wk"))
        return checked_stage(retail.weekly_prices(layout.deal(self.daily)), "prices", gates.price_rules(), layout=layout)

    @cached_property
    def by_series(self) -> Layout:
        """Buckets by series, as many as the dense rows need; a series has at most a row per day of the calendar."""
        series, days = self.daily.select(*P.SERIES).distinct().count(), self.calendar.count()
        few, many = BUCKET_ROWS
        cores = self.spark.sparkContext.defaultParallelism
        return Layout(P.SERIES, max(1, min(cores, series * days // few), -(-series * days // many)))

    @cached_property
    def dense(self) -> DataFrame:
        """Series, date, day_number, units_sold, day_id, block: one row per series and day.

        Bucketed by series, as prices are, in folders by block: windows, aggregates and the price join
        need no exchange, and what looks at recent days reads their folders only.
        """
        layout = replace(self.by_series, order=(*P.SERIES, "date"), partition="block")
        rows = retail.dense_days(layout.deal(self.daily), self.calendar)
        return checked_stage(rows.select(
            "*", F.concat(F.lit("d_"), F.col("day_number").cast("string")).alias("day_id"),
            panel.time_block(self.last_day).alias("block"),
        ), "dense", gates.dense_rules(), layout=layout)

    @cached_property
    def sales(self) -> DataFrame:
        return self.dense.select("item_id", "store_id", "day_id", "units_sold")

    @cached_property
    def panel(self) -> DataFrame:
        sales = self.dense.select("item_id", "store_id", "day_id", "units_sold", "block")
        return panel.full_panel(sales, self.stores, self.calendar, self.prices)

    # --- time boundaries (the calendar has every date once) ------------------------
    @property
    def start(self) -> Column:
        return panel.holdout_start(self.calendar)

    @property
    def last_day(self) -> Column:
        return self.calendar.agg(F.count(F.lit(1)).cast("int")).scalar()

    # --- baselines --------------------------------------------------------------------
    @property
    def near(self) -> DataFrame:
        """The holdout, the backtest windows and the block before them."""
        return panel.newest(self.dense, P.HORIZON * (P.BACKTEST_WINDOWS + 2))

    @cached_property
    def candidates(self) -> DataFrame:
        return materialise(baselines.candidate_forecasts(self.near, self.last_day), "candidates")

    @cached_property
    def scores(self) -> DataFrame:
        return baselines.backtest_scores(self.candidates)

    @cached_property
    def selection(self) -> DataFrame:
        return baselines.adaptive_selection(self.scores)

    @cached_property
    def baseline(self) -> DataFrame:
        return baselines.baseline_forecasts(self.candidates)

    @cached_property
    def adaptive(self) -> DataFrame:
        return checked_stage(baselines.adaptive_forecasts(self.candidates, self.selection), "adaptive", gates.forecast_rules())

    @cached_property
    def forecasts(self) -> DataFrame:
        """Forecasts of the two baselines and the adaptive model."""
        columns = baselines.FORECAST_COLUMNS
        return self.baseline.select(*columns).unionByName(self.adaptive.select(*columns))

    # --- error analysis ------------------------------------------------------------------
    @cached_property
    def characteristics(self) -> DataFrame:
        return accuracy.demand_characteristics(panel.training_slice(panel.before_holdout(self.dense), self.start))

    @cached_property
    def series_metrics(self) -> DataFrame:
        return accuracy.metrics_by_series(self.baseline, self.characteristics)

    # --- features and the pooled model ------------------------------------------------------
    @cached_property
    def features(self) -> DataFrame:
        """Features of the days before the holdout."""
        return features.feature_table(panel.before_holdout(self.panel))

    @cached_property
    def training(self) -> DataFrame:
        return materialise(features.training_features(self.features, self.start), "training")

    @cached_property
    def fitted(self) -> tuple[boosting.Forest, list[float]]:
        self.training.count()  # its own time is not the fit's
        began = time.perf_counter()
        result = boosting.fit_pooled_model(self.training, self.boosting_params)
        self.seconds["training_seconds"] = round(time.perf_counter() - began, 2)
        return result

    @cached_property
    def state(self) -> DataFrame:
        return recursive.forecast_state(panel.newest(self.panel, P.HORIZON + recursive.HISTORY), self.start)

    @cached_property
    def boosted(self) -> DataFrame:
        forest = self.fitted[0]
        began = time.perf_counter()
        result = checked_stage(self.forecast_with(forest, self.codes), "boosted", gates.forecast_rules())
        self.seconds["recursive_forecast_seconds"] = round(time.perf_counter() - began, 2)
        return result

    @cached_property
    def codes(self) -> DataFrame:
        """Category codes after all training days."""
        return materialise(encoding.final_codes(self.training), "codes")

    def forecast_with(self, forest: boosting.Forest, codes: DataFrame) -> DataFrame:
        coded = encoding.encode(self.state, codes)
        return recursive.recursive_forecast(coded, forest.predict, P.BOOSTING, [f"{c}_code" for c in encoding.CATEGORIES])

    # --- policies and allocation ---------------------------------------------------------------
    @cached_property
    def uncertainty(self) -> DataFrame:
        recent = panel.newest(self.dense, P.HORIZON + P.UNCERTAINTY_DAYS, first=1)
        return policy.demand_uncertainty(recent, self.start)

    @cached_property
    def policies(self) -> DataFrame:
        models = self.forecasts.filter(F.col("model").isin(P.ADAPTIVE, "weekly_seasonal_naive"))
        return checked_stage(
            policy.inventory_policies(policy.horizon_totals(models), self.uncertainty), "policies", gates.policy_rules()
        )

    @cached_property
    def allocation(self) -> Allocation:
        """Allocation of the weekly seasonal forecast's orders."""
        return Allocation(self, self.policies, "weekly_seasonal_naive")

    # --- what is published with a learned model ------------------------------------------------
    @cached_property
    def linear(self) -> DataFrame:
        """The recursion with the linear stand-in, which SQL can reproduce."""
        rows = recursive.recursive_forecast(self.state, recursive.linear_score, P.STAND_IN[0])
        return checked_stage(rows, "linear", gates.forecast_rules())

    @cached_property
    def pooled(self) -> Publication:
        return Publication(self, "boosted", P.BOOSTING)

    @cached_property
    def stand_in(self) -> Publication:
        return Publication(self, "linear", P.STAND_IN[0], [P.STAND_IN])


class Publication:
    """Forecasts, policies and allocation with a learned model beside the rules.

    ``rows`` is the workspace's stage of the model's forecasts, which is built when it is first read.
    """

    def __init__(self, workspace: Workspace, rows: str, model: str, members: Sequence[tuple] = ()):
        self.workspace, self.rows, self.model, self.members = workspace, rows, model, members

    @property
    def learned(self) -> DataFrame:
        return getattr(self.workspace, self.rows).select(*baselines.FORECAST_COLUMNS)

    @property
    def forecasts(self) -> DataFrame:
        return self.workspace.forecasts.unionByName(self.learned)

    @cached_property
    def policies(self) -> DataFrame:
        own = self.workspace
        models = self.learned.unionByName(own.adaptive.select(*baselines.FORECAST_COLUMNS))
        return checked_stage(
            policy.inventory_policies(policy.horizon_totals(models), own.uncertainty), "policies", gates.policy_rules()
        )

    @cached_property
    def allocation(self) -> Allocation:
        """Allocation of the learned model's orders."""
        return Allocation(self.workspace, self.policies, self.model)


class Allocation:
    """The three allocations of one model's newsvendor orders."""

    def __init__(self, workspace: Workspace, policies: DataFrame, model: str):
        self.workspace, self.policies, self.model = workspace, policies, model

    @cached_property
    def targets(self) -> DataFrame:
        own = self.workspace
        plan = allocate.target_plan(self.policies, self.model)
        prices = allocate.average_prices(own.prices, own.calendar, own.start)
        return checked_stage(allocate.priority_weights(plan, prices), "targets", gates.target_rules())

    @cached_property
    def limits(self) -> DataFrame:
        return materialise(allocate.resource_limits(self.targets), "limits")

    def _by_price(self, ladder: DataFrame, method: str) -> tuple[DataFrame, DataFrame]:
        allocation, prices = allocate.allocate_by_price(self.targets, self.limits, ladder, freeze)
        rows = allocate.allocation_outcomes(self.targets, self.limits, allocation, method)
        return checked_stage(rows, method, gates.allocation_rules()), prices

    @cached_property
    def _shortfall(self) -> tuple[DataFrame, DataFrame]:
        return self._by_price(allocate.shortfall_ladder(self.targets), P.SHORTFALL)

    @cached_property
    def _expected(self) -> tuple[DataFrame, DataFrame]:
        return self._by_price(allocate.expected_cost_ladder(self.targets), P.EXPECTED_COST)

    @property
    def shortfall(self) -> DataFrame:
        return self._shortfall[0]

    @property
    def shortfall_prices(self) -> DataFrame:
        return self._shortfall[1]

    @property
    def expected(self) -> DataFrame:
        return self._expected[0]

    @property
    def expected_prices(self) -> DataFrame:
        return self._expected[1]

    @cached_property
    def proportional(self) -> DataFrame:
        allocation = allocate.allocate_proportional(self.targets, self.limits, freeze)
        rows = allocate.allocation_outcomes(self.targets, self.limits, allocation, P.PROPORTIONAL)
        return checked_stage(rows, P.PROPORTIONAL, gates.allocation_rules())

    @cached_property
    def constrained(self) -> DataFrame:
        return allocate.combine([self.shortfall, self.proportional])

    @cached_property
    def combined(self) -> DataFrame:
        return allocate.combine([self.shortfall, self.proportional, self.expected])


_open: dict[tuple, Workspace] = {}


def open_workspace(spark: SparkSession, folder: str, grain: Grain = Grain(), **settings) -> Workspace:
    """The workspace of a folder in this application; stages are shared between queries.

    Stages are snapshots: use ``Workspace`` directly to read a folder that has changed.
    """
    key = (spark.sparkContext.applicationId, folder, grain, tuple(sorted(settings.items())))
    if key not in _open:
        _open[key] = Workspace(spark, folder, grain, **settings)
    return _open[key]
