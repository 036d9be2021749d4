"""Allocating a limited budget and capacity across items, per scenario and store.

Two objectives are minimised under integer orders between a guaranteed minimum and a
target, a budget and a unit capacity: weighted shortfall against the target, and
expected operating cost over demand scenarios. Both are separable and convex per item,
so each item is a short ladder of steps (a gain per unit and a number of units) with
falling gains, and the problem is to pick steps. The exact prices of budget and capacity
(``prices.py``) decide all steps but a few, and these are solved together (``core.py``). The
prices also bound the optimum, so every result carries its gap.

Money is counted in whole parts of ``MONEY`` per unit, costs rounded up and budgets down: sums are
exact in any order, and what fits in parts fits in money.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from demandloom import params as P
from demandloom.functions.outcomes import fill_rate, with_outcomes
from demandloom.operators.core import gain_bounds, take_steps
from demandloom.operators.greedy import GROUPS, take_in_rounds

MONEY = 10_000  # parts of one unit of money


def cost_parts(cost: Column) -> Column:
    """A cost in whole parts, rounded up; the inner rounding only removes noise of the last digits."""
    return F.ceil(F.round(cost * MONEY, 2)).cast("long")


def budget_parts(budget: Column) -> Column:
    return F.floor(F.round(budget * MONEY, 2)).cast("long")


# --- inputs ------------------------------------------------------------------------------

def target_plan(policies: DataFrame, model: str, policy: str = P.NEWSVENDOR_POLICY) -> DataFrame:
    """Orders of one model and policy as integer targets."""
    return policies.filter((F.col("forecast_model") == model) & (F.col("inventory_policy") == policy)).select(
        *P.SERIES, "forecast_total_units", "actual_demand_units", "uncertainty_std_28",
        F.round("order_quantity").cast("long").alias("target_order_quantity"),
    )


def average_prices(prices: DataFrame, calendar: DataFrame, start: Column) -> DataFrame:
    """Average price over the weeks that touch the holdout, else over all weeks.

    The holdout touches at most six weeks, so their codes are broadcast.
    """
    weeks = calendar.filter(F.col("date") >= start).select("wm_yr_wk").distinct().withColumn("current", F.lit(True))
    return (
        prices.join(F.broadcast(weeks), "wm_yr_wk", "left").groupBy(*P.SERIES)
        .agg(F.coalesce(F.avg(F.when(F.col("current"), F.col("sell_price"))), F.avg("sell_price")).alias("average_sell_price"))
    )


def priority_weights(plan: DataFrame, prices: DataFrame) -> DataFrame:
    """Unit cost and a weight from the store-relative forecast and uncertainty.

    Store maxima are aggregated (combining before the shuffle) and joined back; a window
    over the store would put a whole store in one task. A series without a price stays, with
    a null cost.
    """
    maxima = plan.groupBy("store_id").agg(
        F.max("forecast_total_units").alias("top_demand"), F.max("uncertainty_std_28").alias("top_spread")
    )
    def share(value: str, top: str) -> Column:
        return F.col(value) / F.when(F.col(top) == 0, F.lit(1.0)).otherwise(F.col(top))
    weight = 1.0 + 0.5 * share("forecast_total_units", "top_demand") + 0.5 * share("uncertainty_std_28", "top_spread")
    return (
        plan.join(prices, P.SERIES, "left").join(maxima, "store_id")
        .withColumn("unit_purchase_cost", P.PROCUREMENT_SHARE * F.col("average_sell_price"))
        .withColumn("priority_weight", weight)
        .drop("top_demand", "top_spread")
    )


def _scenarios() -> Column:
    return F.array(*[
        F.struct(F.lit(n).alias("scenario"), F.lit(b).alias("budget_ratio"), F.lit(c).alias("capacity_ratio"))
        for n, b, c in P.RESOURCE_SCENARIOS
    ])


def resource_limits(targets: DataFrame) -> DataFrame:
    """Budget and capacity of every scenario and store."""
    totals = targets.groupBy("store_id").agg(
        F.sum("target_order_quantity").alias("unconstrained_units"),
        F.sum(F.col("target_order_quantity") * F.col("unit_purchase_cost")).alias("unconstrained_spend"),
    )
    return totals.select("*", F.inline(_scenarios())).select(
        "scenario", "store_id", "unconstrained_units", "unconstrained_spend",
        F.floor(F.col("capacity_ratio") * F.col("unconstrained_units")).alias("capacity_limit"),
        (F.col("budget_ratio") * F.col("unconstrained_spend")).alias("budget_limit"),
    )


def minimum_order() -> Column:
    return F.floor(P.MINIMUM_COVERAGE * F.col("target_order_quantity"))


def left_after(limits: DataFrame, granted: DataFrame) -> DataFrame:
    """Budget, in parts and in money, and capacity that remain after the units granted so far."""
    cost = F.col("unit_purchase_cost")
    used = granted.groupBy(*GROUPS).agg(
        F.sum(F.col("granted") * cost_parts(cost)).alias("spend"), F.sum(F.col("granted") * cost).alias("spend_money"), F.sum("granted").alias("count")
    )
    return limits.join(used, GROUPS).select(
        *GROUPS,
        (budget_parts(F.col("budget_limit")) - F.col("spend")).alias("budget_left"),
        (F.col("budget_limit") - F.col("spend_money")).alias("money_left"),
        (F.col("capacity_limit") - F.col("count")).cast("long").alias("capacity_left"),
    )


def in_scenarios(targets: DataFrame) -> DataFrame:
    return targets.select("*", F.inline(_scenarios())).drop("budget_ratio", "capacity_ratio")


# --- demand scenarios and ladders ------------------------------------------------------------

def demand_scenarios(targets: DataFrame) -> DataFrame:
    """Five demand outcomes per resource scenario and series."""
    outcomes = F.array(*[
        F.struct(F.lit(n).alias("demand_scenario"), F.lit(z).alias("z_score"), F.lit(p).alias("probability"))
        for n, z, p in P.DEMAND_SCENARIOS
    ])
    return in_scenarios(targets).select(
        F.col("scenario").alias("constraint_scenario"), *P.SERIES,
        F.col("forecast_total_units").alias("forecast_mean_units"), "uncertainty_std_28", F.inline(outcomes),
    ).withColumn(
        "simulated_demand_units",
        F.greatest(F.lit(0.0), F.col("forecast_mean_units") + F.col("z_score") * F.col("uncertainty_std_28")),
    )


def _demand(z: float) -> Column:
    return F.greatest(F.lit(0.0), F.col("forecast_total_units") + z * F.col("uncertainty_std_28"))


def expected_cost(quantity: Column) -> Column:
    """Expected shortage and holding cost of ordering a quantity."""
    result = F.lit(0.0)
    for _, z, probability in P.DEMAND_SCENARIOS:
        short = F.greatest(_demand(z) - quantity, F.lit(0.0))
        over = F.greatest(quantity - _demand(z), F.lit(0.0))
        result = result + probability * (P.SHORTAGE_COST * short + P.HOLDING_COST * over)
    return result


def expected_cost_curve(targets: DataFrame) -> DataFrame:
    """Expected cost between minimum and target as steps of constant gain per unit.

    The curve bends only at demand outcomes, so its steps end at the whole numbers
    around them: at most eleven rows per item, whatever the quantities are.
    """
    low, high = minimum_order(), F.col("target_order_quantity")
    bends = [f(F.round(_demand(z), 9)) for _, z, _ in P.DEMAND_SCENARIOS for f in (F.floor, F.ceil)]
    inside = [F.least(high, F.greatest(low, b)) for b in bends]
    ends = F.array_sort(F.array_distinct(F.array(low, high, *inside)))
    steps = targets.withColumn("ends", ends).select(
        *targets.columns, F.posexplode(F.expr("transform(slice(ends, 1, size(ends) - 1), (q, i) -> named_struct('from_units', q, 'to_units', ends[i + 1]))")).alias("segment", "step")
    ).select(*targets.columns, "segment", "step.*")
    before, after = expected_cost(F.col("from_units")), expected_cost(F.col("to_units"))
    return steps.select(
        *P.SERIES, "unit_purchase_cost", "segment", "from_units", "to_units",
        before.alias("expected_cost_before"), after.alias("expected_cost_after"),
    ).withColumn(
        "gain_per_unit",
        F.round((F.col("expected_cost_before") - F.col("expected_cost_after")) / (F.col("to_units") - F.col("from_units")), 9),
    )


def shortfall_ladder(targets: DataFrame) -> DataFrame:
    """Weighted shortfall falls by the item's weight with every unit."""
    return targets.select(
        *P.SERIES, F.lit(0).alias("segment"), F.col("priority_weight").alias("gain"),
        (F.col("target_order_quantity") - minimum_order()).alias("units"),
        F.col("unit_purchase_cost").alias("unit_cost"), cost_parts(F.col("unit_purchase_cost")).alias("cost"),
    ).filter("units > 0")


def expected_cost_ladder(targets: DataFrame) -> DataFrame:
    """Steps of the expected-cost curve that reduce it."""
    return expected_cost_curve(targets).filter("gain_per_unit > 0").select(
        *P.SERIES, "segment", F.col("gain_per_unit").alias("gain"),
        (F.col("to_units") - F.col("from_units")).alias("units"),
        F.col("unit_purchase_cost").alias("unit_cost"), cost_parts(F.col("unit_purchase_cost")).alias("cost"),
    )


# --- allocation ---------------------------------------------------------------------------------

def allocate_by_price(
    targets: DataFrame, limits: DataFrame, ladder: DataFrame, freeze_with: Callable[[DataFrame], DataFrame], **search,
) -> tuple[DataFrame, DataFrame]:
    """(allocation per scenario and series, prices and bound per group)."""
    base = in_scenarios(targets).withColumn("granted", minimum_order())
    ladder = freeze_with(ladder)
    left = freeze_with(left_after(limits, base))
    taken, prices = take_steps(ladder, left, **search)
    # A price per part of money is MONEY times as much per unit of money.
    in_money = prices.withColumn("budget_price", F.col("budget_price") * MONEY)
    allocation = base.join(taken, [*GROUPS, "item_id"], "left").select(
        *GROUPS, "item_id",
        (F.col("granted") + F.coalesce("taken", F.lit(0))).cast("long").alias("allocated_order_quantity"),
    )
    return allocation, gain_bounds(ladder, left, in_money, "unit_cost", "money_left")


def allocate_proportional(targets: DataFrame, limits: DataFrame, freeze_with, **rounds) -> DataFrame:
    """The same share of every item's open target, then single units by weight per cost."""
    base = in_scenarios(targets).select(
        *GROUPS, "item_id", "unit_purchase_cost", "priority_weight", "target_order_quantity",
        minimum_order().alias("granted"),
    ).withColumn("open", F.col("target_order_quantity") - F.col("granted"))
    cost = cost_parts(F.col("unit_purchase_cost"))
    wanted = base.groupBy(*GROUPS).agg(F.sum(F.col("open") * cost).alias("open_spend"), F.sum("open").alias("open_units"))
    left = left_after(limits, base).join(wanted, GROUPS)
    # least() ignores nulls, so a resource nothing is wanted of does not scale.
    scale = F.greatest(F.lit(0.0), F.least(
        F.lit(1.0),
        F.when(F.col("open_spend") > 0, F.col("budget_left") / F.col("open_spend")),
        F.when(F.col("open_units") > 0, F.col("capacity_left") / F.col("open_units")),
    ))
    shared = freeze_with(
        base.join(left.select(*GROUPS, scale.alias("scale")), GROUPS)
        .withColumn("granted", F.col("granted") + F.floor(F.col("scale") * F.col("open")))
        .drop("scale", "open")
    )
    rows = shared.select(
        *GROUPS, "item_id", F.try_divide("priority_weight", "unit_purchase_cost").alias("rank_value"), cost.alias("cost"),
        (F.col("target_order_quantity") - F.col("granted")).alias("units"),
    )
    taken = take_in_rounds(rows, left_after(limits, shared), **rounds)
    return shared.join(taken, [*GROUPS, "item_id"], "left").select(
        *GROUPS, "item_id",
        (F.col("granted") + F.coalesce("taken", F.lit(0))).cast("long").alias("allocated_order_quantity"),
    )


# --- evaluation -----------------------------------------------------------------------------------

ALLOCATION_COLUMNS = [
    "scenario", "allocation_method", *P.SERIES, "forecast_total_units", "uncertainty_std_28",
    "average_sell_price", "unit_purchase_cost", "priority_weight", "target_order_quantity",
    "actual_demand_units", "allocated_order_quantity", "served_units", "shortage_units", "leftover_units",
    "stockout_occurred", "fill_rate_percent", "holding_cost_units", "shortage_cost_units",
    "operational_cost_units", "purchase_spend", "target_coverage_percent", "budget_limit",
    "capacity_limit", "unconstrained_spend", "unconstrained_units",
]


def allocation_outcomes(targets: DataFrame, limits: DataFrame, allocation: DataFrame, method: str) -> DataFrame:
    """Service, cost and spend of an allocation on actual demand."""
    rows = (
        allocation.join(targets, P.SERIES).join(limits, GROUPS)
        .withColumn("allocation_method", F.lit(method))
        .withColumn("purchase_spend", F.col("allocated_order_quantity") * F.col("unit_purchase_cost"))
        .withColumn(
            "target_coverage_percent",
            fill_rate(F.col("allocated_order_quantity").cast("double"), F.col("target_order_quantity")),
        )
    )
    return with_outcomes(rows, "allocated_order_quantity", "operational_cost_units").select(*ALLOCATION_COLUMNS)


_SUMMED = {
    "target_order_quantity": "target_order_units", "allocated_order_quantity": "allocated_order_units",
    "actual_demand_units": "actual_demand_units", "served_units": "served_units",
    "shortage_units": "shortage_units", "leftover_units": "leftover_units",
    "stockout_occurred": "stockout_series", "purchase_spend": "purchase_spend",
    "holding_cost_units": "holding_cost_units", "shortage_cost_units": "shortage_cost_units",
    "operational_cost_units": "operational_cost_units",
}
_LIMITS = ["budget_limit", "capacity_limit", "unconstrained_spend", "unconstrained_units"]


def store_totals(allocations: DataFrame) -> DataFrame:
    """Unrounded sums per (scenario, method, store), each limit once."""
    return allocations.groupBy("scenario", "allocation_method", "store_id").agg(
        F.count(F.lit(1)).alias("number_of_series"),
        *[F.sum(c).alias(n) for c, n in _SUMMED.items()],
        *[F.max(c).alias(c) for c in _LIMITS],
    )


def overall_totals(stores: DataFrame) -> DataFrame:
    """Store sums over all stores, so each store's limits count once."""
    columns = ["number_of_series", *_SUMMED.values(), *_LIMITS]
    return stores.groupBy("scenario", "allocation_method").agg(*[F.sum(c).alias(c) for c in columns])


def with_summary_ratios(totals: DataFrame) -> DataFrame:
    """Derived percentages, everything rounded to 2 decimals at the end."""
    def percent(part: str, whole: str) -> Column:
        return F.try_divide(F.col(part) * 1.0, F.col(whole)) * 100
    result = (
        totals
        .withColumn("fill_rate_percent", fill_rate(F.col("served_units"), F.col("actual_demand_units")))
        .withColumn("stockout_series_percent", percent("stockout_series", "number_of_series"))
        .withColumn("target_coverage_percent", percent("allocated_order_units", "target_order_units"))
        .withColumn("budget_utilisation_percent", percent("purchase_spend", "budget_limit"))
        .withColumn("capacity_utilisation_percent", percent("allocated_order_units", "capacity_limit"))
        .withColumn("average_cost_per_series", F.col("operational_cost_units") / F.col("number_of_series"))
    )
    return result.select(*[F.round(n, 2).alias(n) if k == "double" else F.col(n) for n, k in result.dtypes])


def allocation_by_store(allocations: DataFrame) -> DataFrame:
    return with_summary_ratios(store_totals(allocations))


def allocation_summary(allocations: DataFrame) -> DataFrame:
    return with_summary_ratios(overall_totals(store_totals(allocations)))


_UNCONSTRAINED = ["unconstrained_spend", "unconstrained_units"]


def combined_by_store(allocations: DataFrame) -> DataFrame:
    """Store summary of all methods."""
    return allocation_by_store(allocations).drop(*_UNCONSTRAINED)


def combined_summary(allocations: DataFrame) -> DataFrame:
    """Scenario summary of all methods, each store's limits once."""
    return with_summary_ratios(overall_totals(store_totals(allocations)).drop(*_UNCONSTRAINED))


def diagnostics(
    allocations: DataFrame, prices: DataFrame, objective: Column, objective_at_minimum: Column, name: str
) -> DataFrame:
    """Feasibility, objective, proven bound and gap per (scenario, store)."""
    sums = allocations.groupBy(*GROUPS).agg(
        F.sum(objective).alias(name), F.sum(objective_at_minimum).alias("at_minimum"),
        F.sum("allocated_order_quantity").alias("allocated_units"),
        F.sum("purchase_spend").alias("allocated_spend"),
        F.max("budget_limit").alias("budget_limit"), F.max("capacity_limit").alias("capacity_limit"),
    )
    bound = F.greatest(F.lit(0.0), F.col("at_minimum") - F.col("gain_bound"))
    # A group without a useful step has no prices and nothing to gain.
    priced = sums.join(prices.select(*GROUPS, "gain_bound"), GROUPS, "left").withColumn(
        "gain_bound", F.coalesce("gain_bound", F.lit(0.0))
    )
    return priced.select(
        *GROUPS,
        ((F.col("allocated_spend") <= F.col("budget_limit") + 1e-5)
         & (F.col("allocated_units") <= F.col("capacity_limit"))).alias("feasible"),
        name, "allocated_units", "allocated_spend", "budget_limit", "capacity_limit",
        bound.alias("objective_bound"),
        F.round(F.try_divide(F.col(name) - bound, F.col(name)) * 100, 6).alias("gap_percent"),
    )


def shortfall(quantity: Column) -> Column:
    return F.col("priority_weight") * (F.col("target_order_quantity") - quantity)


def shortfall_diagnostics(allocations: DataFrame, prices: DataFrame) -> DataFrame:
    return diagnostics(
        allocations, prices, shortfall(F.col("allocated_order_quantity")), shortfall(minimum_order()), "objective_value"
    )


def expected_cost_diagnostics(allocations: DataFrame, prices: DataFrame) -> DataFrame:
    return diagnostics(
        allocations, prices, expected_cost(F.col("allocated_order_quantity")),
        expected_cost(minimum_order()), "expected_objective_cost",
    )


def reference_inputs(allocations: DataFrame, method: str = P.SHORTFALL) -> DataFrame:
    """Targets, costs and limits as one method's rows carry them."""
    return allocations.filter(F.col("allocation_method") == method).select(
        *GROUPS, "item_id", "forecast_total_units", "uncertainty_std_28", "target_order_quantity",
        "unit_purchase_cost", "priority_weight", "actual_demand_units", "budget_limit", "capacity_limit",
    )


def combine(parts: Sequence[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result
