"""Whole quantities for steps that compete for a budget and a capacity, near the exact optimum.

Given exact prices of both resources (``prices.py``), steps are taken in order of what they earn per unit above
their price. All that earn fit together; of those that break even, as many as fit; then the boundary is
reached. The distance from the optimum lies in the few steps around it, the core: ``BEFORE`` kinds of steps
before the boundary and ``AFTER`` behind it. All before them is taken, all behind them is not, and the core is solved
by trying every choice of up to ``SHIFT`` units away from the boundary's for each kind but two, and every split of the
rest between those two, the nearest to breaking even and then to the boundary. Of equal values the cheaper choice counts, then
that with fewer units, then the smaller quantities in order.

Costs and budgets are whole numbers, so sums are exact in any order. Only the core of a group, at most
BEFORE + AFTER rows, meets in one task; running totals over steps that break even are distributed.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, Window

from demandloom.operators.prefix import running_totals
from demandloom.operators.prices import GROUPS, earns, resource_prices
from demandloom.sources.storage import freeze

BEFORE = AFTER = 3
SHIFT = 2
WINDOW = 512   # units around each turning point of the split between the last two kinds
KIND = ["profit", "gain", "cost"]


def split_points(units: int, cost: float, other_cost: float, budget: float, room: float) -> np.ndarray:
    """Quantities worth trying of the first of two kinds: all, or those around the turning points of the split."""
    if units <= 4 * WINDOW:
        return np.arange(units + 1)
    turns = [0.0, float(units), room]
    if cost > 0:
        turns.append(budget / cost)
    if cost != other_cost:
        turns.append((budget - other_cost * room) / (cost - other_cost))
    points = np.concatenate([np.arange(int(t) - WINDOW, int(t) + WINDOW + 1) for t in turns if abs(t) < 2**62])
    return np.unique(points[(points >= 0) & (points <= units)])


def best_core(gain, cost, units, inside, profit, budget: int, room: int) -> np.ndarray:
    """Quantities of a core's kinds, in the order of steps."""
    n = len(gain)
    within = int(np.sum(inside))  # rows before the boundary come first
    distance = np.where(np.arange(n) < within, within - 1 - np.arange(n), np.arange(n) - within)
    pair = np.lexsort((np.arange(n) < within, distance, np.abs(profit)))[:2].tolist()
    others = [k for k in range(n) if k not in pair]
    shifts = [[int(units[k]) - d if inside[k] else d for d in range(min(SHIFT, int(units[k])) + 1)] for k in others]
    tried = []
    for choice in product(*shifts):
        left, free = budget - sum(q * int(cost[k]) for q, k in zip(choice, others)), room - sum(choice)
        if left < 0 or free < 0:
            continue
        for a, b in [(pair[0], pair[-1]), (pair[-1], pair[0])][: len(pair)]:
            first = split_points(int(units[a]), cost[a], cost[b], left, free) if a != b else np.array([
                min([int(units[a]), free, *([left // int(cost[a])] if cost[a] > 0 else [])])])
            first = first[(first * int(cost[a]) <= left) & (first <= free)]
            rows = np.zeros((len(first), n), np.int64)
            rows[:, others], rows[:, a] = choice, first
            if a != b:
                money = (left - first * int(cost[a])) // int(cost[b]) if cost[b] > 0 else np.full(len(first), int(units[b]))
                rows[:, b] = np.minimum(np.minimum(money, free - first), int(units[b]))
            tried.append(rows)
    rows = np.concatenate(tried) if tried else np.zeros((0, n), np.int64)
    if not len(rows):
        return np.zeros(n, np.int64)
    keys = [rows[:, k] for k in reversed(range(n))] + [rows.sum(axis=1), rows @ np.asarray(cost, np.int64), -np.round(rows @ np.asarray(gain, float), 6)]
    return rows[np.lexsort(keys)[0]]


def take_steps(ladder: DataFrame, limits: DataFrame, **search) -> tuple[DataFrame, DataFrame]:
    """(groups, item_id, taken; groups, budget_price, unit_price).

    ladder: store_id, item_id, segment, gain, cost, units. limits: groups, budget_left, capacity_left. Costs, budgets,
    units and capacities are whole numbers. The steps of an item have falling gains.
    """
    prices = freeze(resource_prices(ladder, limits, **search))
    profit = F.round(earns(F.col("gain"), F.col("cost"), F.col("budget_price"), F.col("unit_price")), 9)
    steps = ladder.filter("gain > 0 AND units > 0").join(prices, "store_id").withColumn("profit", profit)
    kinds = steps.groupBy(*GROUPS, *KIND).agg(F.sum("units").alias("units"), F.count(F.lit(1)).alias("members"))
    kinds = freeze(kinds.join(limits.select(*GROUPS, "budget_left", "capacity_left"), GROUPS))
    spend = F.col("units") * F.col("cost")
    earning = F.col("profit") > 0
    sure = kinds.groupBy(*GROUPS).agg(
        F.coalesce(F.sum(F.when(earning, spend)), F.lit(0)).alias("sure_spend"), F.coalesce(F.sum(F.when(earning, F.col("units"))), F.lit(0)).alias("sure_units"),
    )
    even = running_totals(kinds.filter("profit = 0"), GROUPS, [F.asc("cost"), F.desc("gain")], {"spend": spend, "units": F.col("units")})
    fits = (F.col("sure_spend") + F.col("before_spend") + spend <= F.col("budget_left")) & (F.col("sure_units") + F.col("before_units") + F.col("units") <= F.col("capacity_left"))
    blank = [F.lit(None).cast("long").alias(c) for c in ("before_spend", "before_units")]
    all_fit = (F.col("sure_spend") <= F.col("budget_left")) & (F.col("sure_units") <= F.col("capacity_left"))
    sided = kinds.filter("profit != 0").select(*kinds.columns, *blank).unionByName(even).join(sure, GROUPS).withColumn(
        "inside", F.when(F.col("profit") == 0, fits).otherwise(earning & all_fit)
    )
    sided = freeze(sided.select(*kinds.columns, "inside"))
    last = Window.partitionBy(*GROUPS).orderBy("profit", F.desc("cost"), "gain")
    first = Window.partitionBy(*GROUPS).orderBy(F.desc("profit"), "cost", F.desc("gain"))
    core = sided.filter("inside").withColumn("place", F.row_number().over(last)).filter(F.col("place") <= BEFORE).unionByName(
        sided.filter("NOT inside").withColumn("place", F.row_number().over(first)).filter(F.col("place") <= AFTER)
    ).drop("place")
    taken = sided.filter("inside").groupBy(*GROUPS).agg(F.sum(spend).alias("taken_spend"), F.sum("units").alias("taken_units"))
    core = core.join(taken, GROUPS, "left").na.fill(0, ["taken_spend", "taken_units"])

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["profit", "cost", "gain"], ascending=[False, True, False], ignore_index=True)
        own = group[group["inside"]]
        head = group.iloc[0]
        budget = int(head["budget_left"] - head["taken_spend"] + (own["units"] * own["cost"]).sum())
        room = int(head["capacity_left"] - head["taken_units"] + own["units"].sum())
        quantity = best_core(*(group[c].to_numpy() for c in ("gain", "cost", "units", "inside", "profit")), budget, room)
        return group[[*GROUPS, *KIND]].assign(quantity=quantity)

    solved = freeze(core.groupBy(*GROUPS).applyInPandas(solve, "scenario string, store_id string, profit double, gain double, cost long, quantity long"))
    chosen = sided.join(solved, [*GROUPS, *KIND], "left").select(
        *GROUPS, *KIND, "members", F.col("units").alias("all_units"),
        F.coalesce("quantity", F.when(F.col("inside"), F.col("units")).otherwise(F.lit(0))).alias("quantity"),
    ).filter("quantity > 0")
    dealt = freeze(steps.select(*GROUPS, *KIND, "item_id", "segment", "units").join(chosen, [*GROUPS, *KIND]))
    whole = (F.col("quantity") == F.col("all_units")) | (F.col("members") == 1)
    plain = dealt.filter(whole).select(*GROUPS, "item_id", F.least("units", "quantity").alias("taken"))
    # A kind that is taken in part goes to its items in order.
    shared = dealt.filter(~whole)
    if not shared.isEmpty():
        before = running_totals(shared, [*GROUPS, *KIND], [F.asc("item_id"), F.asc("segment")], {"own": F.col("units")})
        plain = plain.unionByName(before.select(*GROUPS, "item_id", F.greatest(F.lit(0), F.least(F.col("units"), F.col("quantity") - F.col("before_own"))).alias("taken")))
    return plain.groupBy(*GROUPS, "item_id").agg(F.sum("taken").cast("long").alias("taken")), prices


def gain_bounds(ladder: DataFrame, limits: DataFrame, prices: DataFrame, cost: str, budget: str) -> DataFrame:
    """prices with gain_bound: no choice gains more, by weak duality at these prices, on the steps' own costs."""
    x, y = F.col("budget_price"), F.col("unit_price")
    profit = F.greatest(F.lit(0.0), earns(F.col("gain"), F.col(cost), x, y))
    sums = ladder.join(prices, "store_id").groupBy(*GROUPS).agg(F.sum(F.col("units") * profit).alias("profit"))
    bound = x * F.col(budget) + y * F.col("capacity_left") + F.col("profit")
    return prices.join(sums, GROUPS).join(limits, GROUPS).select(*GROUPS, "budget_price", "unit_price", bound.alias("gain_bound"))
