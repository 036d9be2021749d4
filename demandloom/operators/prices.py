"""Exact prices of two limited resources, per scenario and store.

Steps with a gain per unit, a cost per unit and a number of units compete for a budget and a
capacity. For prices (x per cost unit, y per unit) the value of the limits plus what steps
earn above their priced cost,

    f(x, y) = x * budget + y * (capacity + 1/2) + sum of units * max(0, gain - x * cost - y),

is convex and piecewise linear; its minimum is where two steps just break even, or one of them at
a price of zero. (Units are whole, so half a unit of capacity makes the minimum unique in y.)

The search is Kelley's: a cut per evaluated point, the next point at the minimum of the cuts. An evaluation is one
aggregate over the steps that combines before its shuffle, for all groups at once; nothing is
multiplied. The cuts also enclose all minima in a polygon. A step that earns or loses
at every corner of it is decided; once a group has at most ``BAND`` undecided kinds of steps (equal gain and cost
count once), they and the sums of the decided ones go to one task, which finds the minimum exactly.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from demandloom.sources.storage import freeze

GROUPS = ["scenario", "store_id"]
BAND = 2048      # undecided kinds of steps of a group that one task takes
CLOSE = 8        # kinds nearest to breaking even, among which the exact corner is looked for
SHARP = 1e-13    # relative distance of a value to its bound at which a search ends


def earns(gain: Column, cost: Column, x: Column, y: Column) -> Column:
    return gain - x * cost - y


def corners(cuts: np.ndarray, level: float, top_x: float, top_y: float) -> np.ndarray:
    """Corners of {(x, y) in the box: every cut a + b x + c y is at most the level}."""
    polygon = [(0.0, 0.0), (top_x, 0.0), (top_x, top_y), (0.0, top_y)]
    for a, b, c in cuts:
        room = [level - a - b * x - c * y for x, y in polygon]
        slack = 1e-12 * (abs(level) + abs(a))
        kept = []
        for k, here in enumerate(polygon):
            r, s, there = room[k], room[(k + 1) % len(polygon)], polygon[(k + 1) % len(polygon)]
            if r >= -slack:
                kept.append(here)
            if (r < -slack) != (s < -slack):
                t = r / (r - s)
                kept.append((here[0] + t * (there[0] - here[0]), here[1] + t * (there[1] - here[1])))
        polygon = kept or polygon
    return np.array(polygon)


def lowest(cuts: np.ndarray, top_x: float, top_y: float) -> tuple[float, float, float]:
    """(x, y, value) of the minimum of the cuts' maximum over the box, at a corner of the cuts."""
    lines = np.vstack([cuts, np.zeros((0, 3))])
    points = [(0.0, 0.0), (top_x, 0.0), (0.0, top_y), (top_x, top_y)]
    # On an edge of the box two cuts meet; inside it three.
    for (a, b, c), (d, e, f) in combinations(lines.tolist(), 2):
        for x in (0.0, top_x):
            if c != f:
                points.append((x, (d - a + (e - b) * x) / (c - f)))
        for y in (0.0, top_y):
            if b != e:
                points.append(((d - a + (f - c) * y) / (b - e), y))
    if len(lines) > 2:
        i, j, k = np.array(list(combinations(range(len(lines)), 3))).T
        first, second = lines[i] - lines[j], lines[i] - lines[k]
        whole = first[:, 1] * second[:, 2] - first[:, 2] * second[:, 1]
        ok = whole != 0
        x = (first[ok, 2] * second[ok, 0] - first[ok, 0] * second[ok, 2]) / whole[ok]
        y = (first[ok, 0] * second[ok, 1] - first[ok, 1] * second[ok, 0]) / whole[ok]
        points = np.vstack([np.array(points), np.stack([x, y], axis=1)])
    points = np.array(points)
    points = points[(points >= 0).all(axis=1) & (points[:, 0] <= top_x) & (points[:, 1] <= top_y)]
    value = (lines[:, 0] + points[:, :1] * lines[:, 1] + points[:, 1:] * lines[:, 2]).max(axis=1)
    best = np.lexsort((points[:, 1], points[:, 0], value))[0]
    return float(points[best, 0]), float(points[best, 1]), float(value[best])


def exact_minimum(
    gain: np.ndarray, cost: np.ndarray, units: np.ndarray, budget: float, room: float
) -> tuple[float, float]:
    """The corner (x, y) at which f is least; of equal ones that with smaller x, then y."""
    if not len(gain):
        return 0.0, 0.0

    def value(x, y):
        profit = gain - np.multiply.outer(np.atleast_1d(x), cost) - np.atleast_1d(y)[:, None]
        return np.atleast_1d(x) * budget + np.atleast_1d(y) * room + (np.maximum(profit, 0) * units).sum(axis=1)

    priced = cost > 0
    top_x, top_y = float((gain[priced] / cost[priced]).max()) if priced.any() else 0.0, float(gain.max())
    x, y, cuts, least = 0.0, 0.0, np.zeros((0, 3)), np.inf
    for _ in range(200):
        on = gain - x * cost - y > 0
        slope_x, slope_y = budget - (units * cost)[on].sum(), room - units[on].sum()
        now = float(value(x, y)[0])
        if now < least:
            least, at = now, (x, y)
        cuts = np.vstack([cuts, [now - slope_x * x - slope_y * y, slope_x, slope_y]])
        if len(cuts) > 24:  # those that matter near the minimum
            cuts = cuts[np.argsort(-(cuts[:, 0] + at[0] * cuts[:, 1] + at[1] * cuts[:, 2]))[:16]]
        x, y, bound = lowest(cuts, top_x, top_y)
        if least - bound <= SHARP * max(1.0, abs(least)):
            break
    near = np.lexsort((gain, cost, np.abs(gain - at[0] * cost - at[1])))[:CLOSE]
    points = [(0.0, 0.0), *[(0.0, float(gain[k])) for k in near], *[(float(gain[k] / cost[k]), 0.0) for k in near if cost[k] > 0]]
    for i, j in combinations(near.tolist(), 2):
        i, j = (i, j) if cost[i] < cost[j] else (j, i)
        if cost[i] != cost[j]:
            slope = float((gain[i] - gain[j]) / (cost[i] - cost[j]))
            points.append((slope, float(gain[i] - slope * cost[i])))
    points = np.array([p for p in points if p[0] >= 0 and p[1] >= 0])
    values = np.round(value(points[:, 0], points[:, 1]), 6)
    best = np.lexsort((points[:, 1], points[:, 0], values))[0]
    return float(points[best, 0]), float(points[best, 1])


_CORNER = "array<struct<x: double, y: double>>"


def resource_prices(steps: DataFrame, limits: DataFrame, band: int = BAND) -> DataFrame:
    """Groups, budget_price, unit_price: the exact minimum of f for every group with steps.

    steps: store_id, gain, cost, units (cost whole). limits: groups, budget_left, capacity_left (whole).
    """
    kinds = freeze(steps.filter("gain > 0 AND units > 0").groupBy("store_id", "gain", "cost").agg(F.sum("units").alias("units")))
    rate = F.max(F.when(F.col("cost") > 0, F.col("gain") / F.col("cost")))
    tops = kinds.groupBy("store_id").agg(F.coalesce(rate, F.lit(0.0)).alias("top_x"), F.max("gain").alias("top_y"), F.count(F.lit(1)).alias("kinds"))
    state = limits.join(tops, "store_id").select(
        *GROUPS, F.col("budget_left").cast("double").alias("budget"), (F.col("capacity_left") + 0.5).alias("room"), "top_x", "top_y",
        F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(None).cast(_CORNER).alias("area"),
        F.lit(None).cast("array<struct<a: double, b: double, c: double>>").alias("cuts"), F.lit(None).cast("double").alias("least"), F.col("kinds").alias("open"),
    )
    state = freeze(state)
    profit = earns(F.col("gain"), F.col("cost"), F.col("x"), F.col("y"))
    on = profit > 0
    at = lambda p: earns(F.col("gain"), F.col("cost"), p["x"], p["y"])
    wins, loses = F.forall("area", lambda p: at(p) > 0), F.forall("area", lambda p: at(p) < 0)
    undecided = F.col("area").isNull() | ~(wins | loses)
    while not state.filter(F.col("open") > band).isEmpty():
        crowded = state.filter(F.col("open") > band)
        sums = kinds.join(crowded.select(*GROUPS, "x", "y"), "store_id").groupBy(*GROUPS).agg(
            F.sum(F.when(on, F.col("units") * profit)).alias("profit"), F.sum(F.when(on, F.col("units") * F.col("cost"))).alias("used_cost"),
            F.sum(F.when(on, F.col("units"))).alias("used_units"),
        ).na.fill(0)
        cut = freeze(crowded.join(sums, GROUPS).groupBy(*GROUPS).applyInPandas(_with_cut, crowded.schema))
        counted = kinds.join(cut.select(*GROUPS, "area"), "store_id").groupBy(*GROUPS).agg(F.count_if(undecided).alias("left"))
        moved = cut.join(counted, GROUPS).withColumn("open", F.col("left")).select(*state.columns)
        state = freeze(state.filter(F.col("open") <= band).unionByName(moved))
    joined = kinds.join(state, "store_id")
    decided = joined.filter(~undecided & wins).groupBy(*GROUPS).agg(F.sum(F.col("units") * F.col("cost")).alias("sure_cost"), F.sum("units").alias("sure_units"))
    rest = state.select(*GROUPS, "budget", "room").join(decided, GROUPS, "left").na.fill(0, ["sure_cost", "sure_units"]).join(
        joined.filter(undecided).select(*GROUPS, "gain", "cost", "units"), GROUPS, "left"
    )

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        head, group = group.iloc[0], group.dropna(subset=["gain"])
        x, y = exact_minimum(
            group["gain"].to_numpy(float), group["cost"].to_numpy(float), group["units"].to_numpy(float),
            float(head["budget"] - head["sure_cost"]), float(head["room"] - head["sure_units"]),
        )
        return pd.DataFrame({"scenario": [head["scenario"]], "store_id": [head["store_id"]], "budget_price": [x], "unit_price": [y]})

    return rest.groupBy(*GROUPS).applyInPandas(solve, "scenario string, store_id string, budget_price double, unit_price double")


def _with_cut(group: pd.DataFrame) -> pd.DataFrame:
    """One group's state after an evaluation: its cut, the polygon of minima and the next point."""
    row = group.iloc[0].to_dict()
    x, y, top_x, top_y = row["x"], row["y"], row["top_x"], row["top_y"]
    value = x * row["budget"] + y * row["room"] + row["profit"]
    slope_x, slope_y = row["budget"] - row["used_cost"], row["room"] - row["used_units"]
    earlier = [tuple(c[k] for k in "abc") if isinstance(c, dict) else tuple(c) for c in (row["cuts"] if row["cuts"] is not None else [])]
    cuts = np.array([*earlier, (value - slope_x * x - slope_y * y, slope_x, slope_y)])
    least = value if row["least"] is None or np.isnan(row["least"]) else min(value, row["least"])
    # A little above the least value, so that minima lie inside: beyond it decided steps are not followed.
    area = corners(cuts, least + 1e-9 * max(1.0, abs(least)), top_x, top_y)
    x, y, _ = lowest(cuts, top_x, top_y)
    row |= {
        "x": x, "y": y, "least": least, "area": [{"x": float(p), "y": float(q)} for p, q in area],
        "cuts": [{"a": float(a), "b": float(b), "c": float(c)} for a, b, c in cuts],
    }
    return pd.DataFrame([row])[[c for c in group.columns if c not in ("profit", "used_cost", "used_units")]]
