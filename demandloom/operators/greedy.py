"""Single units in rounds, by rank, while they fit a budget and a capacity, for many groups at once.

The result is that of visiting the rows of a group one after the other, giving one unit where it fits,
and beginning again until nothing fits. Spend and units only grow, so a row that once fails to
fit never fits later. Hence everything up to the first misfit is a running total, which is
computed distributed (``prefix.running_totals``), and only rows still affordable with
what is left need another look. Costs and budgets are whole numbers, so sums don't depend on
order, and it makes no difference to any result how far the distributed rounds go. They go on until
no group has more than ``fold_rows`` open rows, which a task then visits in memory.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from demandloom.operators.prefix import running_totals
from demandloom.sources.storage import freeze

FOLD_ROWS = 20_000
GROUPS = ["scenario", "store_id"]


def _visit(costs: list[int], units: list[int], unvisited: list[bool], budget: int, capacity: int) -> list[int]:
    """Units given to one group's rows, in order."""
    taken = [0] * len(costs)
    todo = [i for i, open_ in enumerate(unvisited) if open_] or list(range(len(costs)))
    while todo:
        for i in todo:
            if capacity < 1:
                return taken
            if units[i] > taken[i] and costs[i] <= budget:
                taken[i] += 1
                capacity -= 1
                budget -= costs[i]
        todo = [i for i in range(len(costs)) if units[i] > taken[i] and costs[i] <= budget]
    return taken


def take_in_rounds(rows: DataFrame, limits: DataFrame, groups: Sequence[str] = GROUPS, fold_rows: int = FOLD_ROWS) -> DataFrame:
    """Units taken per group and item.

    rows: groups, item_id, rank_value (higher first, then lower cost), cost, units.
    limits: groups, budget_left, capacity_left. Cost, units and limits are whole numbers.
    """
    groups = list(groups)
    columns = [*groups, "item_id", "rank_value", "cost", "units", "unvisited"]
    rows = freeze(rows.withColumn("unvisited", F.lit(True)).select(*columns))
    limits = freeze(limits.select(*groups, "budget_left", "capacity_left"))
    parts = []
    while True:
        open_rows = rows.join(limits, groups).filter("units > 0 AND capacity_left >= 1 AND cost <= budget_left")
        if open_rows.groupBy(*groups).count().filter(F.col("count") > fold_rows).isEmpty():
            parts.append(_finish(open_rows, groups))
            break
        if open_rows.filter("unvisited").isEmpty():
            rows = freeze(open_rows.withColumn("unvisited", F.lit(True)).select(*columns))
            continue
        rows, limits, taken = _advance(open_rows, limits, groups, columns)
        parts.append(taken)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.groupBy(*groups, "item_id").agg(F.sum("taken").cast("long").alias("taken"))


def _finish(open_rows: DataFrame, groups: list[str]) -> DataFrame:
    """Visit the remaining rows; the caller has checked that no group exceeds the bound."""
    def finish(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["rank_value", "cost", "item_id"], ascending=[False, True, True])
        head = group.iloc[0]
        taken = _visit(group["cost"].tolist(), group["units"].tolist(), group["unvisited"].tolist(), int(head["budget_left"]), int(head["capacity_left"]))
        return group[[*groups, "item_id"]].assign(taken=taken)

    schema = ", ".join(f"{g} string" for g in groups) + ", item_id string, taken long"
    return open_rows.groupBy(*groups).applyInPandas(finish, schema)


def _advance(open_rows: DataFrame, limits: DataFrame, groups: list[str], columns: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One unit for every row up to the first misfit of each group, distributed."""
    waiting = open_rows.filter("NOT unvisited")
    order = [F.desc("rank_value"), F.asc("cost"), F.asc("item_id")]
    runs = running_totals(open_rows.filter("unvisited"), groups, order, {"cost": F.col("cost"), "units": F.lit(1).cast("long")})
    before_fits = (F.col("before_cost") <= F.col("budget_left")) & (F.col("before_units") < F.col("capacity_left"))
    fits = before_fits & (F.col("before_cost") + F.col("cost") <= F.col("budget_left"))
    # The first misfit is visited too, in vain.
    seen = freeze(runs.withColumn("taken", fits.cast("long")).withColumn("reached", before_fits))
    used = seen.groupBy(*groups).agg(F.sum(F.col("taken") * F.col("cost")).alias("spend"), F.sum("taken").alias("count"))
    limits = freeze(limits.join(used, groups, "left").select(
        *groups,
        (F.col("budget_left") - F.coalesce("spend", F.lit(0))).alias("budget_left"),
        (F.col("capacity_left") - F.coalesce("count", F.lit(0))).alias("capacity_left"),
    ))
    visited = seen.withColumn("units", F.col("units") - F.col("taken")).withColumn("unvisited", ~F.col("reached"))
    rows = visited.select(*columns).unionByName(waiting.select(*columns))
    return freeze(rows), limits, seen.filter("taken > 0").select(*groups, "item_id", "taken")
