"""Connected components of an edge list by min labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from demandloom.sources.storage import freeze

#: Parts over which the rows of one key are spread.
SPREAD = 256


def part_of(node: str) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(SPREAD)).alias("part")


def spread_join(rows: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per ``key``.

    ``rows`` have a ``part``. The table's row goes to each (key, part) in use first, at most
    ``SPREAD`` rows per key; the rows then meet it by key and part, so no task has all rows
    of a key that a third of them share.
    """
    used = rows.select(key, "part").distinct()
    return rows.join(used.join(table, key), [key, "part"])


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of its component, for every node of ``edges`` (a, b).

    A round gives each node the least label of itself and its neighbours, hooks that onto
    the label's own node, and jumps to the label's label, so paths halve. All sums combine
    before their shuffles, and hubs and labels of large components are spread over parts.
    Lineage is cut each round. Edges with a null or of a node to itself are left out.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).filter("a != b").distinct()
    both = freeze(both.select("a", F.col("b").alias("to"), part_of("a")))
    labels = freeze(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("to"), F.col("a")).alias("label")))
    while True:
        near = spread_join(both, "to", labels.withColumnRenamed("node", "to")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        seen = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("least"))
        hooks = seen.filter("least < label").groupBy(F.col("label").alias("node")).agg(F.min("least").alias("hook"))
        hooked = freeze(seen.join(hooks, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("least", "hook").alias("to"), part_of("node")
        ))
        heads = hooked.select(F.col("node").alias("to"), F.col("to").alias("next"))
        jumped = freeze(spread_join(hooked, "to", heads).select("node", "old", F.least("to", "next").alias("label")))
        labels = jumped.select("node", "label")
        if jumped.filter("label != old").isEmpty():
            return labels
