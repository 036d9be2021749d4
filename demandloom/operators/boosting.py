"""Pooled Poisson boosting over all series by gradient histograms.

Features are cut once into at most ``max_bins`` bins at approximate quantiles and kept as bytes, column by column, in blocks of rows.
A tree grows best-first up to ``max_leaves`` and ``max_depth``: per pass every block adds its rows' gradients to the bins of the
leaves that may be split next. The histograms are dealt by feature, summed and searched for the best split of every leaf where
they lie. A pass counts all leaves that can still be among the next splits, so a tree
takes about as many passes as it is deep, with the same splits as if they were counted one by one.

Gradients are counted in whole parts of ``1 / PARTS``, so histograms are exact in any order, and a
tree does not depend on how rows are partitioned.

The driver gets bin edges, trees, and per pass the best split that each of at most ``MERGERS`` tasks found for a leaf: no
histograms, and nothing that grows with rows, levels or the number of blocks. Scores are kept with the blocks and written as a table every ``checkpoint_every`` rounds, which
bounds what a lost executor costs.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from demandloom import params as P
from demandloom.operators.encoding import CATEGORIES, encode_training
from demandloom.params import BoostingParams
from demandloom.sources.storage import materialise

INPUTS = [f"{c}_code" for c in CATEGORIES] + P.FEATURES
PARTS = float(1 << 16)
TASKS = 64  # results of so many tasks are merged at a time
MERGERS = 8  # tasks that the features of a pass are dealt over

Tree = dict[str, np.ndarray]  # feature (-1: leaf), cut (bin), threshold, left, right, value


@dataclass
class Forest:
    """Fitted model: flat trees over INPUTS, plus the start value."""

    start: float
    rate: float
    trees: list[Tree]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Expected demand of each row of a feature matrix."""
        score = np.full(len(x), self.start)
        for tree in self.trees:
            score += self.rate * tree["value"][leaves(tree, x.T, "threshold")]
        return np.exp(score)


def leaves(tree: Tree, columns: np.ndarray, limit: str) -> np.ndarray:
    """The leaf of every row, given feature columns and the limits to compare them with."""
    rows = np.arange(columns.shape[1])
    node = np.zeros(len(rows), np.int64)
    while True:
        feature = tree["feature"][node]
        inner = feature >= 0
        if not inner.any():
            return node
        below = columns[np.maximum(feature, 0), rows] <= tree[limit][node]
        node = np.where(inner, np.where(below, tree["left"][node], tree["right"][node]), node)


# --- blocks of binned rows --------------------------------------------------------------------------

BLOCK = "n int, codes binary, demand binary, score binary"


def bin_edges(rows: DataFrame, max_bins: int) -> list[np.ndarray]:
    """Upper limits of every feature's bins but the last, at approximate quantiles: one pass."""
    shares = F.array(*[F.lit(k / max_bins) for k in range(1, max_bins)])
    found = rows.agg(*[F.percentile_approx(c, shares, 20 * max_bins).alias(c) for c in INPUTS], *[F.max(c).alias(f"most_{c}") for c in INPUTS]).first()
    return [np.array(sorted({v for v in found[c] if v < found[f"most_{c}"]})) for c in INPUTS]


def binned_blocks(rows: DataFrame, edges: list[np.ndarray], start: float) -> DataFrame:
    """Rows of INPUTS and demand as packed blocks, one per Arrow batch."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.stack([np.searchsorted(e, batch.column(c).to_numpy(zero_copy_only=False), side="left").astype(np.uint8) for c, e in zip(INPUTS, edges)])
            demand = batch.column("demand").to_numpy().astype(np.float64)
            yield pa.RecordBatch.from_pydict({
                "n": pa.array([batch.num_rows], pa.int32()), "codes": [codes.tobytes()], "demand": [demand.tobytes()],
                "score": [np.full(batch.num_rows, start).tobytes()],
            })

    return rows.mapInArrow(pack, BLOCK)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(codes, demand, score) of each block."""
    for batch in batches:
        for row in range(batch.num_rows):
            n = batch.column("n")[row].as_py()
            codes, demand, score = (np.frombuffer(batch.column(c)[row].as_buffer(), k) for c, k in (("codes", np.uint8), ("demand", np.float64), ("score", np.float64)))
            yield codes.reshape(-1, n), demand, score


def with_scores(blocks: DataFrame, tree: Tree, rate: float) -> DataFrame:
    """The blocks with a tree added to their scores."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, demand, score in _blocks(batches):
            score = score + rate * tree["value"][leaves(tree, codes, "cut")]
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(demand)], pa.int32()), "codes": [codes.tobytes()], "demand": [demand.tobytes()], "score": [score.tobytes()]})
    return blocks.mapInArrow(add, BLOCK)


# --- histograms ---------------------------------------------------------------------------------------

COUNTED = "feature int, cells binary, loss double, rows long"
FOUND = "node int, gain double, feature int, cut int, below array<bigint>, total array<bigint>, loss double, rows long"


def _summed(batches: Iterator[pa.RecordBatch]) -> dict[int, tuple[np.ndarray, float, int]]:
    """(cells, loss, rows) of each feature."""
    sums: dict[int, tuple[np.ndarray, float, int]] = {}
    for batch in batches:
        for row, feature in enumerate(batch.column("feature").to_pylist()):
            own = np.frombuffer(batch.column("cells")[row].as_buffer(), np.int64)
            cells, loss, rows = sums.get(feature, (0, 0.0, 0))
            sums[feature] = cells + own, loss + batch.column("loss")[row].as_py(), rows + batch.column("rows")[row].as_py()
    return sums


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for feature, (cells, loss, rows) in _summed(batches).items():
        yield pa.RecordBatch.from_pydict({"feature": pa.array([feature], pa.int32()), "cells": [cells.tobytes()], "loss": [loss], "rows": [rows]})


def histograms(blocks: DataFrame, tasks: int, tree: Tree, nodes: list[int], bins: int | Sequence[int]) -> DataFrame:
    """``COUNTED`` rows: histograms [node, bin, (gradient, hessian, rows)] in parts, of all features, those of one in one partition.

    bins: of each feature, or of all. Loss and rows over all nodes are with the first feature.
    """
    bins = np.broadcast_to(bins, len(INPUTS)).tolist()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, loss, rows = [np.zeros((len(nodes), own, 3), np.int64) for own in bins], 0.0, 0
        slot = np.full(len(tree["feature"]), -1)
        slot[nodes] = np.arange(len(nodes))
        for codes, demand, score in _blocks(batches):
            expected = np.exp(score)
            loss, rows = loss + float((expected - demand * score).sum()), rows + len(demand)
            own = slot[leaves(tree, codes, "cut")]
            wanted = np.flatnonzero(own >= 0)
            own, codes = own[wanted], codes[:, wanted]
            gradient, hessian = np.rint((expected - demand)[wanted] * PARTS), np.rint(expected[wanted] * PARTS)
            for feature, width in enumerate(bins):
                at = own * width + codes[feature]
                for k, weights in enumerate((gradient, hessian, None)):  # sums of whole numbers below 2^53 are exact
                    cells[feature][:, :, k] += np.bincount(at, weights, len(nodes) * width).astype(np.int64).reshape(len(nodes), width)
        if rows:
            none = [0] * (len(bins) - 1)
            yield pa.RecordBatch.from_pydict({
                "feature": pa.array(range(len(bins)), pa.int32()), "cells": [c.tobytes() for c in cells],
                "loss": pa.array([loss, *none], pa.float64()), "rows": [rows, *none],
            })

    parts = blocks.mapInArrow(count, COUNTED)
    while tasks > TASKS:
        tasks = max(1, math.isqrt(tasks))
        parts = parts.repartition(tasks).mapInArrow(_merged, COUNTED)
    return parts.repartition(min(MERGERS, tasks), "feature")


@dataclass
class Node:
    """A leaf or inner node while a tree grows: its sums, its best split if it may be split, and the sums below that."""

    total: np.ndarray
    gain: float = 0.0
    feature: int = -1
    cut: int = -1
    below: np.ndarray | None = None
    children: tuple[int, int] | None = None
    depth: int = 0

    def seek(self, cells: np.ndarray, least_rows: int, l2: float) -> None:
        sums = cells.cumsum(axis=1)
        below = sums[:, :-1]
        above = self.total - below
        value = lambda c: (c[..., 0] / PARTS) ** 2 / (c[..., 1] / PARTS + l2)
        gain = value(below) + value(above) - value(self.total)
        gain[(below[..., 2] < least_rows) | (above[..., 2] < least_rows)] = -np.inf
        best = int(gain.argmax()) if gain.size else 0
        if gain.size and gain.flat[best] > 1e-12:
            self.gain = float(gain.flat[best])
            self.feature, self.cut = divmod(best, gain.shape[1])
            self.below = below[self.feature, self.cut]

    def split(self) -> tuple["Node", "Node"]:
        return Node(self.below, depth=self.depth + 1), Node(self.total - self.below, depth=self.depth + 1)

    def leaf_value(self, l2: float) -> float:
        gradient, hessian, _ = self.total / PARTS
        return -gradient / (hessian + l2)


def best_splits(counted: DataFrame | tuple[np.ndarray, float, int], nodes: int, settings: BoostingParams) -> tuple[list[Node], float, int]:
    """(every counted node with its best split, loss, rows), from ``histograms`` or from cells in memory.

    Of equal gains the first feature and the lowest cut count.
    """
    least_rows, l2 = settings.min_leaf_rows, settings.l2
    if not isinstance(counted, DataFrame):
        cells, loss, rows = counted
        found = [Node(own[0].sum(axis=0)) for own in cells]
        for node, own in zip(found, cells):
            node.seek(own, least_rows, l2)
        return found, loss, rows

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[Node] = []
        sums = _summed(batches)
        for feature in sorted(sums):
            cells = sums[feature][0].reshape(nodes, -1, 3)
            own = [Node(c.sum(axis=0)) for c in cells]
            for node, c in zip(own, cells):
                node.seek(c[None], least_rows, l2)
                node.feature = feature if node.below is not None else -1
            best = [b if b.gain >= o.gain else o for b, o in zip(best, own)] if best else own
        if best:
            none = [0] * (nodes - 1)
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_pydict({
                "node": pa.array(range(nodes), pa.int32()), "gain": [b.gain for b in best],
                "feature": pa.array([b.feature for b in best], pa.int32()), "cut": pa.array([b.cut for b in best], pa.int32()),
                "below": pa.array([None if b.below is None else b.below.tolist() for b in best], lists),
                "total": pa.array([b.total.tolist() for b in best], lists),
                "loss": pa.array([sum(s[1] for s in sums.values()), *none], pa.float64()), "rows": [sum(s[2] for s in sums.values()), *none],
            })

    rows = counted.mapInArrow(seek, FOUND).collect()  # at most MERGERS for a node
    best = {}
    for row in sorted(rows, key=lambda r: (-r["gain"], r["feature"])):
        best.setdefault(row["node"], row)
    found = [
        Node(np.array(r["total"]), r["gain"], r["feature"], r["cut"], None if r["below"] is None else np.array(r["below"]))
        for r in (best[k] for k in range(nodes))
    ]
    return found, sum(r["loss"] for r in rows), sum(r["rows"] for r in rows)


STUMP = Node(np.zeros(3))


def _flat(nodes: list[Node], inner: set[int], edges: list[np.ndarray], l2: float) -> Tree:
    split = np.array([k in inner for k in range(len(nodes))])
    return {
        "feature": np.where(split, [n.feature for n in nodes], -1), "cut": np.array([n.cut for n in nodes]),
        "threshold": np.array([float(edges[n.feature][n.cut]) if k in inner else 0.0 for k, n in enumerate(nodes)]),
        "left": np.array([n.children[0] if n.children else 0 for n in nodes]), "right": np.array([n.children[1] if n.children else 0 for n in nodes]),
        "value": np.array([n.leaf_value(l2) for n in nodes]),
    }


def best_first(nodes: list[Node], most: int) -> tuple[list[int], list[int]]:
    """(nodes split in best-first order, nodes whose children have to be counted to go on)."""
    queue, inner, wanted = [(-nodes[0].gain, 0)], [], []
    while queue and len(inner) + len(wanted) + 1 < most:
        gain, node = heapq.heappop(queue)
        if gain >= 0:
            break
        if nodes[node].children is None:
            wanted.append(node)  # its children may come before what is next in the queue
        else:
            if not wanted:
                inner.append(node)
            for child in nodes[node].children:
                heapq.heappush(queue, (-nodes[child].gain, child))
    return inner, wanted


def grow(count, edges: list[np.ndarray], settings: BoostingParams) -> tuple[Tree, float]:
    """(one tree, loss before it). count(tree, nodes) gives the histograms of nodes of a tree, as ``best_splits`` takes them."""
    nodes, loss, rows = best_splits(count(_flat([STUMP], set(), edges, 1.0), [0]), 1, settings)
    while True:
        inner, wanted = best_first(nodes, settings.max_leaves)
        if not wanted:
            break
        open_ = []
        for parent in wanted:
            nodes[parent].children = (len(nodes), len(nodes) + 1)
            for child in nodes[parent].split():
                # The deepest, and those with too few rows for two leaves, are leaves, which need no histogram.
                if child.depth < settings.max_depth and child.total[2] >= 2 * settings.min_leaf_rows:
                    open_.append(len(nodes))
                nodes.append(child)
        if not open_:
            continue
        expanded = {k for k, n in enumerate(nodes) if n.children}
        found, _, _ = best_splits(count(_flat(nodes, expanded, edges, settings.l2), open_), len(open_), settings)
        for child, own in zip(open_, found):
            nodes[child] = replace(own, depth=nodes[child].depth)
    # Counted in advance but not reached: their parents stay leaves.
    kept, order = {0: 0}, [0]
    for node in order:
        if node in inner:
            for child in nodes[node].children:
                kept[child] = len(order)
                order.append(child)
    own = [replace(nodes[k], children=tuple(kept[c] for c in nodes[k].children) if k in inner else None) for k in order]
    return _flat(own, {kept[k] for k in inner}, edges, settings.l2), loss / max(rows, 1)


def fit_pooled_model(training: DataFrame, settings: BoostingParams = BoostingParams()) -> tuple[Forest, list[float]]:
    """Fit the pooled model; also returns the training loss after every round."""
    rows = encode_training(training).select(*INPUTS, F.col("units_sold").cast("double").alias("demand"))
    rows = materialise(_spread(rows), "boosting-rows")
    mean = rows.agg(F.avg("demand")).first()[0]
    if mean is None:
        raise ValueError("no training rows")
    if not mean:
        raise ValueError("training demand is zero")
    start, edges = math.log(mean), bin_edges(rows, settings.max_bins)
    bins = [len(e) + 1 for e in edges]
    blocks = materialise(binned_blocks(rows, edges, start), "boosting-blocks").persist()
    # A task per core sums all its blocks, so what is shuffled follows the cores and not the blocks.
    tasks = min(blocks.rdd.getNumPartitions(), blocks.sparkSession.sparkContext.defaultParallelism)
    trees: list[Tree] = []
    losses, previous = [], None
    for number in range(1, settings.rounds + 1):
        tree, loss = grow(lambda grown, nodes: histograms(blocks.coalesce(tasks), tasks, grown, nodes, bins), edges, settings)  # noqa: B023
        losses.append(loss)
        trees.append(tree)
        if previous is not None:
            previous.unpersist()
        # The first pass of the next round computes and keeps the new scores.
        scored = with_scores(blocks, tree, settings.learning_rate)
        previous, blocks = blocks, (materialise(scored, "boosting-blocks") if number % settings.checkpoint_every == 0 else scored).persist()
    _, loss, count = best_splits(histograms(blocks.coalesce(tasks), tasks, _flat([STUMP], set(), edges, 1.0), [0], bins), 1, settings)
    for df in (previous, blocks):
        if df is not None:
            df.unpersist()
    return Forest(start, settings.learning_rate, trees), [*losses[1:], loss / count]


def _spread(rows: DataFrame) -> DataFrame:
    """At least one partition per core, so that every core counts."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


# --- persistence as tables ---------------------------------------------------------------------------

def save_forecast_model(spark: SparkSession, forest: Forest, codes: DataFrame, path: str) -> None:
    """Write the model as three tables: tree nodes, category codes, and metadata with features."""
    nodes = [
        (t, i, int(tree["feature"][i]), int(tree["cut"][i]), float(tree["threshold"][i]), int(tree["left"][i]), int(tree["right"][i]), float(tree["value"][i]))
        for t, tree in enumerate(forest.trees) for i in range(len(tree["feature"]))
    ]
    schema = "tree int, node int, feature int, cut int, threshold double, left int, right int, value double"
    spark.createDataFrame(nodes, schema).write.mode("overwrite").parquet(f"{path}/nodes")
    codes.write.mode("overwrite").parquet(f"{path}/codes")
    spark.createDataFrame([(forest.start, forest.rate, INPUTS)], "start double, rate double, inputs array<string>").write.mode("overwrite").parquet(f"{path}/metadata")


def load_forecast_model(spark: SparkSession, path: str) -> tuple[Forest, DataFrame]:
    """Read a saved model and its codes; the trees' size is bounded by settings, not by data."""
    meta = spark.read.parquet(f"{path}/metadata").first()
    if list(meta["inputs"]) != INPUTS:
        raise ValueError("the saved model has other features")
    nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect()
    by_tree: dict[int, list] = {}
    for node in nodes:
        by_tree.setdefault(node["tree"], []).append(node)
    trees = [{k: np.array([n[k] for n in own]) for k in ("feature", "cut", "threshold", "left", "right", "value")} for own in by_tree.values()]
    return Forest(meta["start"], meta["rate"], trees), spark.read.parquet(f"{path}/codes")
