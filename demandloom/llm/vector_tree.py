"""Approximate nearest neighbours by a hierarchical k-means tree and best-bin-first search.

A tree is fitted on a bounded sample: k-means splits the vectors of a node into ``BRANCHES``, and
each part again, down to ``LEAF_POINTS`` of the sample. Every row is indexed: it descends to a leaf. A
query walks the tree through a priority queue of nodes, the one whose centre has the largest inner product
with it first, so leaves come out in the order of their promise.

1. *Calibration.* The true neighbours of a bounded sample of queries (an exact pass over all rows)
   say after how many leaves a query has seen them; the number of visited leaves widens until the sample's
   recall reaches ``RECALL``. Recall is thus measured on every run.
2. *First leaves.* Each query searches its first few leaves; its k-th best score bounds the rest.
3. *Remaining leaves.* Queries carry their bound, and only rows that reach it come back.

Leaves in tree order are packed into regions of a bounded number of rows; a leaf larger than that lies in
several regions. A query is sent once to each region that holds some of its leaves, with the list of them. Tasks get
(region, salt) pairs: a region that many queries visit is copied for every ``PART`` queries. So no leaf, whatever
its share of the rows or queries, is one task. Broadcast are the tree (at most SAMPLE_VALUES numbers
times two) and one row per leaf.

Scores are exact inner products in double precision, summed in one fixed order, so equal vectors tie exactly.

Defined cases: vectors that are null, empty or all zero, or hold a null or a non-finite component,
take no part, and neither do rows without vec_id. Of rows that repeat a vec_id the one with the smallest
vector counts. Only vectors of the query's length are candidates; there is a tree for every length in the sample, and
a single leaf for each other one. A query visits leaves until it has seen more than k rows, so it finds
k neighbours if there are k. Ties go to the smaller vec_id. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from demandloom.sources.storage import materialise

K = 20
EVERY = 20
RECALL = 0.95
CALIBRATION = 128         # sampled queries whose true neighbours are found
SAMPLE = 1 << 14          # vectors that a tree is fitted on, fewer if they are long:
SAMPLE_VALUES = 1 << 21
BRANCHES = 8
LEAF_POINTS = 24
PASSES = 6
PART = 1 << 12            # rows of a region and queries of a salt
PART_VALUES = 1 << 19


def usable_vectors(table: DataFrame) -> DataFrame:
    """vec_id, length, vector: one row per vec_id, components as double."""
    fit = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(1.7976931348623157e308))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size("x") > 0) & F.forall("x", fit) & F.exists("x", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("x").alias("vector")).select("vec_id", F.size("vector").alias("length"), "vector")


def _centres(points: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """k-means of one node: centres and the part of every point."""
    centres = points[rng.choice(len(points), BRANCHES, replace=False)]
    for _ in range(PASSES):
        part = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, part, points)
        sizes = np.bincount(part, minlength=len(centres))
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres, nearest(points, centres)


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1) - 2 * (points @ centres.T), axis=1)


class Tree:
    """Nodes in depth-first order: centre, children (first, last) and number of the leaf or -1."""

    def __init__(self, points: np.ndarray, first_leaf: int = 0, seed: int = 7):
        self.children: list[list[int]] = []
        self.leaf: list[int] = []
        self.order: list[int] = []
        centres: list[np.ndarray] = []
        rng, self.first_leaf, self.leaves = np.random.default_rng(seed), first_leaf, 0

        def add(own: np.ndarray, centre: np.ndarray) -> int:
            node = len(self.leaf)
            centres.append(centre)
            self.children.append([])
            self.leaf.append(-1)
            if len(own) > max(LEAF_POINTS, BRANCHES):
                parts, part = _centres(own, rng)
                sizes = np.bincount(part, minlength=len(parts))
                if (sizes > 0).sum() > 1:  # equal points can't be split
                    self.children[node] = [add(own[part == p], parts[p]) for p in np.flatnonzero(sizes)]
                    return node
            self.leaf[node] = first_leaf + self.leaves
            self.leaves += 1
            return node

        add(points, points.mean(axis=0))
        self.centres = np.array(centres)

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector, by the nearest child at each node."""
        result = np.zeros(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                result[rows] = self.leaf[node]
                continue
            part = nearest(vectors[rows], self.centres[self.children[node]])
            todo += [(child, rows[part == p]) for p, child in enumerate(self.children[node]) if (part == p).any()]
        return result

    def walk(self, promise: np.ndarray) -> Iterator[int]:
        """Leaves in best-bin-first order, given the inner product of a query with every centre."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(queue, (-promise[child], child))
            else:
                yield self.leaf[node]


def fit_trees(vectors: DataFrame) -> dict[int, Tree]:
    """A tree for every length of vectors in a sample of bounded size, chosen by hashes of vec_id."""
    sizes = vectors.agg(F.count(F.lit(1)).alias("rows"), F.max("length").alias("longest")).first()
    if not sizes["rows"]:
        return {}
    most = max(1, min(SAMPLE, SAMPLE_VALUES // sizes["longest"]))
    share = min(1.0, most / sizes["rows"])
    drawn = vectors.filter(F.pmod(F.xxhash64(F.lit("tree"), "vec_id"), F.lit(1 << 30)) < int(share * (1 << 30)) if share < 1 else F.lit(True))
    rows = drawn.select("length", "vector").limit(2 * most).collect()  # the limit only guards against a chance far beyond the share
    if not rows:
        return {}
    trees, leaves = {}, 0
    for length in sorted({r["length"] for r in rows}):
        trees[length] = Tree(np.array([r["vector"] for r in rows if r["length"] == length]), leaves)
        leaves += trees[length].leaves
    return trees


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix) of the vectors of a batch by length."""
    lengths = batch.column("length").to_numpy()
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        yield length, rows, batch.column("vector").take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), length)


def index(vectors: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """vec_id, length, vector, leaf of every row. Lengths without a tree have the leaf -length."""
    shared = vectors.sparkSession.sparkContext.broadcast(trees)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = np.zeros(batch.num_rows, np.int64)
            for length, rows, matrix in _matrices(batch):
                tree = shared.value.get(length)
                leaf[rows] = tree.place(matrix) if tree else -length
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("vec_id", "length", "vector")], pa.array(leaf)], ["vec_id", "length", "vector", "leaf"])

    return vectors.mapInArrow(place, "vec_id long, length int, vector array<double>, leaf long")


def exact_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Row-wise inner products, each summed in the same order."""
    return (queries * rows).sum(axis=1)


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, bounds: np.ndarray, k: int):
    """(query place, row place, score) of each query's k best rows that reach its bound; its own row is left out."""
    scores = queries @ rows.T  # fast, but the order of its sums may vary by ulps
    slack = 1e-9 * np.sqrt((queries * queries).sum(axis=1) * (rows * rows).sum(axis=1).max())
    scores[query_ids[:, None] == ids[None, :]] = -np.inf
    cut = bounds - slack
    if len(ids) > k:
        cut = np.maximum(cut, np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k] - 2 * slack)
    q, r = np.nonzero(np.isfinite(scores) & (scores >= cut[:, None]))
    score = exact_products(queries[q], rows[r])
    order = np.lexsort((ids[r], -score, q))
    q, r, score = q[order], r[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    keep = (place < k) & (score >= bounds[q])
    return q[keep], r[keep], score[keep]


FOUND = "query_id long, vec_id long, score double, leaf long"


def _found(query_ids, ids, scores, leaves) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(query_ids), pa.array(ids), pa.array(scores), pa.array(leaves)], ["query_id", "vec_id", "score", "leaf"])


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def true_neighbours(indexed: DataFrame, queries: list, k: int) -> DataFrame:
    """The exact neighbours of a bounded list of queries, by a pass over all rows with a running best per task."""
    lengths = {r["length"] for r in queries}
    block = {n: (np.array([r["vec_id"] for r in queries if r["length"] == n]), np.array([r["vector"] for r in queries if r["length"] == n])) for n in lengths}
    shared = indexed.sparkSession.sparkContext.broadcast(block)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {n: [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)] for n in shared.value}
        for batch in batches:
            ids, leaf = batch.column("vec_id").to_numpy(), batch.column("leaf").to_numpy()
            for length, rows, matrix in _matrices(batch):
                if length not in shared.value:
                    continue
                query_ids, vectors = shared.value[length]
                q, r, score = _best(query_ids, vectors, ids[rows], matrix, np.full(len(query_ids), -np.inf), k)
                both = [np.concatenate([a, b]) for a, b in zip(held[length], [query_ids[q], ids[rows][r], score, leaf[rows][r]])]
                order = np.lexsort((both[1], -both[2], both[0]))
                place = np.arange(len(order)) - np.searchsorted(both[0][order], both[0][order])
                held[length] = [c[order[place < k]] for c in both]
        for columns in held.values():
            yield _found(*columns)

    return _ranked(indexed.mapInArrow(search, FOUND), k)


def calibrated_visits(indexed: DataFrame, trees: dict[int, Tree], k: int, recall: float, every: int) -> tuple[int, float]:
    """(leaves that a query visits, recall of the sampled queries with so many)."""
    sampled = indexed.filter((F.col("vec_id") % every == 0) & F.col("length").isin(list(trees)))
    hashed = sampled.withColumn("hash", F.xxhash64(F.lit("calibration"), "vec_id"))
    queries = hashed.orderBy("hash", "vec_id").limit(CALIBRATION).collect()
    if not queries:
        return 1, 1.0
    truth = true_neighbours(indexed, queries, k).select("query_id", "leaf").collect()  # at most CALIBRATION * k rows
    after = []
    for query in queries:
        tree = trees[query["length"]]
        turn = {leaf: n for n, leaf in enumerate(tree.walk((tree.centres @ np.array(query["vector"])).tolist()))}
        after += [turn[t["leaf"]] for t in truth if t["query_id"] == query["vec_id"]]
    after, most = np.sort(after), max(t.leaves for t in trees.values())
    visits = 1
    while visits < most and (after < visits).mean() < recall:  # widen
        visits = min(most, visits + max(1, visits // 8))
    return visits, float((after < visits).mean()) if len(after) else 1.0


class Regions:
    """Leaves in tree order, packed into regions of about PART rows; one entry per leaf."""

    def __init__(self, sizes: dict[int, int], part: int):
        self.sizes, self.first, self.parts = sizes, {}, {}
        region, held = 0, 0
        for leaf in sorted(sizes):
            if held and held + sizes[leaf] > part:
                region, held = region + 1, 0
            self.first[leaf], self.parts[leaf] = region, max(1, -(-sizes[leaf] // part))
            if self.parts[leaf] > 1:
                region, held = region + self.parts[leaf], 0
            else:
                held += sizes[leaf]


SIDE = "region long, leaf long, leaves array<long>, id long, length int, vector array<double>"


def _side(columns: list[list], vectors) -> pa.RecordBatch:
    region, leaf, leaves, ids, lengths = columns
    return pa.RecordBatch.from_arrays([
        pa.array(region, pa.int64()), pa.array(leaf, pa.int64()), pa.array(leaves, pa.list_(pa.int64())), pa.array(ids, pa.int64()),
        pa.array(lengths, pa.int32()), vectors,
    ], ["region", "leaf", "leaves", "id", "length", "vector"])


def region_rows(indexed: DataFrame, regions) -> DataFrame:
    """Every row with the region of its leaf; a large leaf is dealt over its regions by vec_id."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, leaf = batch.column("vec_id").to_pylist(), batch.column("leaf").to_pylist()
            own = regions.value
            region = [own.first[n] + (i * 0x9E3779B1 >> 7) % own.parts[n] for i, n in zip(ids, leaf)]
            yield _side([region, leaf, [None] * len(ids), ids, batch.column("length").to_pylist()], batch.column("vector"))
    return indexed.mapInArrow(place, SIDE)


def region_visits(queries: DataFrame, trees, regions, first: int, visits: int, k: int, rest: bool) -> DataFrame:
    """Every query once per region that holds leaves it visits.

    The first leaves of a query are its ``first`` best, and on until more than k rows have been
    seen; the rest are those after them up to number ``visits``.
    """
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = regions.value
        for batch in batches:
            ids = batch.column("vec_id").to_pylist()
            columns, source = [[] for _ in range(5)], []
            for length, rows, matrix in _matrices(batch):
                tree = trees.value.get(length)
                promise = (matrix @ tree.centres.T).tolist() if tree else None
                for n, row in enumerate(rows.tolist()):
                    seen, where = 0, {}
                    for turn, leaf in enumerate(tree.walk(promise[n]) if tree else [-length]):
                        early, size = turn < first or seen <= k, own.sizes.get(leaf, 0)
                        if not early and (turn >= visits or not rest):
                            break
                        if size and early != rest:
                            for region in range(own.first[leaf], own.first[leaf] + own.parts[leaf]):
                                where.setdefault(region, []).append(leaf)
                        seen += size
                    for region, leaves in where.items():
                        for column, value in zip(columns, [region, 0, leaves, ids[row], length]):
                            column.append(value)
                        source.append(row)
            if source:
                yield _side(columns, batch.column("vector").take(pa.array(source)))
    return queries.mapInArrow(visit, SIDE)


def search_regions(rows: DataFrame, visits: DataFrame, bounds: DataFrame | None, k: int) -> DataFrame:
    """Exact scores of each query's best rows in the leaves it visits, per region and salt."""
    loads = visits.groupBy("region").agg((F.ceil(F.count(F.lit(1)) / PART)).cast("int").alias("salts"))
    stay = rows.join(loads, "region").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).withColumn("bound", F.lit(None).cast("double"))
    go = visits.join(loads, "region").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))
    go = go.withColumn("bound", F.lit(float("-inf"))) if bounds is None else go.join(bounds, F.col("id") == F.col("query_id"), "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    columns = ["region", "salt", "kind", "leaf", "leaves", "id", "length", "vector", "bound"]
    both = stay.withColumn("kind", F.lit(0)).select(*columns).unionByName(go.withColumn("kind", F.lit(1)).select(*columns))
    dealt = both.repartition("region", "salt").sortWithinPartitions("region", "salt", "kind", "leaf")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, {}
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("region", "salt", "kind")], axis=1)
            starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])) if len(keys) else []
            for a, b in zip(starts, [*starts[1:], len(keys)]):
                part = batch.slice(a, b - a)
                key = tuple(keys[a][:2].tolist())
                if key != current:
                    current, held = key, {}
                ids = part.column("id").to_numpy()
                if keys[a][2] == 0:  # rows of one region: at most about PART
                    leaf = part.column("leaf").to_numpy()
                    for _, own, matrix in _matrices(part):
                        for n in np.unique(leaf[own]).tolist():
                            of = np.flatnonzero(leaf[own] == n)
                            held.setdefault(n, []).append((ids[own][of], matrix[of]))
                    continue
                bound, leaves = part.column("bound").to_numpy(), part.column("leaves").to_pylist()
                for _, own, matrix in _matrices(part):
                    by_leaf: dict[int, list[int]] = {}
                    for n, row in enumerate(own.tolist()):
                        for leaf in leaves[row]:
                            by_leaf.setdefault(leaf, []).append(n)
                    reach, found = bound[own].copy(), []
                    for leaf, places in by_leaf.items():
                        for row_ids, rows_of in held.get(leaf, []):
                            at = np.array(places)
                            q, r, score = _best(ids[own][at], matrix[at], row_ids, rows_of, reach[at], k)
                            found.append((at[q], row_ids[r], score, np.full(len(q), leaf)))
                    if not found:
                        continue
                    q, vec, score, leaf = (np.concatenate(c) for c in zip(*found))
                    order = np.lexsort((vec, -score, q))
                    best = order[np.arange(len(order)) - np.searchsorted(q[order], q[order]) < k]
                    yield _found(ids[own][q[best]], vec[best], score[best], leaf[best])

    return dealt.mapInArrow(search, FOUND)


def nearest_neighbours(table: DataFrame, k: int = K, every: int = EVERY, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row but the query's own, per query."""
    spark = table.sparkSession
    vectors = materialise(usable_vectors(table), "tree-vectors")
    trees = fit_trees(vectors)
    indexed = materialise(index(vectors, trees), "tree-index")
    sizes = {r["leaf"]: r["count"] for r in indexed.groupBy("leaf").count().collect()}  # one row per leaf of the bounded trees
    longest = vectors.agg(F.max("length")).first()[0] or 1
    regions = spark.sparkContext.broadcast(Regions(sizes, max(1, min(PART, PART_VALUES // longest))))
    visits, _ = calibrated_visits(indexed, trees, k, recall, every)
    shared = spark.sparkContext.broadcast(trees)
    rows = materialise(region_rows(indexed, regions), "tree-regions")
    queries = indexed.filter(F.col("vec_id") % every == 0)
    first = max(1, visits // 8)
    near = materialise(search_regions(rows, region_visits(queries, shared, regions, first, visits, k, False), None, k), "tree-first")
    bounds = _ranked(near, k).filter(F.col("rank") == k).select("query_id", F.col("score").alias("bound"))
    far = search_regions(rows, region_visits(queries, shared, regions, first, visits, k, True), bounds, k)
    return _ranked(near.unionByName(far), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
