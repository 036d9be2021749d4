"""Exact top-k inner products by a three-phase uniform threshold.

A vector is cut into ``LISTS`` stretches of components; a list holds a stretch's part of
every score, and a score is the sum over the lists. Lists are spread over the partitions of
the vectors, one local list for each partition and stretch.

1. Each local list gives a query's ``k`` best parts, with the whole scores of those vectors
   (a task has all stretches of its vectors). A task keeps its ``k`` best scores a query while
   it reads its vectors, so it gives at most ``k`` rows a query. The k-th best of these scores
   is a lower bound of the query's k-th best.
2. The bounds are broadcast. With bound B a vector can only be among the k best if one of
   its parts is at least B / LISTS, the uniform cutoff. Local lists are read down to it.
   Unread parts are below the cutoff, so read parts plus cutoffs bound a score from above;
   vectors bounded below B drop out.
3. The remaining vectors' missing parts are resolved, and scores of at least B are kept.

A window then ranks them. Queries go in blocks of ``QUERY_BLOCK`` by vec_id: only a block's
vectors and bounds are broadcast, and a pass over the candidates serves the whole block.
Scores are exact integers: components are multiplied in limbs of 20 bits over stretches of at
most 4096 components, so every partial sum is a whole number below 2^53.

Defined cases: vectors that are null or empty, or hold a null or a non-finite component,
take no part, and neither do rows without vec_id. Of rows that repeat a vec_id the one with
the smallest vector counts. Only vectors of the query's length are candidates. Ties go to the
smaller vec_id. A pair whose products add up to 2^63 or more in size raises an error, as its
score may not fit a long. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from demandloom.sources.storage import materialise, stage_path

K = 20
LISTS = 4
SCALE = 64
EVERY = 20
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 1024
LIMB = 20
EXACT_STRETCH = 4096
WHOLE = 1 << 63


def whole_vectors(table: DataFrame) -> DataFrame:
    """vec_id and vector: floor(SCALE * x) of usable rows, one per vec_id."""
    fit = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(1.7976931348623157e308))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size("x") > 0) & F.forall("x", fit))
    one = rows.groupBy("vec_id").agg(F.min("x").alias("x"))
    return one.select("vec_id", F.size("x").alias("length"), F.transform("x", lambda x: F.floor(x * SCALE).cast("long")).alias("vector"))


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, vec_ids, matrix) of bounded blocks of vectors of one length."""
    ids, lengths = batch.column("vec_id").to_numpy(), batch.column("length").to_numpy()
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        for start in range(0, len(rows), CANDIDATE_BLOCK):
            own = rows[start : start + CANDIDATE_BLOCK]
            matrix = batch.column("vector").take(pa.array(own)).flatten().to_numpy().reshape(len(own), length)
            yield int(length), ids[own], matrix


def _limbs(matrix: np.ndarray) -> list[np.ndarray]:
    """Limbs as doubles, lowest first; all but the last lie in [0, 2^20)."""
    limbs = []
    while len(matrix) and (matrix.min() < -(1 << LIMB) or matrix.max() > 1 << LIMB):
        limbs.append((matrix & ((1 << LIMB) - 1)).astype(np.float64))
        matrix = matrix >> LIMB
    return [*limbs, matrix.astype(np.float64)]


def _check(queries: np.ndarray, matrix: np.ndarray) -> None:
    """Raises if the sizes of a pair's products add up to 2^63; the plain bound spares most blocks the work."""
    q, c = (np.abs(x.astype(np.float64)) for x in (queries, matrix))
    if q.max() * c.max() * q.shape[1] >= WHOLE / 2 and (q @ c.T).max() * (1 + 1e-9) >= WHOLE:
        raise OverflowError("a score may not fit 64 bits")


def _parts(queries: np.ndarray, matrix: np.ndarray) -> list[np.ndarray]:
    """The part of every score in each stretch, as long."""
    _check(queries, matrix)
    cuts = np.linspace(0, queries.shape[1], min(LISTS, queries.shape[1]) + 1).astype(int)
    left, right, parts = _limbs(queries), _limbs(matrix), []
    for a, b in zip(cuts[:-1], cuts[1:]):
        part = np.zeros((len(queries), len(matrix)), np.int64)
        for start in range(a, b, EXACT_STRETCH):
            own = slice(start, min(start + EXACT_STRETCH, b))
            for i, q in enumerate(left):
                for j, c in enumerate(right):
                    if LIMB * (i + j) < 64:  # beyond, a limb's product is zero or the check has raised
                        part += (q[:, own] @ c[:, own].T).astype(np.int64) << (LIMB * (i + j))
        parts.append(part)
    return parts


SCORES = "query_id long, vec_id long, score long"
RANKED = "query_id long, rank int, vec_id long, score long"


NO_SCORE = np.iinfo(np.int64).min


def _scored(query_ids: np.ndarray, ids: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (query_ids, ids, score)], ["query_id", "vec_id", "score"])


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` greatest of each row."""
    k = min(k, scores.shape[1])
    return np.argpartition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k :]


def local_lists(block, k: int):
    """Phase 1: scores of the vectors with the k best parts of each local list, the k best of a task."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for batch in batches:
            for length, ids, matrix in _blocks(batch):
                if length not in block.value:
                    continue
                query_ids, queries, _ = block.value[length]
                parts = _parts(queries, matrix)
                own = query_ids[:, None] == ids[None, :]
                listed = np.zeros(own.shape, bool)
                for part in parts:
                    np.put_along_axis(listed, _best(part, k + 1), True, axis=1)  # one more, as the query may be its own best
                reach = np.where(listed & ~own, sum(parts), NO_SCORE)
                named = np.broadcast_to(ids, reach.shape)
                if length in held:
                    reach, named = np.hstack([held[length][0], reach]), np.hstack([held[length][1], named])
                best = _best(reach, k)
                held[length] = np.take_along_axis(reach, best, axis=1), np.take_along_axis(named, best, axis=1)
        for length, (score, ids) in held.items():
            q, place = np.nonzero(score != NO_SCORE)
            yield _scored(block.value[length][0][q], ids[q, place], score[q, place])
    return find


def above_bound(block):
    """Phases 2 and 3: exact scores of the vectors that the cutoff leaves and that reach the bound."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, ids, matrix in _blocks(batch):
                if length not in block.value:
                    continue
                query_ids, queries, bounds = block.value[length]
                parts = _parts(queries, matrix)
                # Some part of a score of at least the bound reaches it. Without a bound all is read.
                cutoff = np.where(bounds == NO_SCORE, NO_SCORE, bounds // len(parts))[:, None]
                read = np.zeros(parts[0].shape, bool)
                most = np.zeros(parts[0].shape)
                for part in parts:
                    seen = part >= cutoff
                    read |= seen
                    most += np.where(seen, part, cutoff)
                slack = (1e-9 * np.abs(bounds.astype(np.float64)) + 1)[:, None] + 1e-9 * np.abs(most)
                q, c = np.nonzero(read & (most + slack >= bounds[:, None]) & (query_ids[:, None] != ids[None, :]))
                score = sum(part[q, c] for part in parts)
                enough = score >= bounds[q]
                yield _scored(query_ids[q[enough]], ids[c[enough]], score[enough])
    return find


def topk_search(table: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every row but the query's own, per query."""
    spark = table.sparkSession
    vectors = materialise(whole_vectors(table), "topk-vectors")
    queries = vectors.filter(F.col("vec_id") % every == 0)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    path, last = stage_path(spark, "topk-found"), None
    spark.createDataFrame([], RANKED).write.parquet(path)
    while True:
        rest = queries if last is None else queries.filter(F.col("vec_id") > last)
        rows = rest.orderBy("vec_id").limit(QUERY_BLOCK).collect()  # one block of queries
        if not rows:
            return spark.read.schema(RANKED).parquet(path)
        last = rows[-1].vec_id
        groups = {n: [r for r in rows if r.length == n] for n in {r.length for r in rows}}
        block = {n: (np.array([r.vec_id for r in own]), np.array([r.vector for r in own], np.int64), None) for n, own in groups.items()}
        sent = spark.sparkContext.broadcast(block)
        lists = vectors.mapInArrow(local_lists(sent, k), SCORES)
        at_k = lists.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k).select("query_id", "score").collect()
        bound = {r.query_id: r.score for r in at_k}  # at most one row per query of the block
        cut = {n: (ids, matrix, np.array([bound.get(i, NO_SCORE) for i in ids.tolist()], np.int64)) for n, (ids, matrix, _) in block.items()}
        sent_cut = spark.sparkContext.broadcast(cut)
        scores = vectors.mapInArrow(above_bound(sent_cut), SCORES)
        ranked = scores.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)
        ranked.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
        for used in (sent, sent_cut):
            used.unpersist()
