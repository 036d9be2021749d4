"""Target-distribution importance resampling of documents.

Features are runs of up to ``longest`` words, hashed to ``BUCKETS`` buckets. The gain of a
bucket is the scaled log ratio of its smoothed frequency in a target corpus to that in the
documents; a document weighs the sum of the gains of its features, read from one array. A Gumbel value
seeded by the document's id is added, and the documents with the highest sums are drawn: a
sample without replacement with probabilities after the weights. Ranks come from a distributed
radix sort (``radix.py``) over (score descending, doc_id).

Text is read twice, once to count buckets and once to score; between the passes only the two
count vectors (at most ``BUCKETS`` rows each) reach the driver, and the array of gains is
broadcast. Rows that the sort moves have no text.

Defined cases: a null or empty text has no feature, weight 0 and is not drawn while ``least_words``
is above 0. Rows without doc_id take no part; of rows that repeat a doc_id the one with the smallest text
counts. Equal scores go to the smaller doc_id. An empty target or an empty table of documents
leaves the smoothed ratios defined; without documents the result is empty. Other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from demandloom.llm.radix import radix_places
from demandloom.llm.tables import one_row_each
from demandloom.sources.storage import materialise

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
SCALE = 1000
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of UTF-8 with A-Z lower-cased


def words(text: bytes | None) -> list[bytes]:
    """Maximal runs of a-z, 0-9 and everything beyond ASCII, A-Z lower-cased."""
    return WORD.findall(text.lower()) if text else []


def feature_buckets(found: list[bytes], longest: int) -> np.ndarray:
    """The bucket of every run of 1 to ``longest`` words."""
    runs = list(found)
    for n in range(2, longest + 1):
        runs += [b" ".join(found[i : i + n]) for i in range(len(found) - n + 1)]
    return np.fromiter((crc32(run) % BUCKETS for run in runs), np.int64, len(runs))


def _texts(batch: pa.RecordBatch) -> Iterator[bytes | None]:
    column = batch.column("text")
    return (value.as_py() for value in column)


def bucket_counts(texts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """bucket, count: the features of all texts, summed in a task before they are shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in _texts(batch):
                own += np.bincount(feature_buckets(words(text), longest), minlength=BUCKETS)
        seen = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(own[seen])], ["bucket", "count"])

    parts = texts.select(F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(count, "bucket int, count long")
    return parts.groupBy("bucket").agg(F.sum("count").alias("count"))


def _vector(counts: DataFrame) -> np.ndarray:
    """Counts by bucket; at most BUCKETS rows."""
    result = np.zeros(BUCKETS, np.int64)
    for row in counts.collect():
        result[row["bucket"]] = row["count"]
    return result


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(SCALE * ln(smoothed target frequency / smoothed source frequency)) by bucket."""
    all_source, all_target = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([
        math.floor(SCALE * math.log((float(t + 1) * all_source) / (float(s + 1) * all_target)))
        for s, t in zip(source.tolist(), target.tolist())
    ], np.int64)


def gumbel(doc_id: int, seed: int) -> int:
    """floor(-SCALE * ln(-ln(u))) with u from a hash of seed and doc_id."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def document_scores(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of rows with doc_id and text."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            n_words, n_features, weight = [], [], []
            for text in _texts(batch):
                found = words(text)
                buckets = feature_buckets(found, longest)
                n_words.append(len(found))
                n_features.append(len(buckets))
                weight.append(int(shared.value[buckets].sum()))
            total = [w + gumbel(i, seed) for i, w in zip(ids, weight)]
            columns = [ids, n_words, n_features, weight, total]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "n_words", "n_features", "weight", "score"])

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(
    documents: DataFrame, target: DataFrame, longest: int = LONGEST, least_words: int = LEAST_WORDS,
    percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank: rank 1, 2... of the drawn documents, else null."""
    docs = one_row_each(documents)
    gain = gains(_vector(bucket_counts(docs, longest)), _vector(bucket_counts(target, longest)))
    scored = materialise(document_scores(docs, gain, longest, seed), "resample-scores")
    long_enough = F.col("n_words") >= least_words
    drawn = scored.filter(long_enough).count() * percent // 100
    ranked = radix_places(scored.filter(long_enough).withColumn("fall", -F.col("score")), ["fall", "doc_id"])
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, rank.alias("rank")).unionByName(
        scored.filter(~long_enough).select(*columns, F.lit(None).cast("long").alias("rank"))
    )


def sample_documents(documents: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn rows of ``documents`` with their texts and all columns."""
    drawn = resample(documents, target, **settings).filter("rank is not null").select("doc_id")
    return documents.join(drawn, documents["doc_id"].cast("long") == drawn["doc_id"], "left_semi")
