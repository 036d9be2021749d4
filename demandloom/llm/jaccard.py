"""N-gram Jaccard join: word shingles, MinHash bands, Bayesian pruning, exact check.

Documents are linked if the sets of their ``SHINGLE``-word shingles have a Jaccard
similarity of at least ``THRESHOLD``. Shingles are 64-bit hashes.

1. Documents with equal sets are one *text*, named by the smallest doc_id; only texts go on.
2. Texts that agree on a band of MinHash values share a bucket. A pair at the threshold
   shares none with a probability of (1 - 0.8^4)^28 = 4e-7. Buckets with the same members are
   used once. Large buckets are dealt out as pairs of blocks, so no task gets a whole one.
3. Inside a block, pairs compare their MinHash values step by step and drop out when the
   posterior probability of reaching the threshold, from a uniform prior, falls below
   ``TOLERANCE``. What is left joins texts to *candidate groups*.
4. All pairs of a candidate group are checked exactly, again block by block: this restores
   links that the prefilter missed within a group. No pair leaves a task: tasks emit each
   text's number of links and one edge per text to the smallest text it is tied to.
5. Connected components are the classes.

The number of links is quadratic in a group of different texts, and so is the time to count
them; memory and rows are not.

Defined cases: null and empty texts have no words, hence no shingles, and are linked to
nothing; a text of fewer than five words has one shingle, all its words. Rows without doc_id
take no part; of rows that repeat a doc_id the one with the smallest text counts. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from hashlib import blake2b
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from demandloom.llm.components import components, part_of, spread_join
from demandloom.llm.tables import one_row_each
from demandloom.llm.words import Words, groups, mix, multipliers, signed, text_chunks, window_names
from demandloom.sources.storage import freeze, materialise

SHINGLE = 5
THRESHOLD = Fraction(4, 5)
BAND, BANDS = 4, 28
HASHES = BAND * BANDS
STEP = 16  # MinHash values compared at a time
TOLERANCE = 1e-6
BUCKET_BLOCK = 512
TEXT_BLOCK = 256

FACTORS = multipliers(HASHES, 11)


def shingles(words: Words, names: np.ndarray, row: int) -> np.ndarray:
    """The sorted distinct shingles of one text."""
    own = names[words.first[row] : words.first[row] + words.counts[row]]
    if not len(own):
        return own
    return np.unique(window_names(own, min(SHINGLE, len(own)), min(SHINGLE, len(own))))


def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set digest, MinHash values and bands of every text with words."""
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        out = {"doc_id": [], "digest": [], "values": [], "bands": []}
        for first, texts in text_chunks(batch.column("text")):
            words = Words(texts)
            names = words.names()
            sets = [shingles(words, names, k) for k in range(len(texts))]
            rows = [k for k, s in enumerate(sets) if len(s)]
            if not rows:
                continue
            at = np.cumsum([0] + [len(sets[k]) for k in rows])[:-1]
            joined = np.concatenate([sets[k] for k in rows])
            values = np.empty((len(rows), HASHES), np.uint64)
            for h in range(HASHES):
                values[:, h] = np.minimum.reduceat((joined * FACTORS[h]) >> np.uint64(20), at)
            bands = np.zeros((len(rows), BANDS), np.uint64)
            for k in range(BAND):
                bands += values[:, k::BAND] * FACTORS[k]
            bands = signed(mix(bands + np.arange(BANDS, dtype=np.uint64) * FACTORS[BAND]))
            small = mix(values).astype(np.uint16)
            for n, k in enumerate(rows):
                out["doc_id"].append(ids[first + k])
                out["digest"].append(blake2b(sets[k].tobytes(), digest_size=16).digest())
                out["values"].append(small[n].tobytes())
                out["bands"].append(bands[n].tolist())
        yield pa.RecordBatch.from_pydict(out, pa.schema([
            ("doc_id", pa.int64()), ("digest", pa.binary()), ("values", pa.binary()), ("bands", pa.list_(pa.int64())),
        ]))


@lru_cache
def least_matches(compared: int) -> int:
    """Fewest equal values of so many for which the posterior stays at or above TOLERANCE.

    With a uniform prior the posterior of the similarity after m of n is Beta(m+1, n-m+1),
    and P(similarity >= t) = P(Binomial(n+1, t) <= m).
    """
    t, total = float(THRESHOLD), 0.0
    for m in range(compared + 1):
        total += comb(compared + 1, m) * t**m * (1 - t) ** (compared + 1 - m)
        if total >= TOLERANCE:
            return m
    return compared


def surviving_pairs(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows that no step prunes; left and right are index arrays of equal length."""
    matches = np.zeros(len(left), np.int32)
    for start in range(0, HASHES, STEP):
        part = values[:, start : start + STEP]
        matches = matches + (part[left] == part[right]).sum(axis=1, dtype=np.int32)
        alive = matches >= least_matches(min(start + STEP, HASHES))
        left, right, matches = left[alive], right[alive], matches[alive]
        if not len(left):
            break
    return left, right


def roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest reachable row of each row."""
    label = np.arange(count)
    while len(left):
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _block_pairs(block: np.ndarray, one: int, two: int, width: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs between blocks one and two (within one, if they are the same), in bounded pieces."""
    a, b = np.flatnonzero(block == one), np.flatnonzero(block == two)
    step = max(1, width // max(1, len(b)))
    for start in range(0, len(a), step):
        left, right = np.repeat(a[start : start + step], len(b)), np.tile(b, len(a[start : start + step]))
        if one == two:
            ahead = left < right
            left, right = left[ahead], right[ahead]
        if len(left):
            yield left, right


def dealt(members: DataFrame, group: str, size: int) -> DataFrame:
    """Members of groups with ``total`` members, once for each pair of blocks that needs them.

    A group of up to ``size`` members is one block. Columns one, two: the pair; block: own.
    """
    blocks = F.ceil(F.col("total") / size).cast("int")
    return (
        members.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
        .drop("other", "blocks", "total")
        .repartition(group, "one", "two").sortWithinPartitions(group, "one", "two", "doc_id")
    )


def pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges a, b between texts of a bucket that survive, one per text at most."""
    a_side, b_side = [], []
    for table in groups(batches, ["bucket", "one", "two"]):
        doc = table.column("doc_id").to_numpy()
        block = table.column("block").to_numpy()
        values = np.frombuffer(b"".join(table.column("values").to_pylist()), np.uint16).reshape(len(doc), HASHES)
        found = [surviving_pairs(values, x, y) for x, y in _block_pairs(block, table.column("one")[0].as_py(), table.column("two")[0].as_py())]
        if found:
            label = roots(len(doc), *(np.concatenate(x) for x in zip(*found)))
            tied = np.flatnonzero(label != np.arange(len(doc)))
            a_side.append(doc[tied])
            b_side.append(doc[label[tied]])
        if len(a_side) >= 1000:
            yield _edges(a_side, b_side)
            a_side, b_side = [], []
    yield _edges(a_side, b_side)


def _edges(a_side: list[np.ndarray], b_side: list[np.ndarray]) -> pa.RecordBatch:
    none = [np.zeros(0, np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_side or none)), pa.array(np.concatenate(b_side or none))], ["a", "b"])


def linked_pairs(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose exact similarity reaches the threshold."""
    sizes = np.array([len(s) for s in sets])
    near = np.minimum(sizes[left], sizes[right]) * THRESHOLD.denominator >= np.maximum(sizes[left], sizes[right]) * THRESHOLD.numerator
    left, right = left[near], right[near]
    if not len(left):
        return left, right
    _, shared, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(counts > 1) - 1
    owner = np.repeat(np.arange(len(sets)), sizes)
    used = counts[shared] > 1
    owner, shared = owner[used], column[shared[used]]
    both = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(shared, kind="stable")
    owner, shared = owner[order], shared[order]
    width = max(256, (1 << 22) // len(sets))
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(shared, [start, start + width])
        held = np.zeros((len(sets), width), np.float32)
        held[owner[lo:hi], shared[lo:hi] - start] = 1
        both += held @ held.T
    common = both[left, right].astype(np.int64)
    t = THRESHOLD
    enough = common * (t.numerator + t.denominator) >= (sizes[left] + sizes[right]) * t.numerator
    return left[enough], right[enough]


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, links (documents of linked texts), root: per text and pair of blocks."""
    for table in groups(batches, ["label", "one", "two"]):
        doc, block, copies = (table.column(c).to_numpy() for c in ("doc_id", "block", "copies"))
        words = Words(table.column("text").to_pylist())
        names = words.names()
        sets = [shingles(words, names, k) for k in range(len(doc))]
        links, tied = np.zeros(len(doc), np.int64), []
        for x, y in _block_pairs(block, table.column("one")[0].as_py(), table.column("two")[0].as_py()):
            x, y = linked_pairs(sets, x, y)
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            tied.append((x, y))
        if tied:
            label = roots(len(doc), *(np.concatenate(x) for x in zip(*tied)))
            rows = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[rows]), pa.array(links[rows]), pa.array(doc[label[rows]])], ["doc_id", "links", "root"]
            )


def jaccard_join(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class) and n_links (linked documents) of every document."""
    texts = one_row_each(docs)
    signed_ = materialise(
        texts.mapInArrow(signatures, "doc_id long, digest binary, values binary, bands array<long>"), "jaccard-signatures"
    )
    kinds = materialise(
        signed_.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")), "jaccard-texts"
    )
    banded = (
        signed_.join(kinds.select("doc_id"), "doc_id", "left_semi")
        .select("doc_id", F.explode("bands").alias("bucket"))
    )
    members = F.struct(F.count(F.lit(1)).alias("total"), F.bit_xor(F.xxhash64("doc_id")).alias("mix"), F.min("doc_id").alias("least"))
    buckets = (
        banded.groupBy("bucket").agg(members.alias("members")).filter("members.total > 1")
        .groupBy("members").agg(F.min("bucket").alias("bucket")).select("bucket", "members.total")
    )
    chosen = banded.join(buckets, "bucket").join(signed_.select("doc_id", "values"), "doc_id")
    candidates = components(materialise(dealt(chosen, "bucket", BUCKET_BLOCK).mapInArrow(pruned, "a long, b long"), "jaccard-candidates"))
    sizes = candidates.groupBy("label").agg(F.count(F.lit(1)).alias("total"))
    sized = spread_join(candidates.select("node", "label", part_of("node")), "label", sizes).drop("part")
    grouped = materialise(
        sized.withColumnRenamed("node", "doc_id").join(kinds.select("doc_id", "copies"), "doc_id"), "jaccard-groups"
    )
    checked = materialise(
        dealt(texts.join(grouped, "doc_id"), "label", TEXT_BLOCK).mapInArrow(verified, "doc_id long, links long, root long"),
        "jaccard-links",
    )
    links = checked.groupBy("doc_id").agg(F.sum("links").alias("links"))
    classes = components(checked.select(F.col("doc_id").alias("a"), F.col("root").alias("b")))
    by_text = (
        kinds.join(links, "doc_id", "left").join(classes.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("digest", F.coalesce("label", "doc_id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    found = signed_.select("doc_id", "digest").join(by_text, "digest").drop("digest")
    return texts.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each class, the one with the smallest doc_id; rows without doc_id stay."""
    gone = materialise(jaccard_join(docs).filter("class_id != doc_id").select("doc_id"), "jaccard-gone")
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id"))
    return own.join(gone, "doc_id", "left_anti").select("row.*")
