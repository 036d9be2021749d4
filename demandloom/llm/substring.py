"""Removal of repeated passages, found by recompression.

A *window* is ``WINDOW`` consecutive words of one document. A word goes if a window that
covers it has the same words as a window that starts earlier (smaller doc_id, or the same
document and an earlier start).

Recompression shrinks each text in rounds. A round names maximal runs of one symbol, or
splits the symbols at random into left and right ones and names each pair of a left symbol
followed by a right one. Names are hashes of what they stand for, so they are the same in
every task without a dictionary. Equal windows agree on the symbols in their interior: per
round only the outermost symbol on either side may depend on the surroundings. The
*anchor* of a window is one such symbol of the highest round that leaves enough of them,
so equal windows have equal anchors, at the same place. More rounds than ``ROUNDS`` leave
too few symbols within 20 words.

1. ``anchored``: every window gets its anchor; neighbouring windows with one anchor form a
   *stretch*, named twice: by the anchor and its neighbour symbols (``key``), and by all its
   words (``span``).
2. One shuffle by ``key`` finds shared anchors. If all stretches of a key have one span, the
   first keeps its words and the others' windows are repeats. Else the key is *mixed*.
3. Only windows of mixed keys are named one by one (128 bits) and grouped.

Stretches and windows that recur within a batch are combined before the shuffle: a passage
in a third of all documents reaches it as one row per batch. Names have 128 bits together,
so a false repeat has a probability under 2^-40 even among 10^13 windows.

Defined cases: null and empty text: no words. Rows without doc_id take no part. Of rows that
repeat a doc_id the one with the smallest text counts. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window
from pyspark.sql.types import StringType

from demandloom.llm.tables import one_row_each, repeated_keys
from demandloom.llm.words import (
    Powers, Words, array_column, mix, multipliers, signed, split_words, stretch_names, text_chunks, window_names,
)
from demandloom.sources.storage import materialise

WINDOW = 20
ROUNDS = 2  # of pairs, after one of runs
BASE = np.uint64(0x9E3779B97F4A7C15)


# --- recompression of the words of many documents side by side -------------------------------

def _runs(names: np.ndarray, gap: np.ndarray):
    """Symbols with runs named as one, the new index of each old symbol, kept positions."""
    first = np.ones(len(names), bool)
    first[1:] = (names[1:] != names[:-1]) | gap[1:] | gap[:-1]
    at = np.flatnonzero(first)
    length = np.diff(at, append=len(names)).astype(np.uint64)
    named = np.where(length > 1, mix(names[at] + length * BASE), names[at])
    return named, np.cumsum(first) - 1, at


def _pairs(names: np.ndarray, gap: np.ndarray, turn: int):
    """As ``_runs``, with the left and right flags of the old symbols."""
    right = (mix(names + multipliers(1, turn)) >> np.uint64(63)).astype(bool)
    left = ~right & ~gap
    right &= ~gap
    joined = np.zeros(len(names), bool)
    joined[:-1] = left[:-1] & right[1:]
    first = np.ones(len(names), bool)
    first[1:] = ~joined[:-1]
    at = np.flatnonzero(first)
    factors = multipliers(2, turn + 7)
    partner = names[np.minimum(at + 1, len(names) - 1)]
    named = np.where(joined[at], mix(names[at] * factors[0] + partner * factors[1]), names[at])
    return named, np.cumsum(first) - 1, at, left, right


def _least(names: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Place of the smallest name between first and last, the leftmost of equal ones."""
    tables = [np.arange(len(names))]
    while 2 << (len(tables) - 1) <= int((last - first).max()) + 1:
        half = 1 << (len(tables) - 1)
        one, two = tables[-1][:-half], tables[-1][half:]
        tables.append(np.where(names[one] <= names[two], one, two))
    width = np.floor(np.log2(last - first + 1)).astype(np.int64)
    best = np.empty(len(first), np.int64)
    for k, table in enumerate(tables):
        rows = np.flatnonzero(width == k)
        one, two = table[first[rows]], table[last[rows] - (1 << k) + 1]
        best[rows] = np.where(names[one] <= names[two], one, two)
    return best


def anchors(hashes: np.ndarray, gap: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and name of each window's anchor; ``gap`` marks the places between texts.

    The anchor is the least of the interior symbols of the highest round that leaves three,
    named with its neighbours.
    """
    names, at = hashes, np.arange(len(hashes))
    lo, hi = starts, starts + WINDOW - 1
    rounds, none = [(names, at, lo, hi)], np.zeros(len(starts), bool)
    for turn in range(ROUNDS + 1):
        if turn == 0:
            named, index, kept = _runs(names, gap)
            lo, hi = index[lo] + 1, index[hi] - 1
        else:
            named, index, kept, left, right = _pairs(names, gap, turn)
            inner, outer = lo + right[lo], hi - left[hi]
            none = none | (inner > outer)
            lo, hi = index[np.minimum(inner, len(names) - 1)], np.where(none, -1, index[outer])
        names, at, gap = named, at[kept], gap[kept]
        lo = np.minimum(lo, len(names) - 1)
        rounds.append((names, at, lo, hi))
    place, name = np.empty(len(starts), np.int64), np.empty(len(starts), np.uint64)
    open_ = np.ones(len(starts), bool)
    factors = multipliers(3, 5)
    for names, at, lo, hi in reversed(rounds):
        rows = np.flatnonzero(open_ & (hi - lo >= 2))
        if len(rows):
            least = _least(names, lo[rows] + 1, hi[rows] - 1)
            place[rows] = at[least]
            name[rows] = mix(names[least - 1] * factors[0] + names[least] * factors[1] + names[least + 1] * factors[2])
            open_[rows] = False
    return place, name


SPAN_POWERS = Powers(0x9E3779B97F4A7C15)


def stretches(texts: list[str | None]):
    """(text number, first window, windows, key, span) of every stretch of the texts."""
    words = Words(texts)
    counts = np.maximum(words.counts - WINDOW + 1, 0)
    total = int(counts.sum())
    if not total:
        return (np.zeros(0, np.int64),) * 5
    # Words of all texts with a gap after each text.
    begins = words.first + np.arange(len(texts))
    gap = np.zeros(len(words.begin) + len(texts), bool)
    gap[begins + words.counts] = True
    hashes = np.zeros((2, len(gap)), np.uint64)
    hashes[0, ~gap], hashes[1, ~gap] = words.names(0), words.names(1)
    text = np.repeat(np.arange(len(texts)), counts)
    start = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + begins[text]
    place, key = anchors(hashes[0], gap, start)
    first = np.ones(total, bool)
    first[1:] = (key[1:] != key[:-1]) | (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(first)
    windows = np.diff(at, append=total)
    begin = start[at]
    span = stretch_names(hashes[1], SPAN_POWERS, begin, begin + windows + WINDOW - 1)
    return text[at], begin - begins[text[at]], windows, signed(key[at]), signed(span)


def combined(key: np.ndarray, other: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, pa.ListArray, pa.ListArray]:
    """Rows with equal (key, other) as their first, with the rest in lists."""
    order = np.lexsort((start, doc, other, key))
    first = np.ones(len(order), bool)
    first[1:] = (key[order][1:] != key[order][:-1]) | (other[order][1:] != other[order][:-1])
    counts = np.diff(np.flatnonzero(first), append=len(order)) - 1
    rest = order[~first]
    return order[first], array_column(doc[rest], counts), array_column(start[rest].astype(np.int32), counts)


STRETCH = "key long, span long, doc_id long, start int, windows int, docs array<long>, starts array<int>"
NAMED = "key long, span long, doc_id long, start int, docs array<long>, starts array<int>"


def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        parts = []
        for row, texts in text_chunks(batch.column("text")):
            text, start, windows, key, span = stretches(texts)
            parts.append((ids[row + text], start, windows, key, span))
        doc, start, windows, key, span = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 5
        kept, docs, starts = combined(key, span, doc, start)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[kept]), pa.array(span[kept]), pa.array(doc[kept].astype(np.int64)), pa.array(start[kept].astype(np.int32)),
             pa.array(windows[kept].astype(np.int32)), docs, starts],
            ["key", "span", "doc_id", "start", "windows", "docs", "starts"],
        )


def repeated(rows: DataFrame, extra: list[str]) -> DataFrame:
    """Occurrences of keys that occur more than once, with ``mixed`` and ``later``: not the key's first."""
    by_key = Window.partitionBy("key")
    own = F.struct("doc_id", "start")
    seen = rows.select(
        "*", (F.min("span").over(by_key) != F.max("span").over(by_key)).alias("mixed"),
        F.sum(1 + F.coalesce(F.size("docs"), F.lit(0))).over(by_key).alias("times"), F.min(own).over(by_key).alias("first"),
    ).filter("times > 1")
    return seen.select(
        *extra, "mixed", "first",
        F.explode(F.when(F.col("docs").isNull(), F.array(own)).otherwise(
            F.concat(F.array(own), F.arrays_zip(F.col("docs").alias("doc_id"), F.col("starts").alias("start")))
        )).alias("at"),
    ).select(*extra, "mixed", "at.doc_id", "at.start", (F.col("at") != F.col("first")).alias("later"))


# --- windows of mixed keys ---------------------------------------------------------------------

def _covered(marks, length: int, field: str = "mixed") -> tuple[np.ndarray, np.ndarray]:
    """Start positions of windows in mixed stretches, and of those in wholly repeated ones."""
    mixed, later = np.zeros(length + 1, np.int64), np.zeros(length + 1, np.int64)
    for mark in marks:
        to = mixed if mark[field] else later
        to[mark["start"]] += 1
        to[mark["start"] + mark["windows"]] -= 1
    return np.cumsum(mixed)[:-1] > 0, np.cumsum(later)[:-1] > 0


def mixed_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """128-bit names of the windows in mixed stretches."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        all_marks = batch.column("marks").to_pylist()
        parts = [(np.zeros(0, np.int64),) * 4]
        for row in range(batch.num_rows):
            if any(m["mixed"] for m in all_marks[row]):
                words = Words([batch.column("text")[row].as_py()])
                start = np.flatnonzero(_covered(all_marks[row], len(words.begin))[0])
                one, two = (signed(window_names(words.names(k), WINDOW, k)[start]) for k in (0, 1))
                parts.append((one, two, np.full(len(start), ids[row]), start))
        key, span, doc, start = (np.concatenate(x) for x in zip(*parts))
        kept, docs, starts = combined(key, span, doc, start)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[kept]), pa.array(span[kept]), pa.array(doc[kept]), pa.array(start[kept].astype(np.int32)), docs, starts],
            ["key", "span", "doc_id", "start", "docs", "starts"],
        )


# --- rewriting ---------------------------------------------------------------------------------

def removed_words(length: int, marks, singles) -> np.ndarray:
    """Which words go: those covered by a window in a repeated stretch or a repeated single window."""
    goes = np.zeros(length + 1, np.int64)
    later = _covered(marks, length)[1]
    later[np.asarray(singles or [], np.int64)] = True
    at = np.flatnonzero(later)
    np.add.at(goes, at, 1)
    np.add.at(goes, at + WINDOW, -1)
    return np.cumsum(goes)[:-1] > 0


def without(words: Words, gone: np.ndarray) -> str:
    """The one text of ``words`` without the marked ones and the blanks after them; all else stays."""
    out, at, data = [], 0, words.data[:-1]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    for first, stop in zip(edges[::2], edges[1::2]):
        out.append(data[at : words.begin[first]])
        at = words.begin[stop] if stop < len(gone) else len(data)
    return b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")


def digest(words: Words, keep: np.ndarray) -> str:
    """SHA-256 of the kept words, joined by one space."""
    pairs = zip(words.begin[keep].tolist(), words.end[keep].tolist())
    return sha256(b" ".join([words.data[a:b] for a, b in pairs])).hexdigest()


REWRITTEN = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = {"doc_id": [], "n_words": [], "n_removed": [], "kept_sha256": [], "kept_text": []}
        for row in batch.to_pylist():
            words = Words([row["text"]])
            gone = removed_words(len(words.begin), row["marks"], row["singles"])
            values = (row["doc_id"], len(gone), int(gone.sum()), digest(words, ~gone), without(words, gone))
            for name, value in zip(rows, values):
                rows[name].append(value)
        yield pa.RecordBatch.from_pydict(rows, pa.schema([
            ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
            ("kept_sha256", pa.string()), ("kept_text", pa.string()),
        ]))


def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word count and digest of every text as it is."""
    for batch in batches:
        column, counts, digests = batch.column("text"), [], []
        for row in range(batch.num_rows):
            words = split_words(column[row].as_py())
            counts.append(len(words))
            digests.append(sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string())],
            ["doc_id", "n_words", "kept_sha256"],
        )


def rewritten(texts: DataFrame) -> DataFrame:
    """``REWRITTEN`` rows of the documents that share a stretch; all others stay as they are."""
    found = repeated(texts.mapInArrow(anchored, STRETCH), ["windows"]).filter("mixed or later")
    marks = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "windows", "mixed")).alias("marks"))
    shared = materialise(texts.join(marks, "doc_id"), "repeats-shared")
    single = repeated(shared.mapInArrow(mixed_windows, NAMED).withColumn("key", F.xxhash64("key", "span")), [])
    singles = single.filter("later").groupBy("doc_id").agg(F.collect_list("start").alias("singles"))
    return shared.join(singles, "doc_id", "left").mapInArrow(rewrite, REWRITTEN)


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    texts = one_row_each(docs)
    changed = materialise(rewritten(texts).drop("kept_text"), "repeats-changed")
    rest = texts.mapInArrow(plain, "doc_id long, n_words long, kept_sha256 string")
    return rest.join(changed.select("doc_id", "n_removed", F.col("kept_sha256").alias("new")), "doc_id", "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("new", "kept_sha256").alias("kept_sha256"),
    )


def cut_places(texts: DataFrame) -> DataFrame:
    """doc_id, marks, singles of the documents with a repeated window: what ``removed_words`` needs.

    Only the lookup of mixed windows joins texts; the places themselves hold none.
    """
    found = repeated(texts.mapInArrow(anchored, STRETCH), ["windows"]).filter("mixed or later")
    marks = materialise(found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "windows", "mixed")).alias("marks")), "repeats-marks")
    mixed = texts.join(marks.filter("exists(marks, m -> m.mixed)"), "doc_id")
    single = repeated(mixed.mapInArrow(mixed_windows, NAMED).withColumn("key", F.xxhash64("key", "span")), [])
    singles = single.filter("later").groupBy("doc_id").agg(F.collect_list("start").alias("singles"))
    return marks.join(singles, "doc_id", "left").filter("singles is not null or exists(marks, m -> not m.mixed)")


@F.arrow_udf(StringType())
def cut_text(text: pa.Array, marks: pa.Array, singles: pa.Array) -> pa.Array:
    out = []
    for row in range(len(text)):
        own, words = marks[row].as_py(), None
        if own is not None:
            words = Words([text[row].as_py()])
            words = without(words, removed_words(len(words.begin), own, singles[row].as_py()))
        out.append(words)
    return pa.array(out, pa.string())


def drop_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated passages cut out of ``text``; same columns and rows.

    ``n_chars``, where present, follows the text. Rows that repeat a doc_id get one text.
    """
    texts, again = one_row_each(docs), repeated_keys(docs)
    cuts = cut_places(texts).withColumn("text", F.lit(None).cast("string"))
    if not again.isEmpty():
        cuts = cuts.drop("text").join(texts.join(again, "doc_id"), "doc_id", "left")
    cuts = materialise(cuts, "repeats-cuts")
    joined = docs.alias("d").join(cuts.alias("c"), F.col("d.doc_id").cast("long") == F.col("c.doc_id"), "left")
    cut = F.col("c.doc_id").isNotNull()
    # Texts without a cut don't go to Python.
    judged = F.when(cut, F.coalesce("c.text", F.col("d.text").cast("string"), F.lit("")))
    new = F.coalesce(cut_text(judged, F.col("c.marks"), F.col("c.singles")), F.col("d.text").cast("string"))
    now = {"text": new.alias("text")}
    if "n_chars" in docs.columns:
        length = F.when(cut, F.length(new)).otherwise(F.col("d.n_chars"))
        now["n_chars"] = length.cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return joined.select(*[now.get(c, F.col(f"d.`{c}`")) for c in docs.columns])
