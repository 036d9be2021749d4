"""Secret scan: candidates by their look, false positives removed by a random forest.

Candidates: unbroken runs of ``[A-Za-z0-9_+/=-]`` with at least ``SHORTEST`` characters, of
which one is a digit or all are capitals, with the words and the assignment before them.

Labelled findings: formats of known issuers, and values assigned to a telling name, are
labelled secrets (``KNOWN``, ``TELLING``); UUIDs, dates, numbers, plain words, repeated characters and
placeholders (``HARMLESS``) are labelled false. A user's own findings can be added. The
forest learns from at most ``LABELLED`` of them, ``LABELLED / 2`` of each label, taken by a hash
of the value, and judges every candidate, labelled or not. To learn the look and not the
rule that labels, the assignment before a value and its name are no features: neighbouring words
are those before the assignment and the one behind the value.

Features: length, entropy, shares of digits, capitals, lower case and marks; mean log
probability of character transitions under counts from all prose words of the table;
dictionary coverage (share of characters in words that occur at least ``COMMON`` times); the place, a
path or URL around the value or not; neighbouring words, as log odds from the labelled findings of
the other fold (values are split in two by hash), so that no finding's own label is in its odds.

Counts of words and transitions cover all documents and combine before their shuffles. What
goes to tasks is bounded: 64 x 64 transition counts and the forest; the dictionary is joined.

Defined cases: null and empty texts have no candidates. Rows without doc_id are scanned too;
repeated rows are scanned one by one. With one label or none among the findings, labelled
candidates keep their label and others count as secrets only if their label says so. Other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from demandloom.sources.storage import materialise

SHORTEST = 12
LABELLED = 20_000  # bound of the labelled findings that the forest learns from
TREES, DEPTH, SEED = 30, 8, 17
COMMON = 3  # occurrences of a word of the dictionary
LETTERS = 64

CANDIDATE = re.compile(r"(?<![A-Za-z0-9_+/=\-])[A-Za-z0-9_+/\-][A-Za-z0-9_+/=\-]{%d,}" % (SHORTEST - 1))
NAMED = re.compile(r"([A-Za-z_\-]*)[\"']?\s{0,3}[:=]\s{0,3}[\"']?$")
INSIDE = re.compile(r"^([A-Za-z_\-]+)=(.+)$")
#: Fixed: public formats of issued keys, and names that announce a secret.
KNOWN = re.compile(r"^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^sk_(?:live|test)_[A-Za-z0-9]{16,}$|^AIza[0-9A-Za-z_\-]{35}$|^eyJ[A-Za-z0-9_\-]{20,}$")
TELLING = re.compile(r"pass(?:word|wd|phrase)?$|secret|token|api[_-]?key|access[_-]?key|auth|credential", re.IGNORECASE)
HARMLESS = re.compile(
    r"^[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}$|^[0-9][0-9_+/=\-]*$|^[A-Za-z]+$|(.)\1{5}|example|placeholder|changeme|your[_-]|xxxx|^[a-z]+(?:[-_/+][a-z]+)+$",
    re.IGNORECASE,
)

FOUND = "row long, place int, start int, end int, value string, name string, context array<string>, in_path boolean, label int"


def findings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every candidate with its surroundings and the label that its format gives."""
    names = ["row", "place", "start", "end", "value", "name", "context", "in_path", "label"]
    types = pa.schema(list(zip(names, [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.string()), pa.bool_(), pa.int32()])))
    for batch in batches:
        out = {n: [] for n in names}
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text")):
            text = text.as_py()
            for place, match in enumerate(CANDIDATE.finditer(text)):
                start, value = match.start(), match[0]
                before = text[max(0, start - 60) : start]
                named = NAMED.search(before)
                name = named[1] if named else ""
                if inside := INSIDE.match(value):  # name=value in one run
                    name, value = inside[1], inside[2]
                    start = match.end() - len(value)
                value = value.rstrip("=") if not name and value.endswith("===") else value
                if len(value) < SHORTEST or not (any(c.isdigit() for c in value) or value.isupper()):
                    continue
                after = text[match.end() : match.end() + 40]
                ahead = before[: named.start()] if named else before
                context = [w.lower() for w in ahead.split()[-2:] + after.split()[:1]]
                label = 1 if KNOWN.search(value) or (TELLING.search(name) and not HARMLESS.search(value)) else 0 if HARMLESS.search(value) else None
                edge = (before[-1:] + after[:1]).replace('"', "").replace("'", "")
                in_path = value.count("/") > 1 or before.endswith(("/", ".", "://")) or "/" in edge
                for n, v in zip(names, (row, place, start, start + len(value), value, name, context, in_path, label)):
                    out[n].append(v)
        yield pa.RecordBatch.from_pydict(out, types)


def _letter(c: str) -> int:
    """Class of a character: 26 letters, 26 capitals, digits and marks, the rest."""
    code = ord(c)
    if 97 <= code <= 122:
        return code - 97
    if 65 <= code <= 90:
        return code - 39
    return 52 if 48 <= code <= 57 else 53 if c in "-_" else 54 if c in "+/=" else 55


def transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pair counts of character classes over words and their times, one matrix per task."""
    counts = np.zeros((LETTERS, LETTERS))
    for batch in batches:
        for word, times in zip(batch.column("word").to_pylist(), batch.column("times").to_pylist()):
            codes = [_letter(c) for c in word]
            for pair in zip(codes[:-1], codes[1:]):
                counts[pair] += times
    a, b = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(counts[a, b])], ["a", "b", "times"])


def features(log_p: np.ndarray):
    """Numbers of a candidate's own look."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column("value").to_pylist():
                n, codes = len(value), [_letter(c) for c in value]
                pairs = [log_p[p] for p in zip(codes[:-1], codes[1:])]
                shares = [value.count(c) / n for c in set(value)]
                rows.append([
                    float(n), -sum([s * math.log2(s) for s in shares]), sum([c.isdigit() for c in value]) / n,
                    sum([c.isupper() for c in value]) / n, sum([c.islower() for c in value]) / n,
                    sum([c == 53 or c == 54 for c in codes]) / n, sum(pairs) / max(1, len(pairs)),
                ])
            yield pa.RecordBatch.from_arrays([batch.column("value"), pa.array(rows, pa.list_(pa.float64()))], ["value", "look"])
    return run


def common_words(texts: DataFrame) -> DataFrame:
    """word, times: the prose words of all texts."""
    words = texts.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).filter(F.length("word").between(2, 24))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("times")).filter(F.col("times") >= COMMON)


def with_coverage(values: DataFrame, words: DataFrame) -> DataFrame:
    """value, coverage: the share of its characters in letter runs that are words of the dictionary."""
    runs = values.select("value", F.explode(F.split(F.lower("value"), "[^a-z]+")).alias("word")).filter(F.length("word") >= 3)
    known = runs.join(words.select("word"), "word").groupBy("value").agg(F.sum(F.length("word")).alias("letters"))
    return values.join(known, "value", "left").select("value", (F.coalesce("letters", F.lit(0)) / F.length("value")).alias("coverage"))


def secret_scan(docs: DataFrame, own_labels: DataFrame | None = None) -> DataFrame:
    """doc_id, start, end, value, label, probability, secret of every candidate.

    ``own_labels`` (value, label) overrides the labels that formats give.
    """
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    joined = texts.mapInArrow(_with_doc(findings), "doc_id long, " + FOUND)
    found = materialise(joined, "secret-findings")
    if own_labels is not None:
        given = own_labels.groupBy("value").agg(F.max("label").cast("int").alias("own"))
        found = found.join(given, "value", "left").withColumn("label", F.coalesce("own", "label")).drop("own")
    words = materialise(common_words(texts), "secret-words")
    counts = np.ones((LETTERS, LETTERS)) * 0.5
    for a, b, times in words.mapInArrow(transitions, "a int, b int, times double").groupBy("a", "b").agg(F.sum("times")).collect():  # at most 64 x 64
        counts[a, b] += times
    log_p = np.log(counts / counts.sum(axis=1, keepdims=True))
    values = found.select("value").distinct()
    look = values.mapInArrow(features(log_p), "value string, look array<double>").join(with_coverage(values, words), "value")
    # Log odds of neighbouring words, by labelled findings of the other fold; a word of one finding says little.
    fold = F.pmod(F.xxhash64(F.lit("fold"), "value"), F.lit(2))
    near = found.filter("label is not null").select("label", (1 - fold).alias("fold"), F.explode("context").alias("word"))
    odds = near.groupBy("fold", "word").agg((F.log(F.sum("label") + 2) - F.log(F.sum(1 - F.col("label")) + 2)).alias("odds"))
    spread = found.select("row", "place", fold.alias("fold"), F.explode("context").alias("word"))
    context = spread.join(odds, ["fold", "word"]).groupBy("row", "place").agg(F.avg("odds").alias("odds"))
    full = found.join(look, "value").join(context, ["row", "place"], "left").select(
        "doc_id", "start", "end", "value", "label",
        F.concat("look", F.array("coverage", F.col("in_path").cast("double"), F.coalesce("odds", F.lit(0.0)))).alias("numbers"),
    )
    full = materialise(full, "secret-features")
    labelled = full.filter("label is not null").select("value", "label", "numbers")
    halves = [labelled.filter(F.col("label") == k).orderBy(F.xxhash64("value"), "value").limit(LABELLED // 2) for k in (0, 1)]
    training = materialise(halves[0].unionByName(halves[1]).select(F.col("label").cast("double"), array_to_vector("numbers").alias("features")), "secret-training")
    if training.select("label").distinct().count() < 2:
        return full.select("doc_id", "start", "end", "value", "label", F.col("label").cast("double").alias("probability"), F.coalesce(F.col("label") == 1, F.lit(False)).alias("secret"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxMemoryInMB=64).fit(training)
    judged = forest.transform(full.withColumn("features", array_to_vector("numbers")))
    probability = vector_to_array("probability")[1]
    return judged.select("doc_id", "start", "end", "value", "label", probability.alias("probability"), (probability >= 0.5).alias("secret"))


def _with_doc(scan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = dict(zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist()))
            for found in scan(iter([batch])):
                own = pa.array([docs[r] for r in found.column("row").to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([own, *found.columns], ["doc_id", *found.schema.names])
    return run
