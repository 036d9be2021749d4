"""Quality rules in a short-circuit cascade; DataFrame functions only.

Every document gets its counts. The base rules come first: too few words, or too many
words in repeated five-word windows. A document that passes them goes through
``rules()``, each a condition that rejects. The order of these comes from a random sample of
about ``SAMPLE_ROWS`` documents, drawn before anything is counted: each rule is timed on it and its
share of rejected rows counted, and rules with more rejection per second go first. Order never changes
a verdict, as a document is rejected if any rule rejects it; it decides how many rules most documents
have to pay for. ``failed_rule`` names the first rule that rejected, so it follows the measured order and
may differ between runs where several rules reject.

The counts leave through a generator: a filter on the result would else be pushed below them, and every use of a
count in it would repeat the arrays that it comes from.

Windows are compared by a 64-bit hash of their words within one text.

Defined cases: null text counts as empty, has no words and is rejected. Every row gets a
row, also when doc_id is null or repeats. Other columns are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from demandloom.llm.words import WORD_GAP

SAMPLE_ROWS = 1_000  # expected size of the sample that orders the rules, whatever the table's
WINDOW = 5
MIN_WORDS = 10


def rules() -> dict[str, Column]:
    """Name and condition that rejects, over ``text``, ``words`` and the counts."""
    n = F.col("n_words")
    letters = F.length(F.regexp_replace("text", r"[^\p{L}]+", ""))
    return {
        "symbols_per_word": F.col("n_symbols") > 0.25 * n,
        "repeated_lines": 2 * F.col("n_dup_lines") > F.size(F.split("text", "\n")),
        "word_length": (2 * F.col("word_chars") < 3 * n) | (F.col("word_chars") > 200 * n),
        "few_letters": letters < 0.5 * F.col("word_chars"),
        "few_distinct_words": F.size(F.array_distinct("words")) * 20 < n,
        "cut_lines": F.regexp_count("text", F.lit(r"(?:\.\.\.|…)[\x20\x09\x0D]*(?:\n|$)")) > 0.5 * F.size(F.split("text", "\n")),
    }


def with_counts(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, text, words and the five counts of each document, and the columns to carry."""
    at = lambda array, i: F.get(F.col(array), i)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *carry)
    split = texts.withColumns({
        "words": F.filter(F.split("text", WORD_GAP), lambda w: w != ""),
        "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    named = split.withColumn("names", F.transform("words", lambda w: F.xxhash64(w)))
    windows = named.withColumn("windows", F.transform(
        F.slice("names", F.lit(1), F.greatest(F.size("names") - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[at("names", i + k) for k in range(1, WINDOW)]),
    ))
    sorted_ = windows.withColumn("ordered", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("name"), i.alias("place")))),
    ))
    same = lambda x, i: F.coalesce(at("ordered", i)["name"] == x["name"], F.lit(False))
    twice = F.sort_array(F.transform(
        F.filter("ordered", lambda x, i: F.when(i > 0, same(x, F.greatest(i - 1, F.lit(0)))).otherwise(F.lit(False)) | same(x, i + 1)),
        lambda x: x["place"],
    ))
    placed = sorted_.withColumn("twice", twice)
    covered = F.aggregate(
        F.transform("twice", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(at("twice", i + 1) - x, F.lit(WINDOW)))),
        F.lit(0), lambda total, x: total + x,
    )
    row = F.struct(
        "doc_id", "text", *carry, "words", F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", WORD_GAP, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    return placed.select(F.inline(F.array(row)))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def ordered_rules(docs: DataFrame, conditions: Mapping[str, Column]) -> list[str]:
    """Rule names by rejected rows per second on a sample of about SAMPLE_ROWS documents."""
    share = min(1.0, SAMPLE_ROWS / max(docs.count(), 1))
    sample = with_counts(docs.sample(False, share, 1)).filter(~base_failed()).persist()
    sample.count()
    worth = {}
    for name, condition in conditions.items():
        began = time.perf_counter()
        rejected = sample.agg(F.count_if(condition)).first()[0]
        worth[name] = (rejected + 0.5) / (time.perf_counter() - began)
    sample.unpersist()
    return sorted(conditions, key=lambda name: -worth[name])


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts and verdict of each document; ``failed_rule`` is the first rule that rejected it."""
    counted, conditions = with_counts(docs), rules()
    first = F.when(base_failed(), "base")
    for name in ordered_rules(docs, conditions):
        first = first.when(conditions[name], name)
    return counted.withColumn("failed_rule", first).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), F.col("failed_rule").isNull().alias("kept"), "failed_rule",
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that no rule rejects, with their columns."""
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id"), F.col("text"))
    conditions = rules()
    kept = ~base_failed()
    for name in ordered_rules(docs, conditions):
        kept = F.when(kept, ~conditions[name]).otherwise(False)
    return with_counts(own, carry=["row"]).filter(kept).select("row.*")
