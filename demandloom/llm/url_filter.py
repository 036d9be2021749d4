"""URL verdicts from rules, and from the words in host and path where no rule fits.

Rules: (host, path) fits its host and all subdomains, if the URL's path starts with the
rule's. The longest fitting rule decides.

Method: the parts of a host (without its last label) and of a path are runs of letters. Every
distinct part is segmented once by Viterbi over a unigram model, whose counts are those of
all words in all pages. Candidate words reach a part by a join of its substrings with the
counts, so the vocabulary is never broadcast. Multinomial naive Bayes then scores the words.
It learns from the pages themselves: those with a word of ``SEEDS`` are examples to block, all
others examples to allow, and a page is blocked if block has the higher posterior. So words
that keep company with seeds block too.

Defined cases: null URLs and URLs without ``://`` have empty host and path, no words, and
get the prior's verdict. Every row gets a row, also when page_id is null or repeats. Words of more than
``LONGEST`` letters are not in the model; letters that no word covers stay together as one
word. Ties of segmentations go to the longer last word, a posterior of one half to allow.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from demandloom.sources.storage import materialise

#: Fixed rules of the registered query: verdict, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
SEEDS = ["adult", "ads", "bets", "casino", "gambling", "pills", "poker", "porn", "spam", "viagra", "xxx"]
LONGEST = 24


def addressed(pages: DataFrame) -> DataFrame:
    """Adds host and path."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    cut = pages.withColumn("rest", rest)
    return cut.withColumns({
        "host": F.translate(F.regexp_extract("rest", r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        "path": F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1),
    }).drop("rest")


def ruled(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule as host and path, and its verdict; null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def parts_of(host: Column, path: Column) -> Column:
    """Runs of letters of the host without its last label, and of the path, in lower case."""
    names = F.regexp_replace(host, r"\.?[^.]*$", "")
    return F.filter(F.split(F.lower(F.concat_ws(" ", names, path)), r"[^\p{L}]+"), lambda p: p != "")


def word_counts(pages: DataFrame) -> DataFrame:
    """word, times over the text of all pages."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<(script|style)\b.*?</\1>|<!--.*?-->", " "), r"<[^>]*>", " ")
    words = F.split(F.lower(text), r"[^\p{L}]+")
    return (
        pages.select(F.explode(words).alias("word")).filter(F.length("word").between(1, LONGEST))
        .groupBy("word").agg(F.count(F.lit(1)).alias("times"))
    )


def best_split(part: str, words: dict[tuple[int, int], float], unknown: float) -> list[str]:
    """Most probable segmentation; ``words`` gives log probabilities of (start, length).

    A letter that no word covers costs ``unknown``; neighbouring ones form one word.
    """
    cost, step = [0.0] + [-math.inf] * len(part), [0] * (len(part) + 1)
    by_end: dict[int, list[tuple[int, float]]] = {}
    for (start, length), value in words.items():
        by_end.setdefault(start + length, []).append((length, value))
    for end in range(1, len(part) + 1):
        for length, value in [(1, unknown), *sorted(by_end.get(end, []))]:
            if cost[end - length] + value >= cost[end]:
                cost[end], step[end] = cost[end - length] + value, length if value > unknown else -1
    found, end = [], len(part)
    while end:
        if step[end] > 0:
            found.append(part[end - step[end] : end])
            end -= step[end]
        else:
            stop = end
            while end and step[end] < 0:
                end -= 1
            found.append(part[end:stop])
    return found[::-1]


def split_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        split = []
        for row in batch.to_pylist():
            words = {(w["start"], w["length"]): math.log(w["times"] / row["all_times"]) for w in row["found"] or []}
            split.append(best_split(row["part"], words, math.log(0.01 / max(row["all_times"] or 1, 1))))
        yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(split, pa.list_(pa.string()))], ["part", "words"])


def segmented(parts: DataFrame, counts: DataFrame) -> DataFrame:
    """part, words: the segmentation of every distinct part."""
    starts = parts.select("part", F.explode(F.sequence(F.lit(1), F.length("part"))).alias("start"))
    longest = F.least(F.lit(LONGEST), F.length("part") - F.col("start") + 1)
    pieces = starts.select("part", "start", F.explode(F.sequence(F.lit(1), longest)).alias("length"))
    pieces = pieces.withColumn("word", F.expr("substring(part, start, length)"))
    found = pieces.join(counts, "word").groupBy("part").agg(
        F.collect_list(F.struct((F.col("start") - 1).alias("start"), "length", "times")).alias("found")
    )
    total = counts.agg(F.sum("times").alias("all_times"))
    return parts.join(found, "part", "left").crossJoin(F.broadcast(total)).mapInArrow(split_parts, "part string, words array<string>")


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, seeds: Sequence[str] = SEEDS) -> DataFrame:
    """page_id, host, path, rule, verdict of every page, and the method's log odds of block."""
    rule, verdict = ruled(rules)
    urls = addressed(pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url")))
    rows = materialise(urls.select(
        F.monotonically_increasing_id().alias("row"), "page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"),
        parts_of(F.col("host"), F.col("path")).alias("parts"),
    ), "url-parts")
    own_parts = rows.select("row", F.explode("parts").alias("part"))
    split = materialise(segmented(own_parts.select("part").distinct(), materialise(word_counts(pages), "url-words")), "url-split")
    words = materialise(
        own_parts.join(split, "part").groupBy("row").agg(F.flatten(F.collect_list("words")).alias("words")), "url-row-words"
    )
    marked = rows.select("row").join(words, "row", "left").select("row", F.coalesce("words", F.array().cast("array<string>")).alias("words"))
    marked = marked.withColumn("seeded", F.arrays_overlap("words", F.array(*[F.lit(s) for s in seeds])).cast("int"))
    priors = marked.agg(F.sum("seeded").alias("block"), F.count(F.lit(1)).alias("all")).select(
        (F.log(F.col("block") + 1) - F.log(F.col("all") - F.col("block") + 1)).alias("prior")
    )
    times = materialise(
        marked.select("seeded", F.explode("words").alias("word")).groupBy("word")
        .agg(F.sum("seeded").alias("block"), F.sum(1 - F.col("seeded")).alias("allow")), "url-weights",
    )
    sums = times.agg(F.sum("block").alias("blocks"), F.sum("allow").alias("allows"), F.count(F.lit(1)).alias("kinds"))
    weights = times.crossJoin(F.broadcast(sums)).select("word", (
        F.log((F.col("block") + 1) / (F.col("blocks") + F.col("kinds"))) - F.log((F.col("allow") + 1) / (F.col("allows") + F.col("kinds")))
    ).alias("weight"))
    scores = words.select("row", F.explode("words").alias("word")).join(weights, "word").groupBy("row").agg(F.sum("weight").alias("score"))
    odds = F.coalesce("score", F.lit(0.0)) + F.col("prior")
    return rows.join(scores, "row", "left").crossJoin(F.broadcast(priors)).select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", F.when(odds > 0, "block").otherwise("allow")).alias("verdict"), odds.alias("log_odds")
    )
