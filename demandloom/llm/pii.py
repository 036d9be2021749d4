"""Personal data by fixed formats, widened by contexts that a bootstrap finds; DataFrame functions only.

Base: per kind the leftmost non-overlapping matches of a format, less those that a check
drops. Positions come without markers in the text: a split by the format gives the parts
between matches, and lengths of parts and matches add up to code point offsets.

Bootstrap: base spans are seeds. A *pattern* is the pair of words before an identifier and
the word after it, as far as they lie within ``CONTEXT`` characters of it (a longer word
counts by its part there); an *instance* is an identifier-like token (it holds a digit) or a base
span, by its text. The graph of patterns and instances is scored in rounds: a pattern of a
kind is worth the share of its instances' belief in that kind, an instance is believed by
the noisy-or of its patterns. Patterns under ``MIN_SEEDS`` distinct believed instances or
``MIN_PATTERN`` worth say nothing. Tokens outside base spans whose belief reaches
``MIN_BELIEF`` through at least two patterns become spans too.

Every count covers all documents. Pattern and instance sums combine before their shuffles,
so a frequent context or identifier costs one row per task; the joins have one row per key
on one side, and Spark splits hot keys of the other.

Defined cases: null text counts as empty. Every row gets a row, also when doc_id is null or
repeats. Where spans of two kinds overlap, the mask is the kind of the one that starts
first. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from demandloom.llm.words import WORD_GAP
from demandloom.sources.storage import freeze, materialise

KINDS = ["email", "ip", "card", "phone"]
#: Characters on each side of a token that its pattern is read from.
CONTEXT = 80
#: Fixed formats. Possessive forms of the stated ones: what follows each repeat can't be part
#: of it, so giving back never helps. The look-behind starts a match where a run of its
#: first class starts or the last match ended, where the leftmost match must start.
LOCAL = "A-Za-z0-9._%+-"
FORMATS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": r"@", "ip": r"\.", "card": r"[0-9]", "phone": r"\+"}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
IDENTIFIER = r"(?<![A-Za-z0-9@._+-])(?=[A-Za-z0-9@._+-]{5})[A-Za-z@._+-]*+[0-9][A-Za-z0-9@._+-]*+"
MIN_IDENTIFIER = 5
#: Every match of a format and every identifier holds one of these.
ANY = "[0-9@]"

ROUNDS = 3
MIN_SEEDS = 5
MIN_PATTERN = 0.6
MIN_BELIEF = 0.9


def _passes(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]+", "")
    return {
        "email": F.lit(True),
        "ip": match.rlike(rf"^(?:{OCTET}\.){{3}}{OCTET}$"),
        "card": F.length(digits).between(13, 19) & F.call_function("luhn_check", digits),
        "phone": F.length(digits).between(9, 15),
    }[kind]


def _is(kind: str):
    return lambda span: span["kind"] == kind


def _last_words(part: Column, count: int) -> Column:
    words = F.filter(F.split(F.lower(F.right(part, F.lit(CONTEXT))), WORD_GAP), lambda w: w != "")
    return F.concat_ws(" ", F.slice(words, F.greatest(F.size(words) - (count - 1), F.lit(1)), F.lit(count)))


def _first_word(part: Column) -> Column:
    return F.regexp_extract(F.lower(F.left(part, F.lit(CONTEXT))), r"^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+)", 1)


def matches(docs: DataFrame) -> DataFrame:
    """row, doc_id, text_hash, found: every match of every format with the length of the gap before it."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = texts
    for kind, pattern in (FORMATS | {"token": IDENTIFIER}).items():
        all_of = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        found = found.withColumn(f"{kind}_m", F.when(F.col("text").rlike(NEEDS.get(kind, "[0-9]")), all_of))
        found = found.withColumn(f"{kind}_p", F.when(F.size(f"{kind}_m") > 0, F.split("text", pattern, -1)))
    listed = []
    for kind in [*FORMATS, "token"]:
        part = lambda i, kind=kind: F.get(F.col(f"{kind}_p"), i)
        listed.append(F.coalesce(F.transform(f"{kind}_m", _described(kind, part)), F.expr(f"cast(array() as array<struct<{MATCH}>>)")))
    return found.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"), F.concat(*listed).alias("found"),
    )


MATCH = "kind: string, place: int, gap: int, match: string, context: string"


def _described(kind: str, part):
    return lambda match, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("place"), F.length(part(i)).alias("gap"), match.alias("match"),
        F.concat_ws("|", _last_words(part(i), 2), _first_word(part(i + 1))).alias("context"),
    )


def spans_of(found: DataFrame) -> DataFrame:
    """row, kind, start, end, match, context of base spans, and of tokens that none of them touches."""
    upto = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("match")
    placed = found.select("row", F.inline("found")).withColumn("end", F.sum(F.col("gap") + size).over(upto)).withColumn("start", F.col("end") - size)
    passed = F.lit(False)
    for kind in KINDS:
        passed = F.when(F.col("kind") == kind, _passes(kind, F.col("match"))).otherwise(passed)
    passed = F.when(F.col("kind") == "token", size >= MIN_IDENTIFIER).otherwise(passed)
    base = F.col("kind") != "token"
    before = Window.partitionBy("row").orderBy("start", F.col("end").desc()).rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("row").orderBy("start", F.col("end").desc()).rowsBetween(0, Window.unboundedFollowing)
    clear = (F.coalesce(F.max(F.when(base, F.col("end"))).over(before), F.lit(0)) <= F.col("start")) & (
        F.coalesce(F.min(F.when(base, F.col("start"))).over(after), F.col("end")) >= F.col("end")
    )
    return placed.filter(passed).withColumn("free", clear).filter(base | F.col("free")).select(
        "row", "kind", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), "match", "context",
    )


def believed(spans: DataFrame) -> DataFrame:
    """instance, kind: tokens that enough trusted patterns point to."""
    edges = materialise(
        spans.select("context", F.col("match").alias("instance"), "kind").groupBy("context", "instance", "kind").agg(F.count(F.lit(1)).alias("times")),
        "pii-edges",
    )
    tokens = edges.filter("kind = 'token'").select("context", "instance")
    sizes = edges.groupBy("context").agg(F.count(F.lit(1)).alias("instances"))
    # A seed believes in its kind fully and for good.
    seeds = edges.filter("kind != 'token'").groupBy("context", "kind").agg(F.count(F.lit(1)).cast("double").alias("seeds"))
    new = None
    for _ in range(ROUNDS):
        support = seeds if new is None else (
            seeds.withColumnRenamed("seeds", "weight").unionByName(
                tokens.join(new, "instance").groupBy("context", "kind").agg(F.sum("belief").alias("weight"))
            ).groupBy("context", "kind").agg(F.sum("weight").alias("seeds"))
        )
        patterns = support.filter(F.col("seeds") >= MIN_SEEDS).join(sizes, "context").select(
            "context", "kind", (F.col("seeds") / F.col("instances")).alias("worth")
        ).filter(F.col("worth") >= MIN_PATTERN)
        doubt = F.sum(F.log(F.greatest(1 - F.col("worth"), F.lit(1e-6))))
        new = freeze(
            tokens.join(patterns, "context").groupBy("instance", "kind")
            .agg((1 - F.exp(doubt)).alias("belief"), F.count(F.lit(1)).alias("patterns"))
        )
    return new.filter((F.col("belief") >= MIN_BELIEF) & (F.col("patterns") >= 2)).groupBy("instance").agg(
        F.max_by("kind", F.struct("belief", "kind")).alias("kind")
    )


def personal_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and spans (kind, start, end, added; by kind as listed and start) of every document."""
    found = materialise(matches(docs), "pii-matches")
    spans = materialise(spans_of(found), "pii-spans")
    added = spans.filter("kind = 'token'").drop("kind").join(believed(spans), F.col("match") == F.col("instance"))
    columns = ["row", "kind", "start", "end"]
    both = spans.filter("kind != 'token'").select(*columns, F.lit(False).alias("added")).unionByName(added.select(*columns, F.lit(True).alias("added")))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    listed = both.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(order.alias("order"), "start", "end", "kind", "added"))).alias("spans"))
    return found.select("row", "doc_id", "text_hash").join(listed, "row", "left").drop("row")


def _listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.coalesce(F.concat_ws(",", F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )), F.lit(""))


def pii_digest(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of each document."""
    found = personal_spans(docs).withColumn("base", F.filter("spans", lambda s: ~s["added"]))
    counts = [F.coalesce(F.size(F.filter("base", _is(k))), F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def mask_personal(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; same columns and rows.

    Only texts that hold a digit or an at sign meet their spans; no other can have one. Each goes once.
    """
    by_start = F.sort_array(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    marks = materialise(
        personal_spans(docs).filter("spans is not null").groupBy(F.col("doc_id").alias("_pii_doc"), F.col("text_hash").alias("_pii_hash"))
        .agg(F.first(by_start).alias("_pii_spans")), "pii-marks",
    )
    text = F.col("text")
    nothing = F.expr("named_struct('at', 0, 'parts', cast(array() as array<string>))")

    def step(done: Column, s: Column) -> Column:
        inside = s["start"] < done["at"]  # overlaps the span before, as a card within a phone number
        parts = F.when(inside, done["parts"]).otherwise(F.concat(done["parts"], F.array(
            F.substring(text, done["at"] + 1, s["start"] - done["at"]), F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")),
        )))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), parts.alias("parts"))

    masked = F.aggregate("_pii_spans", nothing, step, lambda done: F.concat(
        F.array_join(done["parts"], ""), F.substring(text, done["at"] + 1, F.length(text))
    ))
    touched = F.col("_pii_spans").isNotNull() & text.isNotNull()
    same = F.col("doc_id").eqNullSafe(F.col("_pii_doc")) & (F.xxhash64("text") == F.col("_pii_hash"))
    possible = F.coalesce(text.rlike(ANY), F.lit(False))
    # The row goes along as a struct, so its other columns may have any names.
    own = docs.filter(possible).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("_pii_row"), "doc_id", "text")
    joined = own.join(marks, same, "left").withColumn("_pii_text", F.when(touched, masked).otherwise(text))
    now = {"text": F.col("_pii_text")}
    if "n_chars" in docs.columns:
        before = F.col("_pii_row").getField("n_chars")
        now["n_chars"] = F.when(touched, F.length("_pii_text")).otherwise(before).cast(docs.schema["n_chars"].dataType)
    changed = joined.select(*[now[c].alias(c) if c in now else F.col("_pii_row").getField(c).alias(c) for c in docs.columns])
    return changed.union(docs.filter(~possible))
