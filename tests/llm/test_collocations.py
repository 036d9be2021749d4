"""Collocations against direct counting; the graph's flows and paths."""

import random
import re
from collections import Counter

import pytest

from demandloom.llm import collocations as co


def pieces(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def counted(rows):
    f, n = {}, Counter()
    for text, lang in rows:
        own = f.setdefault(lang or "und" if lang is None else lang, Counter())
        for w in pieces(text):
            n["und" if lang is None else lang] += len(w)
            for k in (1, 2, 3, 4):
                own.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, least, top):
    f, n = counted(rows)
    result = []
    for lang, own in f.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        scored = []
        for p, a in candidates.items():
            if any(inside(p, q) and 100 * b >= 80 * a for q, b in candidates.items()):
                continue
            cuts = [(2000000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -s))
    return sorted(result)


def outcome(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def documents(seed=0):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "a", "New", "york", "été", "|", "x-1", " y", "语言"]
    fixed = ["once upon a time there was a very small dragon", "terms of service apply", "New York City"]
    rows = []
    for i in range(120):
        parts = [rng.choice([*fixed, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 9)))]) for _ in range(rng.randint(0, 8))]
        rows.append((rng.choice([". ", ",", "\n", "\t", "; ", " "]).join(parts), rng.choice(["en", "en", "en", "fr", None, ""])))
    rows += [(None, "en"), ("", None), ("a a a a a a a a " * 2000, "fr"), rows[3], rows[3]]
    return rows


SCHEMA = "doc_id long, text string, lang string, name int, `a.b` string, f int"


def frame(spark, rows):
    return spark.createDataFrame([(i if i % 7 else None, t, l, i, "x", 1) for i, (t, l) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("least, top, chunk", [(5, 2000, 1 << 20), (3, 4, 200), (300, 50, 1 << 20)])
def test_equals_brute_force(spark, monkeypatch, least, top, chunk):
    rows = documents(least)
    monkeypatch.setattr(co, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(co, "HELD", 64 if chunk == 200 else 1 << 20)
    assert outcome(co.collocations(frame(spark, rows).repartition(3), least=least, top=top)) == brute(rows, least, top)


def test_flows_are_the_counts_of_every_level(spark):
    rows = documents(9)
    graph = co.Graph(frame(spark, rows), least=4)
    expected = {(lang, " ".join(p)): a for lang, own in counted(rows)[0].items() for p, a in own.items() if len(p) > 1 and a >= 4}
    assert {(r["lang"], r["phrase"]): r["f"] for r in co.with_phrases(graph.texts, graph.phrases, graph.plan).collect()} == expected


def test_unary_paths_become_whole_passages(spark):
    rows = [("z%d once upon a time there was a dragon z%d" % (i, i), "en") for i in range(12)] + [("one two three four five", "en")] * 6 + [("six two three four ten", "en")] * 6
    graph = co.Graph(frame(spark, rows), least=5)
    found = {(r["phrase"], r["words"], r["f"]) for r in co.passages(graph).collect()}
    # "two three four" is entered and left by two edges each, so nothing is merged there.
    assert found == {("once upon a time there was a dragon", 8, 12), ("one two three four", 4, 6), ("two three four five", 4, 6), ("six two three four", 4, 6), ("two three four ten", 4, 6)}


def test_nothing_frequent_and_nothing_at_all(spark):
    assert co.collocations(frame(spark, [("a b", "en")])).count() == 0
    assert co.collocations(frame(spark, [(None, None)])).count() == 0
    assert co.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_runs_go_on_in_the_next_batch(spark):
    """Flows of batches of a few rows: runs of a node or an edge span many of them."""
    rows = documents(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = outcome(co.collocations(frame(spark, rows[:40]), least=3))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(rows[:40], 3, 2000)


def test_one_long_text(spark):
    rows = [("lorem ipsum dolor sit " * 60000 + "amet", "en")]
    assert outcome(co.collocations(frame(spark, rows))) == brute(rows, 30, 2000)


def test_placement_and_full_tables_do_not_change_rows(spark, monkeypatch):
    """All pairs hot or none, few words with codes, and a table of names with nearly all bits set."""
    rows = documents(4)
    expected = brute(rows, 6, 2000)
    for share, codes in ((1, 3), (10**9, 65534)):
        monkeypatch.setattr(co, "CODES", codes)
        monkeypatch.setattr(co, "HOT_SHARE", share)
        monkeypatch.setattr(co, "NAME_BITS", 4)
        assert outcome(co.collocations(frame(spark, rows), least=6)) == expected
