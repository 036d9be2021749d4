"""Importance resampling and its radix sort, against brute force."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from demandloom.llm import radix, resampling


@pytest.mark.parametrize("low, high", [(0, 5), (-3000, 3000), (-(1 << 63), (1 << 63) - 1)])
def test_places_follow_the_composite_key(spark, monkeypatch, low, high):
    monkeypatch.setattr(radix, "BLOCK_BITS", 3)  # many blocks on few rows
    rng = random.Random(high)
    rows = [(rng.choice([7, 7, 7, rng.randint(-9, 2000)]), rng.randint(low, high)) for _ in range(300)]
    rows += [(7, low), (7, high)]
    got = radix.radix_places(spark.createDataFrame(rows, "a long, b long").repartition(5), ["a", "b"]).collect()
    assert [(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["place"])] == sorted(rows)
    assert sorted(r["place"] for r in got) == list(range(len(rows)))


@pytest.mark.parametrize("count", [0, 1, 20])
def test_places_of_equal_keys_are_gapless(spark, count):
    got = radix.radix_places(spark.createDataFrame([(4,)] * count, "a long"), ["a"])
    assert sorted(r["place"] for r in got.collect()) == list(range(count))


def brute(documents, target, longest=1, least=20, percent=10, seed=2024):
    def runs(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        return words, [crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    own = {}
    for i, text in documents:
        if i is not None and (i not in own or (text or "") < own[i]):
            own[i] = text or ""
    found = {i: runs(text) for i, text in own.items()}
    s, t = Counter(b for _, f in found.values() for b in f), Counter(b for text in target for b in runs(text)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + 10000) / ((s[b] + 1) * (sum(t.values()) + 10000))))
    rows = {}
    for i, (words, features) in found.items():
        h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, features))
        rows[i] = (len(words), len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 4294967296))))
    order = sorted((i for i in rows if rows[i][0] >= least), key=lambda i: (-rows[i][3], i))
    rank = {i: n + 1 for n, i in enumerate(order[: percent * len(order) // 100])}
    return sorted((i, *rows[i][1:], rank.get(i)) for i in rows)


def outcome(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


@pytest.mark.parametrize("longest", [1, 2])
def test_equals_brute_force(spark, longest):
    rng = random.Random(longest)
    vocabulary = ["alpha", "Beta", "straße", "x9", "ÉTÉ", "语言", "the", "the", "of"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "_", " "]) for _ in range(n))
    documents = [(i, text(rng.choice([0, 5, 19, 20, 21, 60]))) for i in range(-20, 120)]
    documents += [(200, None), (201, ""), (None, text(30)), (202, "A b" * 30000), (203, documents[40][1]), (204, documents[40][1])]
    documents += [(205, text(40)), (205, text(40)), documents[50]]  # repeated keys
    target = [text(30), None, "", "alpha alpha x9"]
    docs = spark.createDataFrame([(i, t, 0.5, "s") for i, t in documents], "doc_id long, text string, score double, `a.b` string")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    assert outcome(resampling.resample(docs, goal, longest=longest, percent=25)) == sorted(
        brute(documents, target, longest, percent=25), key=lambda r: r[0])


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a " * 25), (2, "b " * 25)], "doc_id long, text string")
    assert resampling.resample(none, some).count() == 0
    assert outcome(resampling.resample(some, none, percent=50)) == brute([(1, "a " * 25), (2, "b " * 25)], [], percent=50)


def test_drawn_documents_keep_their_columns(spark):
    rows = [(i, f"word{i % 3} " * 30, f"s{i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, `a.b` string")
    goal = spark.createDataFrame([("word1 " * 50,)], "text string")
    drawn = resampling.sample_documents(docs, goal, percent=30).collect()
    ranked = {r["doc_id"] for r in resampling.resample(docs, goal, percent=30).filter(F.col("rank").isNotNull()).collect()}
    assert {r["doc_id"] for r in drawn} == ranked and len(drawn) == 6 and set(drawn[0].asDict()) == {"doc_id", "text", "a.b"}
    assert sum(r["doc_id"] % 3 == 1 for r in drawn) >= 4  # the target's word is preferred
