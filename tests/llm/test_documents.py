"""Operators over documents against brute force, on the smallest table and on odd rows."""

import hashlib
import re
import time
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.llm import byte_tokens, packing, queries, token_counts
from demandloom.llm.components import components
from demandloom.llm.jaccard import drop_near_copies, jaccard_join, least_matches
from demandloom.llm.pii import mask_personal, pii_digest
from demandloom.llm.quality_rules import keep_good, ordered_rules, quality_rules, rules, with_counts
from demandloom.llm.substring import drop_repeats, substring_dedup
from tests.conftest import FOLDER

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def by_id(frame):
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


# --- repeated passages -------------------------------------------------------------------------

def repeats(texts):
    seen, out = set(), {}
    for doc, text in sorted(texts.items()):
        own = words(text)
        gone = [False] * len(own)
        for i in range(len(own) - 19):
            window = tuple(own[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        kept = [w for w, g in zip(own, gone) if not g]
        out[doc] = (len(own), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def test_repeats_match_brute_force(spark, texts):
    assert by_id(queries.op1_substring_dedup(spark, FOLDER)) == repeats(texts)


def test_repeats_in_runs_and_periods(spark):
    rng = np.random.default_rng(1)
    rows = {k: " ".join(rng.choice(["a", "b"], 60, p=[0.9, 0.1])) for k in range(40)}
    rows |= {100: "a " * 50, 101: "a " * 19, 102: "x y " * 40, 103: "y x " * 40}
    got = by_id(substring_dedup(spark.createDataFrame(list(rows.items()), "doc_id long, text string")))
    assert got == repeats(rows)


def test_repeats_of_odd_rows(odd):
    got = by_id(substring_dedup(odd))
    assert got == repeats({1: "", 2: "", 4: "xy " * 30_000, 5: "mail z@b.cd now", 6: "mail z@b.cd now", 7: ""})
    cut = drop_repeats(odd)
    assert cut.columns == odd.columns and cut.count() == odd.count()
    assert cut.filter("doc_id = 4").first()["text"] == "xy "  # the second window already repeats the first
    assert substring_dedup(odd.limit(0)).count() == drop_repeats(odd.limit(0)).count() == 0


def test_cut_texts_hold_the_kept_words(spark):
    rng = np.random.default_rng(2)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = {k: " ".join(rng.choice([*"abcdefgh"], 40)) + (f" {passage}\nend {k}" if k % 3 else "") for k in range(30)}
    rows = [(k, t, k, "m") for k, t in texts.items()] + [(7, texts[7] + " zz", 1, "m"), (None, passage, 2, "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, singles int, `a.b` string")
    cut = drop_repeats(docs)
    assert cut.schema.names == docs.schema.names
    found = cut.collect()
    assert sorted((r["doc_id"] or 0, r["singles"], r["a.b"]) for r in found) == sorted((r[0] or 0, r[2], r[3]) for r in rows)
    expected = repeats(texts)
    for row in found:  # both rows of document 7 get the text of the smaller one
        if row["doc_id"] is None:
            assert row["text"] == passage
        else:
            assert hashlib.sha256(" ".join(words(row["text"])).encode()).hexdigest() == expected[row["doc_id"]][2]


# --- near copies -------------------------------------------------------------------------------

def classes(texts):
    sets, holders, common = {}, defaultdict(list), Counter()
    for doc, text in texts.items():
        own = words(text)
        k = min(5, len(own))
        sets[doc] = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if k else set()
        for shingle in sets[doc]:
            holders[shingle].append(doc)
    for own in holders.values():
        for i, a in enumerate(own):
            common.update((a, b) for b in own[i + 1 :])
    parent, links = {d: d for d in sets}, Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n):
            links.update((a, b))
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {d: (root(d), links[d]) for d in sets}


def test_join_matches_brute_force(spark, texts):
    assert by_id(queries.op9_jaccard_join(spark, FOLDER)) == classes(texts)


def test_join_over_several_blocks(spark):
    rows = {100 + i: " ".join(f"w{j if j != 3 * (i % 30) else 1000 + i}" for j in range(300)) for i in range(600)}
    rows |= {1: "a b", 2: " a  b\n", 3: "a b c", 4: "x " * 1000, 5: "x " * 5, 6: None, 7: ""}
    frame = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    assert by_id(jaccard_join(frame)) == classes(rows)


def test_join_of_odd_rows(odd):
    assert by_id(jaccard_join(odd)) == {1: (1, 0), 2: (2, 0), 4: (4, 0), 5: (5, 1), 6: (5, 1), 7: (7, 0)}
    kept = drop_near_copies(odd)
    assert kept.columns == odd.columns
    assert sorted((r[0] or 0) for r in kept.collect()) == [0, 1, 2, 4, 5, 5, 7]
    assert jaccard_join(odd.limit(0)).count() == 0


def test_components_with_hubs_and_paths(spark):
    rng = np.random.default_rng(9)
    pairs = [(900_000, k) for k in range(3000)] + [(k, k + 1) for k in range(500_000, 500_150)] + [(7, 7), (None, 4), (950_000, 950_001)]
    pairs += [(int(a) + 100_000, int(b) + 100_000) for a, b in rng.integers(0, 400, (250, 2))]
    pairs = [pairs[k] for k in rng.permutation(len(pairs))]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if None not in (a, b) and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = components(spark.createDataFrame(pairs, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == sorted((x, find(x)) for x in parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pruning_bound_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(2)
    matches = rng.binomial(112, 0.8, 200_000)
    assert (matches < least_matches(112)).mean() < 1e-4
    assert least_matches(112) > 0.5 * 112


# --- quality -----------------------------------------------------------------------------------

def quality(text):
    own = words(text)
    windows = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
    covered = {j for i in range(len(own) - 4) if windows[tuple(own[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(own) < 10 or 100 * len(covered) > 20 * len(own)
    return (len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed)


def test_counts_match_brute_force(spark, texts):
    got = by_id(queries.op10_quality_rules(spark, FOLDER))
    assert {d: v[:6] for d, v in got.items()} == {d: quality(t) for d, t in texts.items()}
    assert not any(v[5] and v[6] for v in got.values())


def test_order_of_rules_never_changes_verdicts(documents, texts):
    counted = with_counts(documents)
    assert sorted(ordered_rules(documents, rules())) == sorted(rules())
    alone = {r[0]: any(r[1:]) for r in counted.select("doc_id", *rules().values()).collect()}
    for doc, verdict in by_id(quality_rules(documents).select("doc_id", "base_failed", "kept")).items():
        assert verdict[1] == (not verdict[0] and not alone[doc])


def test_quality_of_odd_rows(odd):
    got = quality_rules(odd).select("doc_id", "n_words", "kept").collect()
    assert len(got) == odd.count() and not any(r["kept"] for r in got if r["doc_id"] is not None)
    assert keep_good(odd).columns == odd.columns and quality_rules(odd.limit(0)).count() == 0


@pytest.mark.parametrize("column", ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rule"])
def test_filters_on_the_verdict_stay_cheap(spark, column):
    """A filter pushed below the counts would build their arrays anew for every element."""
    text = " ".join(f"w{i % 7000}" for i in range(20_000))
    rows = quality_rules(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    began = time.perf_counter()
    assert rows.filter(F.col(column).isNotNull() | F.col(column).isNull()).filter(F.length(F.col(column).cast("string")) < 99).count() == 1
    assert time.perf_counter() - began < 30


def test_good_documents_stay_whole(documents):
    kept = {r[0] for r in quality_rules(documents).filter("kept").select("doc_id").collect()}
    rows = {tuple(r) for r in documents.collect() if r[0] in kept}
    assert {tuple(r) for r in keep_good(documents).collect()} == rows


# --- personal data -----------------------------------------------------------------------------

FORMATS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in FORMATS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {
                "email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if fits:
                out.append((kind, m.start(), m.end()))
    count = Counter(k for k, _, _ in out)
    listed = ",".join(f"{k}:{a}:{b}" for k, a, b in out)
    return tuple(count[k] for k in FORMATS) + (hashlib.sha256(listed.encode()).hexdigest(),), listed


def test_spans_match_brute_force(spark, texts):
    for doc, row in by_id(queries.op5_pii(spark, FOLDER)).items():
        expected, listed = base_spans(texts[doc])
        assert row[:5] == expected
        assert set(filter(None, listed.split(","))) <= set(row[5].split(","))


def test_spans_of_hard_texts(spark):
    rng = np.random.default_rng(3)
    bits = ["a@b.c", "x@y", "@", ".", "1.2.3.4", "999.1.1.1", "0001.2.3.4", " ", "-", "é", "😀", "+1 ", "(555)", "4111 1111 1111 1111",
            "4111111111111111", "0", "12", "%", "_", "a.b@c.d@e.f.g", "\n", "+", "1.2.3.4.5.6.7.8"]
    rows = {k: "".join(rng.choice(bits, rng.integers(0, 25))) for k in range(1500)}
    rows |= {9001: None, 9002: "", 9003: "1.1.1.1 " * 2000, 9004: "a" * 100_000, 9005: "a@b" + ".c" * 20_000, 9006: "1 " * 30_000}
    got = by_id(pii_digest(spark.createDataFrame(list(rows.items()), "doc_id long, text string")))
    assert {d: v[:5] for d, v in got.items()} == {d: base_spans(t)[0] for d, t in rows.items()}


def test_contexts_find_unseen_identifiers(spark):
    seeds = [(k, f"please write to user{k}@host.org today or call, my mail is user{k}.x@host.org , thanks") for k in range(8)]
    unseen = [(100, "please write to user99(at)host today"), (101, "please write to user77-host today or my mail is user77-host , thanks")]
    rows = by_id(pii_digest(spark.createDataFrame(seeds + unseen, "doc_id long, text string")))
    assert rows[101][5].count("email:") == 2 and rows[101][0] == 0


def test_masks_of_odd_rows(odd):
    masked = mask_personal(odd)
    assert masked.columns == odd.columns and masked.count() == odd.count()
    assert {r["text"] for r in masked.filter("doc_id in (5, 6)").collect()} == {"mail <EMAIL> now"}
    assert pii_digest(odd).count() == odd.count() and pii_digest(odd.limit(0)).count() == 0


def test_only_texts_that_may_hold_a_span_meet_their_spans(spark, capsys):
    """Texts without digits and at signs pass by the join, and no text goes to it twice."""
    rows = [(1, "mail z@b.cd now", "x", 15), (2, "none here", "y", 9), (3, None, "z", None), (3, None, "z", None), (4, "call 4111 1111 1111 1111 now", "x", 28), (2, "none here", "y", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, n_chars int")
    masked = mask_personal(docs)
    expected = [(1, "mail <EMAIL> now", "x", 16), rows[1], rows[2], rows[3], (4, "call <CARD> now", "x", 15), rows[5]]
    assert masked.schema.names == docs.schema.names
    assert sorted(map(str, map(tuple, masked.collect()))) == sorted(map(str, expected))
    capsys.readouterr()
    masked.explain(True)
    optimised = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "Union" in optimised
    packed = [line.split(" AS _pii_row")[0] for line in optimised.splitlines() if " AS _pii_row" in line]
    assert packed and all("struct(" in p and "text, text" not in p for p in packed)


# --- tokens and packing ------------------------------------------------------------------------

ODD_TEXTS = [" ", "  ", "\n", " \n", "a", "the", "'s", "é", "😀", "<|endoftext|>", "1", "٣", " ", "　", "!", "\t", "don't", "世界", "́", "THE", "Σ", "\x1c", "''"]


def made_texts(count):
    rng = np.random.default_rng(4)
    return ["".join(rng.choice(ODD_TEXTS, rng.integers(0, 30))) for _ in range(count)]


@pytest.mark.parametrize("vocabulary", [packing.VOCABULARY])
def test_ids_are_the_librarys(vocabulary, texts):
    library = byte_tokens.tokenizer(vocabulary)
    for text in [*made_texts(3000), " " * 5000, "a" * 50_000, *list(texts.values())[:50]]:
        assert byte_tokens.token_ids(vocabulary, text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_counts_are_the_librarys(spark, texts):
    library = byte_tokens.tokenizer(token_counts.VOCABULARY)
    for doc, row in by_id(queries.op7_token_counts(spark, FOLDER)).items():
        n = len(library.encode(texts[doc], add_special_tokens=False).ids)
        assert row == (len(texts[doc].encode()), n, n > 2048)
    made = made_texts(3000)
    assert token_counts.Counter(token_counts.VOCABULARY)(made) == [len(library.encode(t, add_special_tokens=False).ids) for t in made]


def test_counts_of_odd_rows(odd):
    got = token_counts.token_counts(odd)
    assert got.count() == odd.count() and got.filter("doc_id = 1").first()[1:] == (0, 0, False)
    assert token_counts.token_counts(odd.limit(0)).count() == 0


def test_every_token_is_packed_once(spark, documents, texts):
    library = byte_tokens.tokenizer(packing.VOCABULARY)
    pieces = queries.op4_packing(spark, FOLDER).collect()
    own, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        own[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    for doc, text in texts.items():
        ids, at = library.encode(text, add_special_tokens=False).ids + [packing.END], 0
        for p in sorted(own[doc], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    assert sorted(sequences) == list(range(len(sequences)))
    for number, held in sequences.items():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == packing.SEQUENCE or number == len(sequences) - 1


def test_deficits_stay_under_one_packet(spark):
    rng = np.random.default_rng(5)
    rows = [(k, ["big", "mid", "small"][min(2, int(rng.exponential(0.7)))], int(rng.integers(1, 9000))) for k in range(3000)]
    sizes = spark.createDataFrame(rows, "row long, source string, doc_tokens long")
    total = Counter()
    for _, source, n in rows:
        total[source] += n
    served = defaultdict(Counter)
    source = {r[0]: r[1] for r in rows}
    for p in packing.planned(sizes).collect():
        served[p.window][source[p.row]] += p.length
    done, everything = Counter(), sum(total.values())
    for window in sorted(served)[:-1]:
        done += served[window]
        for name in total:
            assert -packing.SEQUENCE < done[name] - window * packing.WINDOW_TOKENS * total[name] / everything <= 0


def test_windows_hold_the_given_mixture(spark):
    rng = np.random.default_rng(6)
    rows = [(k, "big" if k % 10 else "small", int(rng.integers(1, 5000))) for k in range(2000)]
    sizes, weights = spark.createDataFrame(rows, "row long, source string, doc_tokens long"), {"big": 3, "small": 2}
    source, served = {r[0]: r[1] for r in rows}, defaultdict(Counter)
    for p in packing.planned(sizes, weights).collect():
        served[p.window][source[p.row]] += p.length
    assert sum(map(Counter.total, served.values())) == sum(r[2] for r in rows)
    ends = {name: max(w for w in served if served[w][name]) for name in weights}
    done = Counter()
    for window in sorted(served):
        done += served[window]
        for name in weights:
            if window < ends[name]:  # while the queue lasts
                assert -packing.SEQUENCE < done[name] - window * packing.WINDOW_TOKENS * weights[name] / 5 <= 0


@pytest.mark.parametrize("weight", [0, -1])
def test_weights_start_at_one(spark, weight):
    sizes = spark.createDataFrame([(1, "a", 5)], "row long, source string, doc_tokens long")
    with pytest.raises(ValueError):
        packing.planned(sizes, {"a": weight})


def test_packing_of_odd_rows(odd):
    pieces = packing.pack(odd).collect()
    assert sum(p.length for p in pieces if p.doc_id in (1, 2)) == 2
    assert packing.pack(odd.limit(0)).count() == 0
    assert packing.pack(odd.drop("source")).groupBy().sum("length").first()[0] == sum(p.length for p in pieces)
    weighted = packing.pack(odd, targets={"a": 3, "c": 1})
    assert weighted.groupBy().sum("length").first()[0] == sum(p.length for p in pieces)
