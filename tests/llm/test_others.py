"""Search, URLs, secrets, sampled pieces and the pipeline."""

import math
import random
import re
from collections import Counter
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from demandloom.llm import queries, sampled_pieces as pieces, topk_search as topk
from demandloom.llm.oracle import ORACLE
from demandloom.llm.quality_rules import keep_good
from demandloom.llm.secret_scan import secret_scan
from demandloom.llm.topk_search import topk_search
from demandloom.llm.url_filter import best_split, url_verdicts
from tests.conftest import FOLDER
from tests.llm.test_documents import base_spans, classes, repeats


# --- exact search ------------------------------------------------------------------------------

def test_search_matches_sql(spark):
    base = duckdb.connect()
    base.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
    got = queries.op2_topk_search(spark, FOLDER).select("query_id", "rank", "vec_id", "score")
    assert sorted(map(tuple, got.collect())) == sorted(base.execute(ORACLE["op2_topk_search"]).fetchall())


def test_search_with_ties_and_odd_vectors(spark):
    rows = [(i, [[-1.5, 0.0, 0.25, 1.0][(i * k) % 4] for k in (1, 3, 7)]) for i in range(200)]
    odd = [(200, None), (220, [None, 1.0, 2.0]), (240, [float("nan"), 1.0, 1.0]), (260, []), (280, [1.0, 2.0]), (300, [float("inf"), 0.0, 0.0]),
           (None, [1.0, 1.0, 1.0]), (20, [9.0, 9.0, 9.0])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    whole = {i: [math.floor(64 * x) for x in v] for i, v in rows}
    expected = []
    for query in range(0, 200, 20):
        scores = sorted((-sum(a * b for a, b in zip(whole[query], v)), i) for i, v in whole.items() if i != query)
        expected += [(query, rank, i, -s) for rank, (s, i) in enumerate(scores[:20], 1)]
    assert sorted(map(tuple, topk_search(frame).collect())) == expected
    assert topk_search(frame.limit(0)).count() == 0
    assert topk_search(frame.filter("vec_id in (0, 1, 2)")).count() == 2  # fewer than k candidates: all


@pytest.mark.parametrize("length, size", [(3, 1e6), (5, 2e7), (20_000, 2.0), (9, 16_384.0)])
def test_search_is_exact_for_large_and_long_vectors(spark, length, size):
    rng = np.random.default_rng(length)
    vectors = rng.uniform(-size, size, (45, length))
    vectors[7] = vectors[3]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(3)
    whole = [[math.floor(64 * x) for x in v] for v in vectors.tolist()]
    expected = []
    for query in range(0, 45, 20):
        scores = sorted((-sum(a * b for a, b in zip(whole[query], v)), i) for i, v in enumerate(whole) if i != query)
        expected += [(query, rank, i, -s) for rank, (s, i) in enumerate(scores[:20], 1)]
    assert sorted(map(tuple, topk_search(frame).collect())) == expected


def test_search_refuses_scores_beyond_64_bits(spark):
    frame = spark.createDataFrame([(0, [1e9, 1.0]), (1, [1e9, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        topk_search(frame).collect()


def test_search_over_several_query_blocks(spark, monkeypatch):
    frame = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    whole = sorted(map(tuple, topk_search(frame).collect()))
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    assert sorted(map(tuple, topk_search(frame).collect())) == whole


# --- URLs --------------------------------------------------------------------------------------

def test_hosts_paths_and_rules(spark):
    rows = [
        (1, None), (2, ""), (3, "http://A.NET"), (4, "http://a.net/?x"), (None, "//foo"), (6, "ftp://Sub.Example.NET/en/x#y"),
        (6, "http://example.net/English"), (7, "http://example.com/de/"), (8, "http://xexample.com/de/?a"), (9, "x://b.org/fr/é?q://r"), (10, "http://" + "long" * 2000 + ".org/"),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string").withColumns({"html": F.lit(None).cast("string"), "rule": F.lit("x")})
    got = sorted((r.page_id or 0, r.host[:20], r.path, r.rule, r.verdict) for r in url_verdicts(frame).collect())
    assert got == [
        (0, "", "", None, "allow"), (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "a.net", "", None, "allow"),
        (4, "a.net", "/", "net/", "block"), (6, "example.net", "/English", "net/", "block"), (6, "sub.example.net", "/en/x", "example.net/en/", "allow"),
        (7, "example.com", "/de/", "example.com/de/", "block"), (8, "xexample.com", "/de/", None, "allow"), (9, "b.org", "/fr/é", "org/fr/", "allow"),
        (10, ("long" * 5), "/", None, "allow"),
    ]
    assert url_verdicts(frame.limit(0)).count() == 0


def test_segmentation_is_the_most_probable():
    logs = {"cheap": -3.0, "pills": -4.0, "che": -5.0, "appills": -9.0, "a": -6.0}
    for part in ["cheappills", "xcheapzz", "aa", "zzz"]:
        words = {(i, len(w)): v for w, v in logs.items() for i in range(len(part)) if part.startswith(w, i)}

        def best(i):
            if i == len(part):
                return 0.0
            return max([-12.0 + best(i + 1)] + [v + best(i + n) for (s, n), v in words.items() if s == i])

        split = best_split(part, words, -12.0)
        assert "".join(split) == part
        assert sum(logs.get(w, -12.0 * len(w)) for w in split) == pytest.approx(best(0))
    assert best_split("cheappills", {(0, 5): -3.0, (5, 5): -4.0}, -12.0) == ["cheap", "pills"]


def test_company_of_seed_words_blocks(spark):
    rows = [(k, f"http://casinofarm{'' if k % 2 else 's'}.example.org/x", "<p>casino farm farms garden</p>") for k in range(20)]
    rows += [(100 + k, "http://garden.example.org/y", "<p>garden farm</p>") for k in range(60)] + [(200, "http://farm.example.org/x", "")]
    got = {r.page_id: r.verdict for r in url_verdicts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == got[1] == "block" and got[200] == "block" and got[100] == "allow"


def test_every_page_is_judged(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    assert queries.op8_url_filter(spark, FOLDER).count() == pages.count()


# --- secrets -----------------------------------------------------------------------------------

def test_forest_on_held_out_findings(spark):
    """Half of the values keep their label as own labels; the other half has none that the forest sees."""
    import hashlib

    rows, truth = [], {}
    for k in range(400):
        key = hashlib.sha256(str(k).encode()).hexdigest()[:24]
        plain = ["orderlyhouse", "gardenpath", "summerhills"][k % 3] + f"{k:04d}"
        rows.append((k, f"the quiet orderly house by the garden path and summer hills key {key} here, file {plain} there"))
        truth[key], truth[plain] = 1, 0
    own = spark.createDataFrame([(v, t) for n, (v, t) in enumerate(truth.items()) if n % 4 < 2], "value string, label int")
    judged = secret_scan(spark.createDataFrame(rows, "doc_id long, text string"), own).filter("label is null").collect()
    right = sum(r.secret == (truth[r.value] == 1) for r in judged)
    assert len(judged) >= 350 and right / len(judged) > 0.97


def test_planted_tokens_are_found_with_names_hidden(spark):
    """Recall and precision of at least 0.9: for every third planted token its name is taken from the
    text, so no rule labels it; as many harmless values of the same form are put beside it."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").collect()
    named = re.compile(r'token = "([0-9a-f]{40})"')
    hidden, rows = set(), []
    for doc, text in docs:
        for n, value in enumerate(named.findall(text or "")):
            if (doc + n) % 3 == 0:
                hidden.add(value)
                text = text.replace(f'token = "{value}"', f'"{value}"')
        rows.append((doc, text))
    harmless = {f"{'-'.join(['section', 'heading', 'chapter'][k % 3 :])}-part-{k:03d}" for k in range(60)}
    rows += [(10**6 + k, f"see {value} for more words of the text") for k, value in enumerate(sorted(harmless))]
    rows += [(2 * 10**6 + k, f"moved to file-of-pages-{k}-{'x' * 8} and back") for k in range(60)]
    judged = secret_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r.value: r.secret for r in judged}
    unlabelled = {r.value for r in judged if r.label is None}
    assert len(hidden) >= 30 and hidden <= unlabelled
    caught = sum(found[v] for v in hidden)
    false = sum(found[v] for v in unlabelled - hidden if v in harmless or v.startswith("file-of-pages"))
    assert caught / len(hidden) >= 0.9 and caught / max(1, caught + false) >= 0.9


def test_secrets_of_odd_rows(spark, odd):
    assert secret_scan(odd.limit(0)).count() == 0
    frame = spark.createDataFrame([(None, "password=79c0b74e2a7015d6d4"), (1, None), (2, "A1" * 50_000), (2, "A1" * 50_000)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.start, r.end) for r in secret_scan(frame).collect())
    assert got == [(0, 9, 27), (2, 0, 100_000), (2, 0, 100_000)]


# --- sampled pieces ----------------------------------------------------------------------------

def segmentations(unit):
    v = pieces.shared_vocabulary(pieces.MODEL)
    if not unit:
        yield (), 0.0
    for n in range(1, len(unit) + 1):
        if unit[:n] in v.ids:
            for rest, weight in segmentations(unit[n:]):
                yield (v.ids[unit[:n]], *rest), v.weights[unit[:n]] + weight


def test_samples_follow_the_lattice():
    text, count = "thetion a", 8000
    parts = [list(segmentations(u)) for u in (pieces.BLANK + "thetion", pieces.BLANK + "a")]
    weights = {a + b: math.exp(x + y) for a, x in parts[0] for b, y in parts[1]}
    total = sum(weights.values())
    lattice = pieces.Lattice(pieces.shared_vocabulary(pieces.MODEL), [text] * count)
    first, unbiased = Counter(), Counter()
    for search in pieces.sampled(lattice, list(range(count)), 3):
        ids = [tuple(pieces.piece_ids(lattice, e).tolist()) for e, _, _ in search.found]
        values = [v for _, _, v in search.found] + [search.threshold]
        assert len(set(ids)) == 3 and values == sorted(values, reverse=True)
        first[ids[0]] += 1
        for own, (_, log_p, _) in zip(ids, search.found):
            assert log_p == pytest.approx(math.log(weights[own] / total))
            unbiased[own] += 1 / -math.expm1(-math.exp(log_p - search.threshold))
    for own, weight in sorted(weights.items(), key=lambda x: -x[1])[:4]:
        p = weight / total
        assert first[own] / count == pytest.approx(p, abs=4 * math.sqrt(p / count))
        assert unbiased[own] / count == pytest.approx(1, abs=0.15)


def test_all_segmentations_of_a_short_text():
    lattice = pieces.Lattice(pieces.shared_vocabulary(pieces.MODEL), ["the", ""])
    long, short = pieces.sampled(lattice, [1, 2], 500)
    expected = {ids for ids, _ in segmentations(pieces.BLANK + "the")}
    assert {tuple(pieces.piece_ids(lattice, e).tolist()) for e, _, _ in long.found} == expected
    assert len(long.found) == len(expected) and long.threshold == -math.inf
    assert sum(math.exp(p) for _, p, _ in long.found) == pytest.approx(1)
    assert [len(e) for e, _, _ in short.found] == [0]


def test_round_trip_and_seeds(spark, documents, texts):
    sampled = pieces.sample_pieces(documents)
    back = pieces.decode_pieces(sampled).collect()
    assert all(r.text == texts[r.doc_id] for r in back)
    assert len({(r.doc_id, r.ids_crc32) for r in back}) == len(back)
    again = {(r.doc_id, r.sample): r.perturbed for r in pieces.sample_pieces(documents.repartition(5)).collect()}
    assert all(again[r.doc_id, r.sample] == r.perturbed for r in back)


def test_pieces_of_odd_rows(odd):
    made = ["é😀\n\nb \t", "\x00 a", "Ａ①", "́e", "q" * 3000, "a  b"]
    lattice = pieces.Lattice(pieces.shared_vocabulary(pieces.MODEL), made)
    for text, search in zip(made, pieces.sampled(lattice, [1] * len(made), 3)):
        for edges, _, _ in search.found:
            assert lattice.vocabulary.decode(pieces.piece_ids(lattice, edges).tolist()) == text
    got = pieces.sample_pieces(odd)
    assert got.filter("doc_id = 1").select("ids", "inclusion").collect() == [([], 1.0)]
    assert got.select("doc_id").distinct().count() == 7 and pieces.sample_pieces(odd.limit(0)).count() == 0


def test_words_enter_a_kept_lattice_once(monkeypatch):
    texts = [f"the thing {k % 3}{' ' * (k % 2)} and\n\nother é😀 \x1f▁ things" for k in range(40)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(40), pa.int64()), "text": pa.array(texts)})

    def rows():
        built, build = [], pieces.Lattice._build
        with monkeypatch.context() as m:
            m.setattr(pieces, "CHUNK", 100)
            m.setattr(pieces.Lattice, "_build", lambda self, words: (built.extend(words), build(self, words)))
            found = [r for b in pieces.segment(pieces.MODEL, 3)(iter([batch])) for r in b.to_pylist()]
        return found, built

    kept, words = rows()
    assert len(kept) == 120 and len(words) == len(set(words))
    monkeypatch.setattr(pieces, "HELD", 0)
    again, words = rows()
    assert len(words) > len(set(words))  # begun anew for each chunk
    assert [(r["doc_id"], r["sample"], r["ids"]) for r in again] == [(r["doc_id"], r["sample"], r["ids"]) for r in kept]
    for name in ("log_prob", "perturbed", "inclusion"):
        assert [r[name] for r in again] == pytest.approx([r[name] for r in kept])


def test_words_of_a_text_are_cut_before_blanks_and_at_line_ends():
    draw = random.Random(3)
    for _ in range(2000):
        text = "".join(draw.choices("ab é\n\t\x1f\u2581", [4, 4, 5, 1, 2, 1, 0.3, 0.3], k=draw.randrange(1, 14)))
        marked = pieces.BLANK + text.replace(" ", pieces.BLANK)
        expected = re.findall(f"{pieces.BLANK}*[^{pieces.BLANK}\n]+|{pieces.BLANK}+|\n", marked)
        assert [u.replace(" ", pieces.BLANK) for u in pieces.units(text)] == expected


def test_ids_are_decoded_as_the_library_does(monkeypatch):
    v, draw = pieces.shared_vocabulary(pieces.MODEL), random.Random(5)
    plain, parts = list(v.ids.values()), list(v.bytes.values())
    blanks, ascii_bytes = [i for p, i in v.ids.items() if p[0] == pieces.BLANK], [v.bytes[x] for x in range(128)]
    pools = [plain, blanks, blanks[:9] + ascii_bytes, [v.ids[pieces.BLANK]] * 99 + ascii_bytes, parts, list(range(v.size))]
    rows = [draw.choices(draw.choice(pools), k=draw.randrange(7)) for _ in range(3000)]
    offsets = np.cumsum([0] + [len(r) for r in rows])
    got = v.decode_all(np.array([i for r in rows for i in r], np.int32), offsets).to_pylist()
    assert got == [v.decode(r) for r in rows]
    monkeypatch.setattr(pieces.Vocabulary, "decode", None)  # plain pieces need no call a row
    assert v.decode_all(np.array(blanks[:4], np.int32), np.array([0, 1, 1, 4])).to_pylist()[1] == ""


# --- pipeline ----------------------------------------------------------------------------------

def test_stages_match_brute_force(spark, documents, texts):
    frames, docs = {}, documents
    for name, stage in corpus_pipeline.STAGES:
        frames[name] = docs = corpus_pipeline.materialise(stage(spark, docs, FOLDER), "test-" + name)
    columns = documents.columns
    assert all(frames[n].columns == columns for n, _ in corpus_pipeline.STAGES[:-1])
    text_of = {n: {r.doc_id: r.text for r in frames[n].collect()} for n, _ in corpus_pipeline.STAGES[:-1]}
    good = {r.doc_id for r in queries.op10_quality_rules(spark, FOLDER).filter("kept").collect()}
    assert text_of["quality_rules"] == {d: t for d, t in texts.items() if d in good}
    classed = classes(text_of["quality_rules"])
    assert text_of["jaccard_join"] == {d: texts[d] for d, (c, _) in classed.items() if c == d}
    for doc, (length, removed, _) in repeats(text_of["jaccard_join"]).items():
        assert len(text_of["substring_dedup"][doc].split()) == length - removed
        if not removed:
            assert text_of["substring_dedup"][doc] == text_of["jaccard_join"][doc]
    for doc, text in text_of["substring_dedup"].items():
        spans = base_spans(text)[1]
        assert (text_of["pii"][doc] == text) == (not spans)
        assert base_spans(text_of["pii"][doc])[0][0] == 0
    packed = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(map(tuple, packed)) == sorted(map(tuple, frames["packing"].collect()))
    assert {p.doc_id for p in packed} == set(text_of["pii"])


def test_stages_keep_odd_rows_whole(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == odd.columns
    assert list(chain.from_iterable(docs.filter("doc_id is null").select("text").collect())) == ["a b c d e f g h i j k l"]


def test_stages_carry_any_column_names(spark, odd):
    names = {"a.b": F.col("n_words"), "_pii_doc": F.lit(1), "_pii_text": F.lit("t"), "row": F.lit(2), "label": F.lit("l"), "class_id": F.lit(3), "c": F.lit(4)}
    docs = named = odd.withColumns(names)
    assert corpus_pipeline.STAGES[0][1](spark, named, FOLDER).columns == named.columns
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == named.columns
    assert docs.filter("text = 'a b c d e f g h i j k l' and `a.b` = 3 and row = 2 and c = 4").count() == 1
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() > 0


def test_quality_carries_any_column_names(spark, documents):
    named = documents.withColumns({"a.b": F.col("doc_id") + 1, "row": F.lit(2)})
    kept = keep_good(named)
    assert kept.columns == named.columns and kept.count() == keep_good(documents).count() > 0
    assert kept.filter("`a.b` != doc_id + 1 or row != 2").isEmpty()
