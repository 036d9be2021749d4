"""Phrase collocation mining on a weighted de Bruijn graph of words.

Texts are cut into pieces and pieces into words, per language. The nodes of the graph are
three-word stretches, and every four-word stretch is an edge from its first three words to its
last three. Only the longest stretch at every place is counted: an edge, or what is left
of the piece there (three, two or one words), the piece-end correction. All shorter counts follow
from the graph:

    f(node) = weight of its outgoing edges + pieces that end with it,

and again for two words from the nodes that begin with them, and for one word from these.

1. *Graph.* Stretches are counted in a task and shuffled packed, so a very frequent stretch is one entry per
   task and portion of its texts. The most frequent words of a bounded sample have codes of two bytes, others eight.
   Stretches are dealt to groups by their first two words; pairs that the sample shows to be very frequent are dealt by
   three, so none of them is one group. Codes and groups change no result. A group
   is sorted: an edge, a node and a pair are runs of stretches, and each run's sum is the flow out of it.
   The flow into single words is summed where the stretches are counted, as sums of sums.
2. *Scores.* Names are 64-bit hashes of (language, words) that follow from the names of the words, so a frequent
   stretch knows the names of all its parts; scores and containment are joins over frequent stretches alone.
3. *Compaction.* A node whose one incoming and one outgoing edge weigh as much as itself lies inside a
   unary path: the same words always surround it. Paths are merged by pointer jumping
   (``passages`` returns them whole); their inner nodes are part of a longer stretch with the same count and drop out.
4. *Texts.* The phrases that remain are read back from the texts by name. Two phrases with one name would raise an error.

Defined cases: null texts are empty; null languages count as ``und``. Every row counts, also
when its doc_id is null or repeats. An empty table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from demandloom.llm.words import BYTE_POWERS, BYTE_VALUES, CHUNK_BYTES, mix, multipliers, signed, stretch_names, window_names
from demandloom.sources.storage import freeze, materialise

LEAST = 30
MOST_WORDS = 4
TOP = 2000
SCALE = 2_000_000
CONTAINED = (100, 80)  # dropped if 100 * f(longer) >= 80 * f(phrase)
UNKNOWN = "und"

NAME_BITS = 26            # the table by which phrases are found again has 2^26 bits
HELD = 3 << 17            # stretches that a task combines before it sends them on
IN_GROUP = 1 << 19        # stretches of a group that a task sorts at once, about
SAMPLED = 2000            # texts that show which words and pairs are frequent
CODES = (1 << 16) - 2     # words with a code
HOT_SHARE = 1000          # pairs with more than 1 / HOT_SHARE of the sample's words are hot, so at most as many

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CUT = np.zeros(256, bool)
_CUT[[*b".,;:!?", 10, 11, 12, 13]] = True
_OUTSIDE = _CUT.copy()
_OUTSIDE[[9, 32]] = True


class Stretches:
    """The words of several texts of one chunk, and the names of the stretches at every word."""

    def __init__(self, texts: list[bytes], languages: list[str], codes: np.ndarray):
        self.data = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
        inside = ~_OUTSIDE[self.data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edges = np.concatenate([[0], edges])
        self.begin, self.end = edges[::2], edges[1::2]
        piece = np.cumsum(_CUT[self.data])[self.begin]
        last = np.searchsorted(piece, piece, side="right")
        self.left = np.minimum(last - np.arange(len(piece)), MOST_WORDS)  # words up to the piece's end
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
        self.text = np.searchsorted(starts, self.begin, side="right") - 1
        self.languages = languages
        known = {x: _language_name(x) for x in set(languages)}
        own = np.array([known[x] for x in languages], np.uint64)
        words = mix(stretch_names(BYTE_VALUES[0][self.data], BYTE_POWERS[0], self.begin, self.end) + own[self.text])
        words |= np.uint64(1 << 63)
        if len(codes):
            place = np.minimum(np.searchsorted(codes, words), len(codes) - 1)
            words = np.where(codes[place] == words, (place + 1).astype(np.uint64), words)
        self.words = words

    def names(self, width: int) -> np.ndarray:
        """The name of the stretch of ``width`` words at every word; 0 where the piece is too short."""
        result = np.zeros(len(self.words), np.uint64)
        own = window_names(self.words, width, width)
        result[: len(own)] = own
        result[self.left < width] = 0
        return result

    def longest(self) -> np.ndarray:
        """The words of the longest stretch at every word, 0 beyond it."""
        rows = np.zeros((len(self.words), MOST_WORDS), np.uint64)
        for n in range(MOST_WORDS):
            rows[: max(0, len(rows) - n), n] = self.words[n:]
            rows[self.left <= n, n] = 0
        return rows

    def phrase(self, at: int, width: int) -> str:
        return b" ".join(self.data[self.begin[i] : self.end[i]].tobytes() for i in range(at, at + width)).decode("utf-8", "replace")


def _language_name(language: str) -> int:
    data = language.encode("utf-8", "surrogatepass")
    return int(mix(np.array([int.from_bytes(data[i : i + 8], "little") + (len(data) << 56) & (1 << 64) - 1 for i in range(0, len(data) or 1, 8)], np.uint64)).sum())


def chunks(batches: Iterator[pa.RecordBatch], codes: np.ndarray, most: int) -> Iterator[Stretches]:
    """The rows of a task in chunks of about ``most`` bytes of text; a longer text comes alone."""
    texts, languages, size = [], [], 0
    for batch in batches:
        for text, language in zip(batch.column("text"), batch.column("lang").to_pylist()):
            texts.append(text.as_py() or b"")
            languages.append(language)
            size += len(texts[-1])
            if size >= most:
                yield Stretches(texts, languages, codes)
                texts, languages, size = [], [], 0
    if texts:
        yield Stretches(texts, languages, codes)


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("text").cast("string").cast("binary").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    )


def stretch_name(words: np.ndarray) -> np.ndarray:
    """The names of stretches given as rows of words."""
    total = np.zeros(len(words), np.uint64)
    for k, factor in enumerate(multipliers(words.shape[1], words.shape[1])):
        total += words[:, k] * factor
    return mix(total)


# --- graph ----------------------------------------------------------------------------------

class Plan:
    """What a bounded sample says about codes and groups."""

    def __init__(self, texts: DataFrame):
        rows = texts.count()
        share = min(1.0, SAMPLED / max(rows, 1))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for chunk in chunks(batches, np.zeros(0, np.uint64), CHUNK_BYTES):
                names, counts = np.unique(chunk.words, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(names)), pa.array(counts)], ["name", "count"])

        sample = materialise(texts.sample(False, share, 1), "sampled-texts")
        found = sample.mapInArrow(count, "name long, count long").groupBy("name").agg(F.sum("count").alias("count"))
        words = found.orderBy(F.desc("count"), "name").limit(CODES)
        self.codes = np.sort(np.array([r["name"] for r in words.collect()], np.int64).view(np.uint64))
        total = found.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
        self.bits = min(20, max(10, int(total / share / IN_GROUP).bit_length()))
        # Names of pairs follow from the codes, so pairs are counted again under them.
        pairs = sample_pairs(sample, self.codes).filter(F.col("count") * HOT_SHARE > total)
        self.hot = np.sort(np.array([r["name"] for r in pairs.collect()], np.int64).view(np.uint64))  # at most HOT_SHARE


def sample_pairs(sample: DataFrame, codes: np.ndarray) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, codes, CHUNK_BYTES):
            names = chunk.names(2)
            names, counts = np.unique(names[names != 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(names)), pa.array(counts)], ["name", "count"])

    return sample.mapInArrow(count, "name long, count long").groupBy("name").agg(F.sum("count").alias("count"))


def _hot(pairs: np.ndarray, hot: np.ndarray) -> np.ndarray:
    return hot[np.minimum(np.searchsorted(hot, pairs), len(hot) - 1)] == pairs if len(hot) else np.zeros(len(pairs), bool)


def _groups(words: np.ndarray, hot: np.ndarray, bits: int) -> np.ndarray:
    """The group of every stretch, by its first word if it has only one, else by two or three."""
    pair = stretch_name(words[:, :2])
    deal = np.where(words[:, 1] == 0, mix(words[:, 0]), np.where(_hot(pair, hot), stretch_name(words[:, :3]), pair))
    return deal >> np.uint64(64 - bits)


PACKED = "group int, lang string, codes binary, others binary, counts binary"


def packed_stretches(texts: DataFrame, plan) -> DataFrame:
    """The longest stretches of portions of a task, combined: a row for every group, with the words of the
    stretches column by column, two bytes each, and those without a code behind them.

    Stretches of one word carry all occurrences of the word, as the sum of what flows into it.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, hot, bits = plan.value

        def rows_of(language: str, rows: np.ndarray, counts: np.ndarray | None) -> pa.RecordBatch:
            group = _groups(rows, hot, bits)
            # Equal stretches lie together, then those with the same beginning: that packs best.
            key = group << np.uint64(64 - bits) | mix(rows[:, 0]) >> np.uint64(44) << np.uint64(44 - bits)
            order = np.argsort(key | stretch_name(rows) >> np.uint64(bits + 20))
            rows, group = rows[order], group[order]
            if counts is None:
                starts = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)]))
                counts = np.diff(np.append(starts, len(rows)))
                rows, group = rows[starts], group[starts]
            else:
                counts = counts[order]
            known = rows < np.uint64(1 << 16)
            small, counts = np.where(known, rows, np.uint64((1 << 16) - 1)).astype(np.uint16), counts.astype(np.uint32)
            cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            ends = np.append(cuts[1:], len(group))
            return pa.RecordBatch.from_arrays([
                pa.array(group[cuts].astype(np.int32)), pa.array([language] * len(cuts), pa.string()),
                pa.array([small[a:b].T.tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                pa.array([rows[a:b].T[~known[a:b].T].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            ], ["group", "lang", "codes", "others", "counts"])

        def send(parts: list[tuple[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            for language in sorted({x for x, _ in parts}):
                rows = np.concatenate([r for x, r in parts if x == language])
                words, counts = np.unique(rows[:, 0], return_counts=True)
                alone = np.zeros((len(words), MOST_WORDS), np.uint64)
                alone[:, 0] = words
                yield rows_of(language, alone, counts)
                rows = rows[rows[:, 1] != 0]
                if len(rows):
                    yield rows_of(language, rows, None)

        parts, size = [], 0
        for chunk in chunks(batches, codes, CHUNK_BYTES):
            rows, of = chunk.longest(), np.array(chunk.languages, object)[chunk.text]
            for language in set(chunk.languages):
                own = rows[of == language]
                if len(own):
                    parts.append((language, own))
            size += len(rows)
            if size >= HELD:
                yield from send(parts)
                parts, size = [], 0
        if size:
            yield from send(parts)

    return texts.mapInArrow(pack, PACKED)


def _unpacked(codes: bytes, others: bytes) -> np.ndarray:
    """The words of packed stretches, a row for each."""
    small = np.frombuffer(codes, np.uint16)
    words = small.astype(np.uint64)
    words[small == (1 << 16) - 1] = np.frombuffer(others, np.uint64)
    return words.reshape(MOST_WORDS, -1).T


FLOWS = "lang string, words int, name long, heads array<long>, tails array<long>, inner_pair long, f long"


def _flows(least: int, plan):
    """Edges, nodes, pairs and words with at least ``least`` occurrences, from rows sorted by group and language.

    Of hot pairs a group sees a part only, so these come with any count. Rows with words 0 are
    the words of a language.
    """
    fields = ["lang", "words", "name", "heads", "tails", "inner_pair", "f"]

    def group_flows(language: str, parts: list, totals: dict[str, int]) -> Iterator[pa.RecordBatch]:
        hot = plan.value[1]
        rows, counts = np.concatenate([_unpacked(c, o) for c, o, _ in parts]), np.concatenate([np.frombuffer(n, np.uint32) for _, _, n in parts]).astype(np.int64)
        order = np.lexsort(rows.T[::-1])
        rows, counts = rows[order], counts[order]
        alone = rows[:, 1] == 0
        totals[language] = totals.get(language, 0) + int(counts[alone].sum())
        for n in range(1, MOST_WORDS + 1):
            fits = alone if n == 1 else rows[:, n - 1] != 0  # what has fewer words is no run of this level
            own, f = rows[fits][:, :n], counts[fits]
            if not len(own):
                continue
            starts = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]).any(axis=1)]))
            own, f = own[starts], np.add.reduceat(f, starts)
            enough = f >= least
            if n == 2:
                enough |= _hot(stretch_name(own), hot)
            own, f = own[enough], f[enough]
            parts_of = lambda cut: pa.array(np.stack([signed(stretch_name(cut(k))) for k in range(1, n)], axis=1).tolist() if n > 1 else [[]] * len(own), pa.list_(pa.int64()))  # noqa: B023, E731
            inner = signed(stretch_name(own[:, 1:3])) if n == 4 else np.zeros(len(own), np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array([language] * len(own), pa.string()), pa.array(np.full(len(own), n, np.int32)), pa.array(signed(stretch_name(own))),
                parts_of(lambda k: own[:, :k]), parts_of(lambda k: own[:, n - k :]), pa.array(inner), pa.array(f),  # noqa: B023
            ], fields)

    def flows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}
        current, parts = None, []
        for batch in batches:
            keys = zip(batch.column("group").to_pylist(), batch.column("lang").to_pylist())
            for row, key in enumerate(keys):
                if key != current:
                    if parts:
                        yield from group_flows(current[1], parts, totals)
                    current, parts = key, []
                parts.append(tuple(batch.column(c)[row].as_py() for c in ("codes", "others", "counts")))
        if parts:
            yield from group_flows(current[1], parts, totals)
        blank, none = [0] * len(totals), pa.array([[]] * len(totals), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([
            pa.array(list(totals), pa.string()), pa.array(blank, pa.int32()), pa.array(blank, pa.int64()), none, none, pa.array(blank, pa.int64()), pa.array(list(totals.values()), pa.int64()),
        ], fields)
    return flows


def stretch_flows(texts: DataFrame, plan, least: int = LEAST) -> DataFrame:
    """Every stretch of 1 to 4 words with at least ``least`` occurrences, and with words 0 the languages' sizes."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = packed_stretches(texts, plan).repartition(parts, "group").sortWithinPartitions("group", "lang")
    flows = dealt.mapInArrow(_flows(least, plan), FLOWS)
    own = [F.first(c).alias(c) for c in ("heads", "tails", "inner_pair")]
    return materialise(flows.groupBy("lang", "words", "name").agg(*own, F.sum("f").alias("f")).filter(F.col("f") >= F.when(F.col("words") == 0, 0).otherwise(least)), "stretch-flows")


# --- phrases ---------------------------------------------------------------------------------

def bit_table(names: DataFrame, bits: int):
    """Broadcast table of 2^bits bits, set at the hash prefix of every name."""
    place = F.shiftrightunsigned("name", 64 - bits)
    pages = names.select(place.alias("place")).groupBy(F.shiftright("place", 15).alias("page")).agg(
        F.expr("bitmap_construct_agg(place % 32768)").alias("bits")
    )
    table = np.zeros(max(4096, 1 << (bits - 3)), np.uint8)
    for row in pages.collect():  # at most 2^(bits - 15) rows of 4096 bytes
        table[row["page"] * 4096 : (row["page"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return names.sparkSession.sparkContext.broadcast(table)


def _has(table: np.ndarray, names: np.ndarray, bits: int) -> np.ndarray:
    place = (names >> np.uint64(64 - bits)).astype(np.int64)
    return (table[place >> 3] >> (place & 7).astype(np.uint8)) & 1 != 0  # Spark's bitmaps count from the lowest bit


def with_phrases(texts: DataFrame, stretches: DataFrame, plan) -> DataFrame:
    """``stretches`` with their text, read back from all texts by name."""
    wanted = bit_table(stretches, NAME_BITS)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for chunk in chunks(batches, plan.value[0], CHUNK_BYTES):
            names, phrases = [], []
            for n in range(2, MOST_WORDS + 1):
                own = chunk.names(n)
                at = np.flatnonzero((own != 0) & _has(wanted.value, own, NAME_BITS))
                distinct, first = np.unique(own[at], return_index=True)
                for name, place in zip(distinct.tolist(), at[first].tolist()):
                    if name not in seen:
                        seen.add(name)
                        names.append(name)
                        phrases.append(chunk.phrase(place, n))
            if len(seen) > HELD:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(signed(np.array(names, np.uint64))), pa.array(phrases, pa.string())], ["name", "phrase"])

    found = texts.mapInArrow(find, "name long, phrase string").join(stretches.select("name"), "name", "left_semi")
    one = found.groupBy("name").agg(F.min("phrase").alias("phrase"), F.max("phrase").alias("other"))
    clash = F.raise_error(F.lit("two phrases share a name")).cast("string")
    return stretches.join(one.select("name", F.when(F.col("phrase") == F.col("other"), F.col("phrase")).otherwise(clash).alias("phrase")), "name")


class Graph:
    """Frequent stretches of a corpus, written once."""

    def __init__(self, docs: DataFrame, least: int = LEAST):
        self.texts = _input(docs)
        plan = Plan(self.texts)
        self.plan = docs.sparkSession.sparkContext.broadcast((plan.codes, plan.hot, plan.bits))  # at most CODES and HOT_SHARE numbers
        flows = stretch_flows(self.texts, self.plan, least)
        self.sizes = flows.filter("words = 0").select("lang", F.col("f").alias("n"))
        self.counts = flows.filter("words > 0")
        self.phrases = flows.filter("words > 1")

    @property
    def edges(self) -> DataFrame:
        """name, lang, source, target, f: the four-word stretches between their nodes."""
        return self.phrases.filter(F.col("words") == MOST_WORDS).select(
            "name", "lang", F.col("heads")[MOST_WORDS - 2].alias("source"), F.col("tails")[MOST_WORDS - 2].alias("target"), "f"
        )

    @property
    def unary_nodes(self) -> DataFrame:
        """node: nodes that one edge enters and one leaves, each with all occurrences of the node."""
        nodes = self.phrases.filter(F.col("words") == MOST_WORDS - 1).select(F.col("name").alias("node"), "f")
        into = self.edges.groupBy(F.col("target").alias("node")).agg(F.max("f").alias("most_in"))
        out = self.edges.groupBy(F.col("source").alias("node")).agg(F.max("f").alias("most_out"))
        return nodes.join(into, "node").join(out, "node").filter("f = most_in AND f = most_out").select("node")


def unary_paths(graph: Graph) -> DataFrame:
    """edge, head, step: every edge with the first edge of its unary path and its place in it.

    Every edge points to the one before it over a unary node; pointers jump until all point to heads,
    so the rounds are the logarithm of the longest path. A cycle of unary nodes would
    need a text without an end, so there is none.
    """
    edges = graph.edges
    # At a unary node the edge that carries all its occurrences is the only one.
    into = edges.join(graph.unary_nodes, F.col("target") == F.col("node")).select(F.col("node").alias("source"), F.col("name").alias("before"))
    state = freeze(edges.join(into, "source", "left").select(
        F.col("name").alias("edge"), F.coalesce("before", "name").alias("head"), F.when(F.col("before").isNull(), F.lit(0)).otherwise(F.lit(1)).alias("step")
    ))
    while True:
        further = state.select(F.col("edge").alias("head"), F.col("head").alias("next"), F.col("step").alias("more"))
        jumped = freeze(state.join(further, "head").select("edge", "head", "next", (F.col("step") + F.col("more")).alias("step")))
        done = jumped.filter("head != next").isEmpty()
        state = jumped.select("edge", F.col("next").alias("head"), "step")
        if done:
            return state


def passages(graph: Graph) -> DataFrame:
    """lang, phrase, words, f: the compacted paths as whole phrases of four or more words."""
    steps = unary_paths(graph).join(with_phrases(graph.texts, graph.edges, graph.plan).withColumnRenamed("name", "edge"), "edge")
    # Only an edge's last word is new after the path's first edge.
    word = F.when(F.col("step") == 0, F.col("phrase")).otherwise(F.element_at(F.split("phrase", " "), -1))
    return steps.groupBy("head").agg(
        F.first("lang").alias("lang"), F.first("f").alias("f"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("step", word.alias("word")))), lambda x: x["word"]), " ").alias("phrase"),
        (F.count(F.lit(1)) + MOST_WORDS - 1).alias("words"),
    ).drop("head")


def _contained(graph: Graph, contained: tuple[int, int]) -> DataFrame:
    """name: stretches that mostly occur inside one longer stretch."""
    long_ones = graph.phrases.filter("words > 2")
    inner = F.filter(F.array(F.col("inner_pair")), lambda x: x != 0)
    parts = F.concat(F.slice("heads", 2, MOST_WORDS), F.slice("tails", 2, MOST_WORDS), inner)
    most = long_ones.select(F.explode(F.array_distinct(parts)).alias("name"), "f").groupBy("name").agg(F.max("f").alias("longest_f"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    return graph.phrases.join(most, "name").filter(contained[0] * wide("longest_f") >= contained[1] * wide("f")).select("name")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, scale: int = SCALE, contained: tuple[int, int] = CONTAINED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of every language."""
    graph = Graph(docs, least)
    inside = unary_paths(graph).filter("step > 0").select(F.col("edge").alias("name")).join(graph.edges, "name").select(F.col("source").alias("name"))
    kept = graph.phrases.join(inside, "name", "left_anti").join(_contained(graph, contained), "name", "left_anti")
    cuts = kept.select("name", "lang", F.col("f").alias("a"), F.inline(F.expr(
        "transform(sequence(1, words - 1), k -> named_struct('k', k, 'head', heads[k - 1], 'tail', tails[words - k - 1]))"
    )))
    own = graph.counts.select("name", "f")
    split = cuts.join(own.select(F.col("name").alias("head"), F.col("f").alias("l")), "head").join(own.select(F.col("name").alias("tail"), F.col("f").alias("r")), "tail")
    # Integer division: a quotient of decimals would be rounded before it is floored.
    score = F.expr(f"(cast({scale} as decimal(10,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = split.withColumn("score", score)
    lowest = scored.groupBy("name").agg(
        F.first("lang").alias("lang"), F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"),
    ).select("name", "lang", "a", "cut.l", "cut.r", "cut.score")
    # Phrases only break ties: those that can be among the first are found by score and count, then read back.
    order = [F.desc("score"), F.desc("a")]
    first = materialise(lowest.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("place") <= top).drop("place"), "best-phrases")
    best = Window.partitionBy("lang").orderBy(*order, "phrase")
    ranked = with_phrases(graph.texts, first, graph.plan).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(graph.sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
