"""SentencePiece encoding and decoding: distinct sampled segmentations by a perturbed A* search.

The lattice of a text has an edge for every vocabulary piece at every place, and byte pieces
for characters that the vocabulary lacks. A piece of merge rank r weighs 1 / (r + 2): merge
vocabularies carry ranks and no probabilities, and frequencies of ranks fall about so. Sums
from the right turn weights into conditional probabilities of each edge at its place, so a
walk from the left draws a segmentation with its exact probability.

Gumbel top-k: give each segmentation its log probability plus a Gumbel value and take the k
largest. The search is top-down. The largest of all is Gumbel(0), at a plain draw. What
remains splits at each step of it into the segmentations that first differ there; each part
has a Gumbel maximum at its log mass, cut off at its parent's. A queue of parts gives the next
one, which draws its segmentation and splits again. The (k+1)-th value is the threshold of the
inclusion scores, 1 - exp(-exp(log p - threshold)).

All random values are hashes of (seed, row key, sample, place), so results don't depend on
partitions or retries. No piece crosses the begin of a blank or a line end (checked when the
vocabulary is loaded), so places are shared by all occurrences of a word. A task keeps the
lattice from one chunk of texts to the next and adds only new words, until it has ``HELD`` edges.
Ids are decoded by a table of what the library gives for each piece; rows with parts of
characters or with control ids go to the library itself.

Defined cases: null and empty texts have the one empty segmentation, with probability 1; a
text with fewer than k segmentations gives all it has, with inclusion 1. Every row gets its
samples, also when the key is null (as key 0) or repeats. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from demandloom.llm.byte_tokens import vocabulary_path
from demandloom.llm.words import mix, text_chunks

MODEL = "piece_bpe_32k.model"
SAMPLES = 3
CHUNK = 1 << 18  # characters whose walks and samples a task holds at once
HELD = 1 << 22  # edges of a lattice from which on the next chunk begins a new one
SEED = 7
BLANK = "▁"
CUT = "\x1f"
UNITS = re.compile(" *[^ \n]+| +|\n")
STRIDE = np.uint64(0x9E3779B97F4A7C15)


def units(text: str) -> list[str]:
    """The words of a text after the blank put before it, each with the blanks before it; line ends alone."""
    if not text:
        return []
    text = " " + text.replace(BLANK, " ")
    if "  " in text or CUT in text:
        return UNITS.findall(text)
    return list(filter(None, text.replace(" ", CUT + " ").replace("\n", f"{CUT}\n{CUT}").split(CUT)))


class Trie:
    """All beginnings of some strings: node 0 is the empty one, ``nodes`` the others from 1 on.

    The child of a node by a character lies at ``base[node] + code`` of the character, if ``owner`` there is the node.
    Codes are from 1 on; 0 stands for characters of no string.
    """

    def __init__(self, strings: list[str]):
        self.nodes = {"": 0}
        for x in strings:
            for k in range(1, len(x) + 1):
                self.nodes.setdefault(x[:k], len(self.nodes))
        alphabet = sorted({x[-1] for x in self.nodes if x})
        self.codes = np.zeros(0x110000, np.int32)
        self.codes[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        parent = np.array([self.nodes[x[:-1]] for x in self.nodes if x], np.int64)
        code = self.codes[[ord(x[-1]) for x in self.nodes if x]]
        size = 4 << len(parent).bit_length()
        self.base = np.zeros(len(self.nodes), np.int32)
        self.owner = np.full(size + len(alphabet) + 1, -1, np.int32)
        self.child = np.zeros(len(self.owner), np.int32)
        children = np.bincount(parent, minlength=len(self.nodes))
        # Nodes with many children first; each takes the first of its hashed places that is free for all its children.
        for least, most in ((256, 1 << 30), (64, 256), (16, 64), (4, 16), (1, 4)):
            left, attempt = np.flatnonzero((children[parent] >= least) & (children[parent] < most)), 0
            while len(left):
                own = parent[left]
                tried = (mix(own.astype(np.uint64) + np.uint64(attempt << 32)) % np.uint64(size)).astype(np.int64)
                slots = tried + code[left]
                ok = np.zeros(len(left), bool)
                ok[np.unique(slots, return_index=True)[1]] = True
                ok &= self.owner[slots] < 0
                fails = np.zeros(len(self.nodes), bool)
                fails[own[~ok]] = True
                done = ~fails[own]
                self.base[own[done]] = tried[done]
                self.owner[slots[done]], self.child[slots[done]] = own[done], left[done] + 1
                left, attempt = left[~done], attempt + 1


class Vocabulary:
    def __init__(self, model: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(model))
        p = self.processor
        self.weights, self.ids, self.bytes = {}, {}, {}
        for i in range(p.get_piece_size()):
            piece = p.id_to_piece(i)
            if p.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)):
                self.ids[piece] = i
                self.weights[piece] = -math.log(2 - p.get_score(i))
                if BLANK in piece.lstrip(BLANK) or ("\n" in piece and piece != "\n"):
                    raise ValueError("a piece crosses the begin of a blank or a line end")
        self.byte_weight = -math.log(2 * p.get_piece_size())
        self.trie = Trie([x.replace(BLANK, " ") for x in self.ids])
        self.node_ids, self.node_weights = np.full(len(self.trie.nodes), -1), np.zeros(len(self.trie.nodes))
        nodes = [self.trie.nodes[x.replace(BLANK, " ")] for x in self.ids]
        self.node_ids[nodes], self.node_weights[nodes] = list(self.ids.values()), list(self.weights.values())
        # What a piece stands for after others, and at the begin of a text; bytes only if they are characters.
        self.size, some = p.get_piece_size(), next(iter(self.ids.values()))
        shown, before = [""] * (2 * self.size), len(p.decode([some, some]))
        own = [*self.ids.values(), *(i for x, i in self.bytes.items() if x < 128)]
        for i, after, alone in zip(own, p.decode([[some, some, i] for i in own]), p.decode([[i] for i in own])):
            shown[i], shown[self.size + i] = after[before:], alone
        self.shown, self.known = pa.array(shown, pa.string()), np.zeros(self.size, bool)
        self.known[own] = True

    def decode(self, ids: list[int]) -> str:
        return self.processor.decode(ids)

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of consecutive stretches of ids; those with parts of characters or special ids by the library."""
        lengths = np.diff(offsets)
        known = (ids >= 0) & (ids < self.size)
        known &= self.known[np.where(known, ids, 0)]
        rows = np.repeat(np.arange(len(lengths)), lengths)[~known]
        place = np.where(known, ids, 0)
        place[offsets[:-1][lengths > 0]] += self.size
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), self.shown.take(pa.array(place, pa.int32())))
        texts = pc.binary_join(lists, "")
        if not len(rows):
            return texts
        texts = texts.to_pylist()
        for row in np.unique(rows).tolist():
            texts[row] = self.decode(ids[offsets[row] : offsets[row + 1]].tolist())
        return pa.array(texts, pa.string())


class Lattice:
    """Places and edges of the distinct words of some texts; a place's edges are consecutive.

    ``starts`` has the first place of every word of every text last added, ``bounds`` cuts it by text.
    Words stay from one addition to the next, until there are ``HELD`` edges.
    """

    def __init__(self, vocabulary: Vocabulary, texts: list[str] = ()):
        self.vocabulary = vocabulary
        self._clear()
        self.add(texts)

    def _clear(self) -> None:
        self.numbers, self.fallback = {}, []
        self.first, self.word_starts = np.zeros(1, np.int32), np.zeros(0, np.int32)
        self.chances, self.sums = np.zeros(0), np.zeros(0)
        self.after, self.pieces, self.place = (np.zeros(0, np.int32) for _ in range(3))
        self.sizes = dict.fromkeys(("first", "word_starts", "chances", "sums", "after", "pieces", "place"), 0)

    def _append(self, name: str, values: np.ndarray) -> None:
        held, size = getattr(self, name), self.sizes[name]
        if size + len(values) >= len(held):
            grown = np.zeros(max(2 * len(held), size + len(values) + 1), held.dtype)
            grown[:size] = held[:size]
            setattr(self, name, held := grown)
        held[size : size + len(values)] = values
        self.sizes[name] = size + len(values)

    def add(self, texts: list[str]) -> Lattice:
        if self.sizes["chances"] > HELD:
            self._clear()
        own = [units(t) for t in texts]
        words = list(chain.from_iterable(own))
        fresh = [w for w in dict.fromkeys(words) if w not in self.numbers]
        if fresh:
            self.numbers.update(zip(fresh, range(len(self.numbers), len(self.numbers) + len(fresh))))
            self._build(fresh)
        self.bounds = np.cumsum([0] + [len(o) for o in own])
        self.starts = self.word_starts[np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))]
        return self

    def _build(self, words: list[str]) -> None:
        v, trie = self.vocabulary, self.vocabulary.trie
        lengths = np.array(list(map(len, words)))
        ends = np.cumsum(lengths + 1) - 1
        text, count = CUT.join(words) + CUT, int(ends[-1]) + 1
        codes = trie.codes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        codes[ends] = 0
        # Places are numbered by their distance from the word's end, so that each distance is one stretch.
        distance = np.repeat(ends, lengths + 1) - np.arange(count)
        by_distance = np.argsort(distance.astype(np.uint16) if lengths.max() < 1 << 16 else distance, kind="stable")
        number = np.empty(count, np.int32)
        number[by_distance] = np.arange(count, dtype=np.int32)
        found, lacks = [], np.ones(count, bool)
        lacks[ends] = False
        at, state, length = np.flatnonzero(codes), 0, 0
        while len(at):
            slot = trie.base[state] + codes[at + length]
            hit = np.flatnonzero(trie.owner[slot] == state)
            at, state, length = at[hit], trie.child[slot[hit]], length + 1
            piece = v.node_ids[state]
            whole = np.flatnonzero(piece >= 0)
            places = at[whole]
            found.append((number[places], number[places + length], v.node_weights[state[whole]], piece[whole]))
            if length == 1:
                lacks[places] = False
        # Characters that are no piece: their bytes.
        lacking = np.flatnonzero(lacks)
        fallback = [[v.bytes[x] for x in text[i].replace(" ", BLANK).encode("utf-8", "surrogatepass")] for i in lacking.tolist()]
        weights = np.array([v.byte_weight * len(f) for f in fallback])
        pieces = np.array([f[0] if len(f) == 1 else -1 - k for k, f in enumerate(fallback, len(self.fallback))], np.int64)
        found.insert(0, (number[lacking], number[lacking + 1], weights, pieces))
        edges = np.zeros(count, np.int64)
        for places, *_ in found:
            edges[places] += 1
        first = np.concatenate([[0], np.cumsum(edges)])
        free, total = first[:-1].copy(), int(first[-1])
        target, weight, piece = np.empty(total, np.int32), np.empty(total), np.empty(total, np.int32)
        for places, targets, weights, pieces in found:
            to = free[places]
            free[places] += 1
            target[to], weight[to], piece[to] = targets, weights, pieces
        # Log sums of weights from each place to its word's end, for places ever farther from it.
        beta, chances = np.zeros(count), np.empty(total)
        cuts = np.cumsum(np.bincount(distance)).tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            begin, stop, own = first[a], first[b], edges[a:b]
            value, heads = weight[begin:stop] + beta[target[begin:stop]], first[a:b] - begin
            top = np.maximum.reduceat(value, heads)
            beta[a:b] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, own)), heads))
            chances[begin:stop] = np.minimum(value - np.repeat(beta[a:b], own), 0.0)
        sums = np.cumsum(np.exp(chances))
        sums -= np.repeat(np.concatenate([[0.0], sums])[first[:-1]], edges)
        sums[first[1:][edges > 0] - 1] = 2.0  # the last of a place takes what is left
        places, before = self.sizes["first"], self.sizes["chances"]
        self._append("word_starts", places + number[ends - lengths])
        self._append("first", before + first[:-1])
        self._append("chances", chances)
        self._append("sums", sums)
        self._append("after", np.where(target < len(words), -1, target + places))
        self._append("pieces", piece)
        self._append("place", np.repeat(np.arange(places, places + count), edges))
        self.first[places + count] = before + total
        self.fallback += fallback


def uniform(key: np.ndarray, counter: np.ndarray) -> np.ndarray:
    """Values in (0, 1) that depend on key and counter, a multiple of ``STRIDE``, alone."""
    bits = mix(mix(counter + key) + key)
    return ((bits >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)


def walk(lattice: Lattice, starts: np.ndarray, keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a random way from each start to the end of its word, one after the other; where each walker's begin.

    A walker's values depend on its key and its place among those with the key.
    """
    taken, steps = [], np.zeros(len(starts) + 1, np.int64)
    active, at, key, bits = np.arange(len(starts)), starts, keys, places * STRIDE
    while len(active):
        u = uniform(key, bits + np.array([len(taken) << 36], np.uint64) * STRIDE)
        edge = lattice.first[at]
        ahead = np.flatnonzero(lattice.sums[edge] <= u)
        while len(ahead):
            edge[ahead] += 1
            ahead = ahead[lattice.sums[edge[ahead]] <= u[ahead]]
        taken.append((active, edge))
        at = lattice.after[edge]
        go = np.flatnonzero(at >= 0)
        steps[active] += 1
        active, at, key, bits = active[go], at[go], key[go], bits[go]
    begins = np.concatenate([[0], np.cumsum(steps[:-1])])
    edges = np.empty(begins[-1], np.int32)
    for step, (walker, edge) in enumerate(taken):
        edges[begins[walker] + step] = edge
    return edges, begins


def _cut_gumbel(mass: np.ndarray, limit: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values at log masses, not above the limit."""
    with np.errstate(over="ignore", divide="ignore"):
        return mass - np.log(np.exp(mass - limit) - np.log(u))


class Search:
    """The state of one text: its segmentations so far and the parts that remain."""

    def __init__(self, keys: np.ndarray, value: float, picks: list[float], starts: np.ndarray, samples: int):
        self.keys, self.value, self.picks = keys, value, picks
        self.starts, self.samples = starts, samples
        self.found: list[tuple[np.ndarray, float, float]] = []
        self.sums: list[np.ndarray] = []
        self.parts: list[tuple] = []
        self.head, self.at, self.barred = np.zeros(0, np.int32), 0, ()  # edges before the walk, first step that may differ, barred there
        self.begin, self.done = starts, False

    @property
    def walk_key(self) -> np.uint64:
        return self.keys[self.samples + len(self.found)]

    def take(self, walked: np.ndarray) -> np.ndarray:
        """Takes the walk as the next segmentation; its steps that may differ."""
        edges = np.concatenate([self.head, walked]) if len(self.head) else walked
        self.found.append((edges, 0.0, self.value))
        return edges[self.at :]

    def rest(self, lattice: Lattice) -> float:
        """The log share that the first of these steps leaves, without what is barred there."""
        gone = [*self.barred, int(self.found[-1][0][self.at])]
        place = lattice.place[gone[0]]
        left = 1.0 - math.fsum(np.exp(lattice.chances[gone]).tolist())
        return math.log(left) if left > 1e-12 and lattice.first[place + 1] - lattice.first[place] > len(gone) else -math.inf

    def add(self, own: np.ndarray) -> np.ndarray:
        """Running log probabilities of these steps, from their own."""
        number, sums = len(self.found) - 1, own.copy()
        if self.at:
            sums[0] += self.sums[self.parent][self.at - 1]
        np.cumsum(sums, out=sums)
        self.sums.append(np.concatenate([self.sums[self.parent][: self.at], sums]) if self.at else sums)
        edges, _, value = self.found[number]
        self.found[number] = edges, float(sums[-1]) if len(sums) else 0.0, value
        return sums

    def split(self, lattice: Lattice, falls: np.ndarray) -> None:
        """Queues what first differs at each step from the last segmentation; ``falls`` are the parts' values, negative."""
        number = len(self.found) - 1
        wanted = self.samples - number
        best = np.argpartition(falls, wanted - 1)[:wanted] if len(falls) > wanted else np.arange(len(falls))
        for b, fall in zip(best.tolist(), falls[best].tolist()):
            if fall < math.inf:
                heapq.heappush(self.parts, (fall, number, self.at + b, self.barred if b == 0 else ()))
        self.done = not self.parts or len(self.found) == self.samples
        if not self.done:
            self._next(lattice)

    def _next(self, lattice: Lattice) -> None:
        """Takes the best part: its first new edge, and the places where its walk begins."""
        value, self.parent, self.at, barred = heapq.heappop(self.parts)
        self.value, old = -value, self.found[self.parent][0]
        self.barred = (*barred, int(old[self.at]))
        place = int(lattice.place[old[self.at]])
        options = [e for e in range(int(lattice.first[place]), int(lattice.first[place + 1])) if e not in self.barred]
        weights = list(accumulate(np.exp(lattice.chances[options]).tolist()))
        pick = bisect_left(weights, self.picks[len(self.found)] * weights[-1])
        edge = options[min(pick, len(options) - 1)]
        self.head = np.append(old[: self.at], np.int32(edge))
        # Words after the one that changes start anew; it goes on where the new edge ends.
        following = self.starts[np.count_nonzero(lattice.after[old[: self.at]] < 0) + 1 :]
        self.begin = np.concatenate([[lattice.after[edge]], following]) if lattice.after[edge] >= 0 else following

    @property
    def threshold(self) -> float:
        return -self.parts[0][0] if self.parts else -math.inf


def searches(lattice: Lattice, doc_keys: list[int], samples: int) -> list[Search]:
    """The searches of all texts of a lattice at their begin, with the random values that each text needs once."""
    base = mix(np.array(doc_keys, np.int64).view(np.uint64) * STRIDE + np.uint64(SEED))
    keys = mix(np.arange(1, 2 * samples + 4, dtype=np.uint64) + base[:, None])
    values = uniform(keys[:, -1], np.zeros(1, np.uint64)).tolist()
    picks = uniform(keys[:, samples : 2 * samples], np.array([1 << 51], np.uint64) * STRIDE).tolist()
    parts = [lattice.starts[a:b] for a, b in zip(lattice.bounds[:-1].tolist(), lattice.bounds[1:].tolist())]
    return [Search(k, -math.log(-math.log(v)), p, s, samples) for k, v, p, s in zip(keys, values, picks, parts)]


def sampled(lattice: Lattice, keys: list[int], samples: int) -> list[Search]:
    """The searches of all texts of a lattice, advanced together by one segmentation a round."""
    every = open_ = searches(lattice, keys, samples) if keys else []
    while open_:
        counts = np.array([len(s.begin) for s in open_])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        places = (np.arange(bounds[-1]) - np.repeat(bounds[:-1], counts)).astype(np.uint64)
        walk_keys = np.repeat(np.array([s.walk_key for s in open_], np.uint64), counts)
        edges, begins = walk(lattice, np.concatenate([s.begin for s in open_]), walk_keys, places)
        cuts = begins[bounds].tolist()
        steps = [s.take(edges[a:b]) for s, a, b in zip(open_, cuts[:-1], cuts[1:])]
        # All texts' steps side by side: the log mass of what first differs there, and the largest value in it.
        counts = np.array([len(x) for x in steps])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        cuts = bounds.tolist()
        own = lattice.chances[np.concatenate(steps)]
        with np.errstate(divide="ignore"):
            rest = np.log1p(-np.exp(own))
        for search, a in zip(open_, cuts[:-1]):
            if search.barred:
                rest[a] = search.rest(lattice)
        mass = np.concatenate([s.add(own[a:b]) for s, a, b in zip(open_, cuts[:-1], cuts[1:])]) - own + rest
        per_text = np.array([(s.at, s.value) for s in open_])
        places = np.arange(cuts[-1]) + np.repeat(per_text[:, 0].astype(np.int64) - bounds[:-1] + (1 << 50), counts)
        split_keys = np.repeat(np.array([s.keys[len(s.found) - 1] for s in open_], np.uint64), counts)
        falls = -_cut_gumbel(mass, np.repeat(per_text[:, 1], counts), uniform(split_keys, places.astype(np.uint64) * STRIDE))
        for search, a, b in zip(open_, cuts[:-1], cuts[1:]):
            search.split(lattice, falls[a:b])
        open_ = [s for s in open_ if not s.done]
    return every


@lru_cache(maxsize=2)
def shared_vocabulary(model: str) -> Vocabulary:
    return Vocabulary(model)


def piece_ids(lattice: Lattice, edges: np.ndarray) -> np.ndarray:
    ids = lattice.pieces[edges]
    if len(ids) and ids.min() < 0:
        ids = np.array([x for i in ids.tolist() for x in ([i] if i >= 0 else lattice.fallback[-1 - i])])
    return ids.astype(np.int32)


SEGMENTED = "doc_id long, sample int, ids array<int>, log_prob double, perturbed double, inclusion double"


def segment(model: str, samples: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(shared_vocabulary(model))
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            for row, texts in text_chunks(batch.column("text"), CHUNK):
                keys = docs[row : row + len(texts)]
                found = sampled(lattice.add(texts), [k or 0 for k in keys], samples)
                rows = [(k, n, log_p, value, s.threshold) for k, s in zip(keys, found) for n, (_, log_p, value) in enumerate(s.found)]
                ids = [piece_ids(lattice, edges) for s in found for edges, _, _ in s.found]
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                keys, numbers, log_ps, values, thresholds = zip(*rows)
                inclusion = [1.0 if t == -math.inf else -math.expm1(-math.exp(min(p - t, 700.0))) for p, t in zip(log_ps, thresholds)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()), pa.array(numbers, pa.int32()), pa.ListArray.from_arrays(offsets, np.concatenate(ids)),
                        pa.array(log_ps, pa.float64()), pa.array(values, pa.float64()), pa.array(inclusion, pa.float64()),
                    ],
                    ["doc_id", "sample", "ids", "log_prob", "perturbed", "inclusion"],
                )
    return run


def sample_pieces(docs: DataFrame, samples: int = SAMPLES, model: str = MODEL) -> DataFrame:
    """``SEGMENTED`` rows: up to ``samples`` distinct segmentations of each text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(segment(model, samples), SEGMENTED)


def decoded(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared_vocabulary(model)
        for batch in batches:
            ids = batch.column("ids")
            lengths = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            flat = np.ascontiguousarray(ids.flatten().to_numpy(zero_copy_only=False), "<i4")
            crcs = [crc32(flat[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            own = [batch.column(n) for n in ("doc_id", "sample", "log_prob", "perturbed", "inclusion")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()), vocabulary.decode_all(flat, offsets)],
                ["doc_id", "sample", "log_prob", "perturbed", "inclusion", "n_pieces", "ids_crc32", "text"],
            )
    return run


DECODED = "doc_id long, sample int, log_prob double, perturbed double, inclusion double, n_pieces long, ids_crc32 long, text string"


def decode_pieces(segments: DataFrame, model: str = MODEL) -> DataFrame:
    """The text of every ids row, with the number and checksum of its ids."""
    return segments.mapInArrow(decoded(model), DECODED)


def sampled_texts(docs: DataFrame, samples: int = SAMPLES, model: str = MODEL) -> DataFrame:
    """``decode_pieces`` of ``sample_pieces`` in one pass: the samples never leave the worker that drew them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return decoded(model)(segment(model, samples)(batches))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, DECODED)
