"""Token counts with a whole-token shortcut.

Offline, every vocabulary string that ends a word is encoded by itself; those that come out
as one token are *whole*. A pre-token that is whole counts one without any merging. The rest
goes through the tokenizer, in batches and with a cache.

Texts are cut at ASCII blanks, which the tokenizer drops, into chunks. ASCII chunks are
lower-cased and pre-tokenized here, by the tokenizer's own pattern; all other chunks, and
those with special strings, are left to the tokenizer as they are.

Defined cases: null text counts as empty: no bytes, no tokens. Every row gets a row, also
when doc_id is null or repeats. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from demandloom.llm.byte_tokens import printable_bytes, tokenizer
from demandloom.llm.words import text_chunks

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
WORD_END = "</w>"
#: Fixed: the ASCII part of the vocabulary's pre-token pattern.
PRE_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
BLANKS = str.maketrans("\t\n\x0b\x0c\r", "     ")
CACHED, CACHED_LENGTH = 300_000, 100  # memory bound of a worker's cache, without influence on results


@lru_cache(maxsize=2)
def whole_tokens(vocabulary: str) -> frozenset[str]:
    """The vocabulary strings that encode alone as one token."""
    code, strings = printable_bytes(), []
    for token in tokenizer(vocabulary).get_vocab(with_added_tokens=False):
        if token.endswith(WORD_END):
            raw = bytes(code[c] for c in token.removesuffix(WORD_END) if c in code)
            strings.append(raw.decode("utf-8", "replace"))
    found = tokenizer(vocabulary).encode_batch(strings, add_special_tokens=False)
    return frozenset(s for s, f in zip(strings, found) if len(f.ids) == 1 and PRE_TOKEN.fullmatch(s))


class Counter:
    def __init__(self, vocabulary: str):
        self.vocabulary, self.whole = vocabulary, whole_tokens(vocabulary)
        self.special = [t.content for t in tokenizer(vocabulary).get_added_tokens_decoder().values()]
        self.chunks: dict[str, int] = {}

    def _by_tokenizer(self, strings: list[str]) -> dict[str, int]:
        fast = getattr(tokenizer(self.vocabulary), "encode_batch_fast", tokenizer(self.vocabulary).encode_batch)
        return {s: len(f.ids) for s, f in zip(strings, fast(strings, add_special_tokens=False))}

    def _learn(self, chunks: set[str]) -> dict[str, int]:
        cut, odd = {}, []
        for chunk in chunks:
            if chunk.isascii() and not any(s in chunk for s in self.special):
                cut[chunk] = PRE_TOKEN.findall(chunk.lower())
            else:
                odd.append(chunk)
        whole = self.whole
        merged = self._by_tokenizer(list({p for pre in cut.values() for p in pre if p not in whole}))
        counts = {chunk: sum([1 if p in whole else merged[p] for p in pre]) for chunk, pre in cut.items()}
        return counts | self._by_tokenizer(odd)

    def __call__(self, texts: list[str]) -> list[int]:
        if len(self.chunks) > CACHED:
            self.chunks = {}
        split = [text.translate(BLANKS).split(" ") for text in texts]
        known = self.chunks
        new = self._learn({c for own in split for c in own if c not in known})
        known.update((c, n) for c, n in new.items() if len(c) <= CACHED_LENGTH)
        return [sum([known[c] if c in known else new[c] for c in own]) for own in split]


def counted(vocabulary: str, limit: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            sizes, tokens = [], []
            for _, texts in text_chunks(batch.column("text")):
                sizes += [len(t.encode("utf-8", "surrogatepass")) for t in texts]
                tokens += counter(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )
    return count


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(counted(vocabulary, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
