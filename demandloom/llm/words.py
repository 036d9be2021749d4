"""Words, their hashes and sorted groups: what the text operators share inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD_GAP = r"[\x20\x09-\x0D]+"
CHUNK_BYTES = 1 << 20  # of text that a task holds as numbers at once; a longer document comes alone


def split_words(text: str | None) -> list[bytes]:
    """Maximal runs without the six ASCII blanks, as UTF-8; none for null."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit factors from a seed."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed << 20)) | np.uint64(1)


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64."""

    def __init__(self, base: int):
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            one = np.ones(1, np.uint64)
            self.up = np.cumprod(np.concatenate([one, np.full(count, self.base)]))
            self.down = np.cumprod(np.concatenate([one, np.full(count, self.inverse)]))
        return self.up, self.down


def stretch_names(values: np.ndarray, powers: Powers, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit name of every stretch of values, equal for equal stretches wherever they are."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
BYTE_POWERS = Powers(0xD1342543DE82EF95), Powers(0xAF251AF3B0F025B5)
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64)), mix(np.arange(1001, 1257, dtype=np.uint64))


class Words:
    """The words of several texts side by side: places in ``data``, and the text of each."""

    def __init__(self, texts: list[str | None]):
        parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.data = b"\n".join([*parts, b""])
        self.bytes = np.frombuffer(self.data, np.uint8)
        inside = ~BLANK[self.bytes]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edges = np.concatenate([[0], edges])
        self.begin, self.end = edges[::2], edges[1::2]
        self.text_begin = np.cumsum([0] + [len(p) + 1 for p in parts])[:-1]
        bounds = np.searchsorted(self.begin, np.append(self.text_begin, len(self.data)))
        self.first, self.counts = bounds[:-1], np.diff(bounds)

    def names(self, stream: int = 0) -> np.ndarray:
        """A 64-bit hash of every word; the streams are independent."""
        return stretch_names(BYTE_VALUES[stream][self.bytes], BYTE_POWERS[stream], self.begin, self.end)


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of consecutive pieces of a column, each of about ``most`` characters."""
    texts, size, first = [], 0, 0
    for row in range(len(column)):
        text = column[row].as_py()
        texts.append(text)
        size += len(text) if text else 0
        if size >= most:
            yield first, texts
            texts, size, first = [], 0, row + 1
    if texts:
        yield first, texts


def window_names(hashes: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A 64-bit name of every window of ``width`` consecutive words."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k, factor in enumerate(multipliers(width, seed)):
        total += hashes[k : k + count] * factor
    return mix(total)


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of rows with equal keys, of batches that arrive sorted by them."""
    held: list[pa.Table] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        first = tuple(column[0] for column in columns)
        if held and first != last:
            yield pa.concat_tables(held)
            held = []
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for start, stop in zip(cuts[:-1], cuts[1:]):
            if start:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(start, stop - start))
        last = tuple(column[-1] for column in columns)
    if held:
        yield pa.concat_tables(held)


def array_column(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """Consecutive stretches of ``values`` as one list per row; null for no value."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array(counts == 0))
