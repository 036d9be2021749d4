"""Mixture-controlled packing: deficit round-robin over source queues.

Each source is a queue of its documents, in reading order. In every window each source earns
a quantum, ``WINDOW_TOKENS`` times its target share, on top of what it did not use before
(its deficit). It then serves packets, documents or stretches of ``SEQUENCE`` tokens of long
ones, while its deficit covers them. As deficits are never reset, the packet that ends at
token e of its queue is served in window ceil(e / quantum): all windows of all partitions are
planned at once from running totals, and after any window a source is behind its share by
less than one packet.

The windows' packets follow each other as one stream of tokens, cut into sequences of
``SEQUENCE`` tokens. Only the last sequence of all is not full. Default targets are the
sources' own shares of tokens, so that all queues end together; with other targets a window
holds less once a queue is empty, and nothing is dropped.

Ids are written once and read back for the checksums of the pieces, so no text is encoded
twice. No step collects a source or a window: totals run over range partitions.

Defined cases: null text counts as empty, and an empty document has one token, the end.
Every row is packed, also when doc_id is null or repeats; null sources are one queue; a
table without the source column is one queue. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from demandloom.llm.byte_tokens import token_ids
from demandloom.operators.prefix import running_totals
from demandloom.sources.storage import materialise

VOCABULARY = "byte_bpe_50k.json"
END = 1
SEQUENCE = 2048
WINDOW_TOKENS = 64 * SEQUENCE

TOKENS = "row long, doc_id long, source string, doc_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def encoded(vocabulary: str):
    """Adds ids (unsigned 32-bit little-endian, or 16-bit if all fit) with the end id."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, ids = [], []
            for text in batch.column("text"):
                found = np.append(token_ids(vocabulary, text.as_py()), END)
                counts.append(len(found))
                ids.append(found.astype("<u2" if found.max() < 1 << 16 else "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("source"), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                ["row", "doc_id", "source", "doc_tokens", "ids"],
            )
    return encode


def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of each document with the checksum of their ids."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    for batch in batches:
        out = {name: [] for name in names}
        for row in batch.to_pylist():
            wide = len(row["ids"]) // row["doc_tokens"]
            ids = np.frombuffer(row["ids"], f"<u{wide}").astype("<u4")
            for piece in row["pieces"]:
                start, length = piece["start"], piece["length"]
                values = (row["doc_id"], start, length, crc32(ids[start : start + length].tobytes()), row["doc_tokens"], piece["sequence_id"], piece["offset"])
                for name, value in zip(names, values):
                    out[name].append(value)
        yield pa.RecordBatch.from_pydict(out, pa.schema([(name, pa.int64()) for name in names]))


def planned(sizes: DataFrame, targets: Mapping[str, int] | None = None) -> DataFrame:
    """row, start, length, window, sequence_id, offset of all pieces of rows (row, source, doc_tokens).

    ``targets`` gives each source an integer weight of at least 1, others raise a ValueError;
    sources that it lacks have weight 1.
    """
    if targets is not None and any(int(weight) < 1 for weight in targets.values()):
        raise ValueError("weights of sources start at 1")
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum("doc_tokens").alias("weight"))
    if targets is not None:
        given = spark.createDataFrame([(str(k), int(v)) for k, v in targets.items()], "source string, given long")
        totals = totals.join(given, "source", "left").select("source", F.coalesce("given", F.lit(1)).alias("weight"))
    totals = materialise(totals, "packing-weights")
    all_weights = totals.agg(F.sum(F.col("weight").cast("decimal(38,0)")).alias("all_weights"))
    queued = running_totals(sizes, ["source"], [F.col("row")], {"queue": F.col("doc_tokens")}).join(totals, "source").crossJoin(all_weights)
    last = F.floor((F.col("doc_tokens") - 1) / SEQUENCE)
    packets = queued.withColumn("packet", F.explode(F.sequence(F.lit(0).cast("long"), last))).withColumn("start", F.col("packet") * SEQUENCE)
    packets = packets.withColumn("length", F.least(F.lit(SEQUENCE).cast("long"), F.col("doc_tokens") - F.col("start")))
    windows = packets.withColumn("window", F.expr(
        f"(cast(before_queue + start + length as decimal(20,0)) * all_weights + cast(weight as decimal(20,0)) * {WINDOW_TOKENS} - 1)"
        f" div (cast(weight as decimal(20,0)) * {WINDOW_TOKENS})"
    ))
    stream = running_totals(
        windows.select("row", "source", "start", "length", "window"), [],
        [F.col("window"), F.col("source"), F.col("row"), F.col("start")], {"stream": F.col("length")},
    )
    at = F.col("before_stream")
    cuts = stream.withColumn("sequence_id", F.explode(F.sequence(F.floor(at / SEQUENCE), F.floor((at + F.col("length") - 1) / SEQUENCE))))
    begin = F.greatest(at, F.col("sequence_id") * SEQUENCE)
    end = F.least(at + F.col("length"), (F.col("sequence_id") + 1) * SEQUENCE)
    return cuts.select(
        "row", (F.col("start") + begin - at).alias("start"), (end - begin).alias("length"), "window",
        "sequence_id", (begin - F.col("sequence_id") * SEQUENCE).alias("offset"),
    )


def pack(docs: DataFrame, source: str = "source", vocabulary: str = VOCABULARY, targets: Mapping[str, int] | None = None) -> DataFrame:
    """``PIECES`` rows: where every token of every document lies."""
    queue = F.coalesce(F.col(source).cast("string"), F.lit("")) if source in docs.columns else F.lit("")
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), queue.alias("source"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    tokens = materialise(texts.mapInArrow(encoded(vocabulary), TOKENS), "packing-tokens")
    pieces = planned(tokens.select("row", "source", "doc_tokens"), targets).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("pieces")
    )
    return tokens.select("row", "doc_id", "doc_tokens", "ids").join(pieces, "row").mapInArrow(checked, PIECES)
