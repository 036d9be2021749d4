"""Distributed LSD radix sort: global places of rows under a composite key.

The key is a list of long columns, most significant first. Passes go over the digits of
``DIGIT_BITS`` bits that vary at all, from the least significant on. A pass is a stable
counting sort: rows lie in blocks of ``BLOCK`` consecutive places; a block counts its rows of
every digit; prefix sums over (digit, block) say where each block's rows of a digit begin; the
rank inside block and digit gives the rest of the destination.

No key, digit or block gathers rows without bound: a task gets (block, digit) groups of at
most ``BLOCK`` rows whatever the key values are, and the sums over blocks see one row per
block and digit. Every pass is written and read back, so a lost executor repeats one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window

from demandloom.sources.storage import materialise

DIGIT_BITS = 10
BLOCK_BITS = 12
LONGEST = (1 << 63) - 1


def _digits(rows: DataFrame, keys: list[str]) -> list[tuple]:
    """(column of the digit) of every digit that can differ, least significant first."""
    ends = rows.agg(*[f(k).alias(f"{n}_{k}") for k in keys for n, f in (("least", F.min), ("most", F.max))]).first()
    digits = []
    for key in reversed(keys):
        least, most = ends[f"least_{key}"], ends[f"most_{key}"]
        if least is None:
            continue
        if most - least <= LONGEST:
            value, bits = F.col(key) - F.lit(least), (most - least).bit_length()
        else:  # the difference passes a long: flip the sign bit and read the bits unsigned
            value, bits = F.col(key).bitwiseXOR(F.lit(-LONGEST - 1)), 64
        for low in range(0, bits, DIGIT_BITS):
            digits.append(F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("int"))
    return digits


def radix_places(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``place``: 0, 1, 2... in ascending order of the keys.

    ``rows`` are read once per pass, so they should be a written table. Rows with equal keys
    keep the order in which they were read; no key may be null.
    """
    columns = rows.columns
    digits = _digits(rows, keys)
    state = materialise(rows.withColumn("place", F.monotonically_increasing_id()), "radix-start")
    # Without a digit that differs, one pass over an equal digit still makes places gapless.
    for number, digit in enumerate(digits or [F.lit(0)]):
        dealt = state.withColumn("block", F.shiftright("place", BLOCK_BITS)).withColumn("digit", digit)
        counts = dealt.groupBy("block", "digit").agg(F.count(F.lit(1)).alias("own"))
        totals = counts.groupBy("digit").agg(F.sum("own").alias("total"))  # at most 2^DIGIT_BITS rows
        before = Window.rowsBetween(Window.unboundedPreceding, -1)
        begins = totals.select("digit", F.coalesce(F.sum("total").over(before.orderBy("digit")), F.lit(0)).alias("begin"))
        earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select("block", "digit", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("prior")).join(begins, "digit")
        inside = F.row_number().over(Window.partitionBy("block", "digit").orderBy("place")) - 1
        moved = dealt.withColumn("inside", inside).join(offsets.select("block", "digit", (F.col("begin") + F.col("prior")).alias("offset")), ["block", "digit"])
        state = materialise(moved.select(*columns, (F.col("offset") + F.col("inside")).alias("place")), f"radix-{number}")
    return state
