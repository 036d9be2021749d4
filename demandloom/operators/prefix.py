"""Running totals over groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from demandloom.sources.storage import freeze


def running_totals(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], values: dict[str, Column],
    chunks: int | None = None,
) -> DataFrame:
    """Adds ``before_<name>``: the total of each value over the rows that precede in the group.

    A plain window would sort a whole group in one task. Here rows are range-partitioned
    by (group, order), so a group spans as many chunks as its share of the rows; chunk
    totals (one row per group and chunk) give each chunk its starting value, and only
    the rows of one chunk are sorted together. The placement is checkpointed because
    chunk numbers must be the same in both reads of it.
    """
    spark = df.sparkSession
    chunks = chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = freeze(
        df.repartitionByRange(chunks, *[F.col(g) for g in groups], *order)
        .withColumn("chunk", F.spark_partition_id())
    )
    earlier = Window.partitionBy(*groups).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(*groups, "chunk").agg(
        *[F.sum(value).alias(f"chunk_{name}") for name, value in values.items()]
    ).select(*groups, "chunk", *[
        F.coalesce(F.sum(f"chunk_{name}").over(earlier), F.lit(0)).alias(f"offset_{name}") for name in values
    ])
    within = Window.partitionBy(*groups, "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(offsets, [*groups, "chunk"]).select(*df.columns, *[
        (F.col(f"offset_{name}") + F.coalesce(F.sum(value).over(within), F.lit(0))).alias(f"before_{name}")
        for name, value in values.items()
    ])
