"""Where intermediate results live, and session defaults.

Results that several plans reuse are written once as Parquet under the shared
folder the cluster names in ``spark.checkpoint.dir``: they survive the loss of an
executor, keep column pruning, and give the optimizer true sizes to choose joins by.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("demandloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Checkpoint folder of the session; a scratch folder only for a local master."""
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="demandloom-")
        context.setCheckpointDir(folder)
    return folder


def stage_path(spark: SparkSession, name: str) -> str:
    base = (spark.conf.get("spark.checkpoint.dir", None) or shared_folder(spark)).rstrip("/")
    return f"{base}/demandloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:8]}"


@dataclass(frozen=True)
class Layout:
    """Buckets of a written stage by hash of ``keys``, within folders by ``partition`` if it is named.

    Tables with the same keys and number of buckets are joined, grouped and windowed by them without an
    exchange, and a filter on ``partition`` reads its folders only. Deal the rows by ``deal`` before, so
    that a task writes one bucket and not a file for each.
    """

    keys: Sequence[str]
    buckets: int
    order: Sequence[str] = ()
    partition: str | None = None

    def deal(self, df: DataFrame) -> DataFrame:
        return df.repartition(self.buckets, *self.keys)


def materialise(df: DataFrame, name: str, layout: Layout | None = None) -> DataFrame:
    """Write a stage result to the shared folder and continue from the written table.

    With a layout it becomes a table of the session's catalog, whose files are in the shared folder
    all the same; ``drop_tables`` takes it out of the catalog.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    if layout is None:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    table = f"{_table_prefix(spark)}{name}_{uuid.uuid4().hex[:8]}"
    writer = df.write.format("parquet").option("path", path).bucketBy(layout.buckets, *layout.keys)
    if layout.order:
        writer = writer.sortBy(*layout.order)
    if layout.partition:
        writer = writer.partitionBy(layout.partition)
    writer.saveAsTable(table)
    return spark.table(table)


def _table_prefix(spark: SparkSession) -> str:
    application = "".join(c if c.isalnum() else "_" for c in spark.sparkContext.applicationId)
    return f"demandloom_{application}_".lower()


def drop_tables(spark: SparkSession, only: Sequence[str] | None = None) -> None:
    """Take stage tables of this application, all or some, out of the catalog; their files stay."""
    for table in spark.catalog.listTables(pattern=f"{_table_prefix(spark)}*"):
        if only is None or table.name in only:
            spark.sql(f"DROP TABLE IF EXISTS {table.name}")


def freeze(df: DataFrame) -> DataFrame:
    """Cut the lineage of a loop state."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
