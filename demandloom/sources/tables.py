"""Scans, sinks and the manifest of written tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

DIM_ITEMS = _fields(("item_id", _S), ("dept_id", _S), ("cat_id", _S))
DIM_STORES = _fields(("store_id", _S), ("state_id", _S))
FACT_SALES = _fields(("item_id", _S), ("store_id", _S), ("day_id", _S), ("units_sold", _L))
FACT_PRICES = _fields(("store_id", _S), ("item_id", _S), ("wm_yr_wk", _I), ("sell_price", _D))
RAW_CALENDAR = _fields(
    ("date", T.DateType()), ("wm_yr_wk", _I), ("weekday", _S), ("wday", _I), ("month", _I),
    ("year", _I), ("d", _S), ("event_name_1", _S), ("event_type_1", _S),
    ("event_name_2", _S), ("event_type_2", _S),
)


def scan_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A named table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan_filtered(
    spark: SparkSession, folder: str, name: str, columns: Sequence[str], predicate: Column | None = None
) -> DataFrame:
    """Named columns of the rows that satisfy a predicate; both reach the scan."""
    rows = scan_table(spark, folder, name)
    return (rows if predicate is None else rows.filter(predicate)).select(*columns)


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str] | None = None
) -> DataFrame:
    """Headered CSV with declared types; ISO dates."""
    rows = (
        spark.read.schema(schema).option("header", True).option("enforceSchema", False)
        .option("dateFormat", "yyyy-MM-dd").option("mode", "FAILFAST").csv(path)
    )
    return rows.select(*columns) if columns else rows


def write_table(
    df: DataFrame, path: str, format: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Write a result; CSV gets a header and ISO dates."""
    writer = df.write.mode("overwrite").format(format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if format == "csv":
        writer = writer.option("header", True).option("dateFormat", "yyyy-MM-dd")
    writer.save(path)


STAR_ORDER = ["dim_items", "dim_stores", "dim_calendar", "fact_sales", "fact_prices"]


def load_star_schema(tables: dict[str, DataFrame], path: str) -> dict[str, DataFrame]:
    """Write the five tables, dimensions first, and register each as a view.

    Facts are partitioned by store, so a store filter prunes files. There is no shuffle
    by store before the write: every task writes the stores it holds, so a store with a
    third of the rows still has many writers.
    """
    loaded = {}
    for name in STAR_ORDER:
        df = tables[name]
        target = f"{path}/{name}"
        write_table(df, target, partition_by=["store_id"] if name.startswith("fact_") else ())
        read = df.sparkSession.read.schema(df.schema).parquet(target).select(*df.columns)
        read.createOrReplaceTempView(name)
        loaded[name] = read
    return loaded


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, row_count: one partial count per table, one union."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return _union(parts)


def export_manifest(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per exported table: file, name, rows, columns, grain."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(f"{name}.csv").alias("file_name"),
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).alias("column_count"),
            F.lit(grain).alias("grain"),
        )
        for name, (df, grain) in tables.items()
    ]
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
