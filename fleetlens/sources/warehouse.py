"""Partitioned Parquet warehouse: write (K1, K2, K7) and scan with pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F, types as T

from fleetlens.functions.dates import partition_month, partition_year
from fleetlens.operators.canonical import date_range
from fleetlens.schema import WAREHOUSE_SCHEMA


#: Bytes of a row group of tables that are read by drive: small enough that a point read skips most of a file.
POINT_ROW_GROUP = 8 << 20
#: Drives that a row group's Bloom filter is laid out for; a row group holds no more rows than that by far.
POINT_DRIVES = 100_000


def for_point_reads(writer: DataFrameWriter, column: str, row_group: int = POINT_ROW_GROUP, values: int = POINT_DRIVES) -> DataFrameWriter:
    """A writer whose Parquet files can be read by one value of ``column`` without reading the rest.

    Rows sorted by the column give row groups and pages narrow ranges; a Bloom filter per row
    group says no where a range can't (a drive that a day lacks).  Readers need nothing but an
    equality filter on the column.
    """
    return (writer.option("parquet.block.size", str(row_group)).option(f"parquet.bloom.filter.enabled#{column}", "true")
            .option(f"parquet.bloom.filter.expected.ndv#{column}", str(values)))


def write_partitioned(df: DataFrame, path: str, mode: str = "append", date_col: str = "date",
                      dynamic_overwrite: bool = True, compression: str = "zstd") -> None:
    """Write ZSTD Parquet partitioned by year, month.

    Rows are rebalanced by (year, month) first: small months share tasks, and a month that is
    larger than the advisory partition size is split over several tasks and files.  ``mode='overwrite'`` with ``dynamic_overwrite`` only
    replaces the partitions present in ``df`` (a static overwrite is the clean rebuild).
    """
    out = df.withColumns({"year": partition_year(date_col), "month": partition_month(date_col)})
    out = out.hint("rebalance", "year", "month")
    w = out.write.mode(mode).option("compression", compression).partitionBy("year", "month")
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic" if dynamic_overwrite else "static")
    w.parquet(path)


def scan_warehouse(spark: SparkSession, root: str, start=None, end=None, date_col: str = "date",
                   schema: T.StructType = WAREHOUSE_SCHEMA) -> DataFrame:
    """Read the columns of ``schema`` by name; a file that lacks one gives nulls.

    The schema is given, so no footer is opened before pruning.  An optional inclusive day
    range also prunes year/month directories.  Partition values stay text ('01') and
    ``year`` is cast to int.
    """
    data = T.StructType([f for f in schema.fields if f.name not in ("year", "month")])
    df = spark.read.schema(data).parquet(root)
    if "year" in df.columns:
        df = df.withColumn("year", F.col("year").cast("int"))
    if start is not None and end is not None:
        df = date_range(df, start, end, date_col, partition_cols=("year", "month"))
    return df


def load_telemetry(df: DataFrame, path: str, clear: bool = True) -> None:
    """Bulk load application telemetry partitioned by day, sorted by drive within files.

    The sort leads with the partition column: the writer wants its rows by partition and
    would sort again, by day alone, if they came otherwise.  Files are laid out for reads of
    one drive (``for_point_reads``).  ``clear=True`` replaces the table
    (what a fresh backfill does); otherwise append.
    """
    writer = (df.hint("rebalance", "day").sortWithinPartitions("day", "drive_id")
              .write.mode("overwrite" if clear else "append").option("compression", "zstd"))
    for_point_reads(writer, "drive_id").partitionBy("day").parquet(path)


def write_by_drive(df: DataFrame, path: str, key: str = "drive_id", files: int | None = None, row_group: int = POINT_ROW_GROUP) -> None:
    """A table that is read by drive (drives, histories), in ranges of the key: a point read opens one file.

    Each file has a range of keys, each row group in it a narrower one.  A key with very many
    rows may fill several files; its rows stay in order of the key only.
    """
    placed = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    writer = placed.sortWithinPartitions(key).write.mode("overwrite").option("compression", "zstd")
    for_point_reads(writer, key, row_group).parquet(path)
