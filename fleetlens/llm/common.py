"""Small helpers shared by the corpus operators: tables, staging, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens.session import scratch_path

#: Characters of text that one Python step handles at a time; bounds a task's memory, drops nothing.
CHUNK_CHARS = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts lineage: a lost executor re-reads the table instead of redoing the work.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def chunks(batches: Iterator, column: str = "text", limit: int = CHUNK_CHARS) -> Iterator:
    """Slices of the Arrow batches whose texts have at most ``limit`` characters, one row at least."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        first, total = 0, 0
        for i, n in enumerate(sizes):
            if i > first and total + n > limit:
                yield batch.slice(first, i - first)
                first, total = i, 0
            total += n
        if first < batch.num_rows:
            yield batch.slice(first)


def utf8(column: str) -> F.Column:
    return F.coalesce(F.col(column), F.lit(""))
