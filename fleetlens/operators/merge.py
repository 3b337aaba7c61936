"""Keyed merges on immutable snapshots.

Parquet has no MERGE: every operator here returns the merged table as a new
DataFrame; ``write_snapshot`` writes it to a fresh path under the shared
checkpoint folder and the caller repoints to it.  The table being read is
never overwritten in place.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fleetlens.session import scratch_path


def dedupe_by_key(df: DataFrame, keys: list[str], prefer: str = "min", order: list[str] | None = None) -> DataFrame:
    """One row per key: the least or greatest by ``order``, then by the remaining columns.

    An aggregate, so duplicates are combined map-side before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    first = [c for c in order or [] if c in rest]
    pick = F.min if prefer == "min" else F.max
    g = df.groupBy(*keys).agg(pick(F.struct(*first, *[c for c in rest if c not in first])).alias("_r"))
    return g.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def _without(current: DataFrame, keyed: DataFrame, keys: list[str]) -> DataFrame:
    named = keyed.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)])
    on = current[keys[0]].eqNullSafe(named["_key0"])
    for i, k in enumerate(keys[1:], 1):
        on = on & current[k].eqNullSafe(named[f"_key{i}"])
    return current.join(named, on, "left_anti")


def merge_by_key(current: DataFrame, incoming: DataFrame, keys: list[str], dedupe: bool = True,
                 order: list[str] | None = None) -> DataFrame:
    """Upsert: incoming rows replace current rows with the same key; other current rows stay.

    ``incoming u (current left_anti incoming)``, by the columns of ``current``: one that the
    incoming rows lack is null in them.  Duplicate incoming keys collapse to one row, the
    greatest by ``order`` (e.g. ``scored_at``) and then by the remaining columns; that keyed
    aggregate's partitioning is reused by the anti join.  A null key part is a value.
    """
    inc = by_schema(incoming, current.schema)
    if dedupe:
        inc = dedupe_by_key(inc, keys, prefer="max", order=order)
    return inc.unionByName(_without(current, inc, keys))


def by_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order; those that ``df`` lacks are null."""
    have = {c.lower() for c in df.columns}
    return df.select(*[F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def insert_if_absent(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Append incoming rows whose key is new (duplicates inside ``incoming`` collapse to one row; a null part is a value)."""
    new = _without(dedupe_by_key(incoming.select(*current.columns), keys), current, keys)
    return current.unionByName(new)


def merge_drives(current: DataFrame, incoming: DataFrame, key: str = "drive_id") -> DataFrame:
    """Drive upsert: model and datacenter from the incoming row, capacity kept when the new one
    is null, first_seen = least, last_seen = greatest (nulls skipped).

    Incoming rows of one drive are folded first: model and datacenter of the row seen last
    (then the greatest of them), the greatest capacity, the whole span of days; so the result
    has one row per key.  A null key takes no part and stays as it is.
    """
    named = incoming.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.max(F.struct("last_seen", "model", "datacenter")).alias("_last"), F.max("capacity_bytes").alias("capacity_bytes"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    n = named.select(key, "_last.model", "capacity_bytes", "_last.datacenter", "first_seen", "last_seen").alias("n")
    c = current.alias("c")
    j = c.join(n, F.col(f"c.{key}") == F.col(f"n.{key}"), "full_outer")
    has_new = F.col(f"n.{key}").isNotNull()

    def pick_new(col: str):
        return F.when(has_new, F.col(f"n.{col}")).otherwise(F.col(f"c.{col}"))

    return j.select(
        F.coalesce(F.col(f"n.{key}"), F.col(f"c.{key}")).alias(key),
        pick_new("model").alias("model"),
        F.coalesce(F.col("n.capacity_bytes"), F.col("c.capacity_bytes")).alias("capacity_bytes"),
        pick_new("datacenter").alias("datacenter"),
        F.least(F.col("c.first_seen"), F.col("n.first_seen")).alias("first_seen"),
        F.greatest(F.col("c.last_seen"), F.col("n.last_seen")).alias("last_seen"),
    )


def merge_latest(current: DataFrame | None, incoming: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order`` (then by the remaining columns) of both tables.

    A maximum, combined map-side: the order in which batches arrive and their repetition don't
    matter.  A null key is a value; nulls in ``order`` are least.
    """
    both = incoming if current is None else current.unionByName(incoming.select(*current.columns))
    return dedupe_by_key(both, [key], prefer="max", order=order)


def write_snapshot(df: DataFrame, name: str, path: str | None = None, partition_by: list[str] | None = None,
                   compression: str = "zstd") -> str:
    """Write ``df`` to a new snapshot path (default: under spark.checkpoint.dir) and return the path."""
    target = path or scratch_path(df.sparkSession, name)
    w = df.write.mode("errorifexists").option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target)
    return target


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The Parquet table at ``path`` (by its own schema if none is given), or None only if there is no such path.
    Any other failure is raised.

    The path is listed when the reader is made, so the answer does not depend on a later action.
    """
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def upsert_partitions(incoming: DataFrame, table_path: str, keys: list[str], partition_col: str = "day",
                      compression: str = "zstd", order: list[str] | None = None) -> int:
    """Upsert into a Parquet table partitioned by ``partition_col``, rewriting only touched partitions.

    1. the partition values ``incoming`` touches (one per day: small) bound the read of the
       current table, so only those directories are scanned;
    2. the merged slice is written to a staging snapshot under ``spark.checkpoint.dir``
       (this cuts the lineage to the files about to be replaced);
    3. the staged slice replaces exactly those partitions (dynamic partition overwrite).

    The table is read by its own columns, so those that ``incoming`` lacks stay in its other rows
    (and are null in the incoming ones); a column that the table lacks raises.  Duplicate incoming keys collapse as in
    ``merge_by_key``.  Only a path that does not exist is an empty table: a table that
    cannot be read raises, and nothing is overwritten.  Returns the number of partitions
    rewritten.  Re-running with the same input is a no-op in content (the merge is keyed).
    """
    spark = incoming.sparkSession
    touched = [r[0] for r in incoming.select(partition_col).distinct().collect()]
    if not touched:
        return 0
    current = read_if_exists(spark, table_path)
    if current is not None:
        have = {c.lower() for c in current.columns}
        unknown = [c for c in incoming.columns if c.lower() not in have]
        if unknown:
            raise ValueError(f"the table has no columns {', '.join(unknown)}")
        kind = incoming.schema[partition_col].dataType
        current = current.withColumn(partition_col, F.col(partition_col).cast(kind))
    if current is None:
        merged = dedupe_by_key(incoming, keys, prefer="max", order=order)
    else:
        same = F.col(partition_col).isin([v for v in touched if v is not None])
        slice_ = current.where(same | F.col(partition_col).isNull() if None in touched else same)
        merged = merge_by_key(slice_, incoming, keys, order=order)
    staged = write_snapshot(merged, "upsert-stage", partition_by=[partition_col], compression=compression)
    (spark.read.schema(merged.schema).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", compression).partitionBy(partition_col).parquet(table_path))
    return len(touched)
