"""Incremental ingestion of a landing folder.

Structured Streaming with ``trigger(availableNow=True)`` processes whatever
files arrived since the last run, then stops.  Each micro-batch is cleaned to
the canonical schema and inserted only where its (serial, day) key is new, so
a replayed batch (after a failure) adds nothing twice.  Progress lives in the
checkpoint folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens.functions.dates import partition_month, partition_year
from fleetlens.operators.canonical import date_range, drop_null_keys
from fleetlens.operators.merge import dedupe_by_key, read_if_exists
from fleetlens.session import scratch_path
from fleetlens.sources.csv import read_csv_drift

KEYS = ["serial_number", "date"]


BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def insert_new_rows(batch: DataFrame, target: str, keys: list[str] = KEYS) -> None:
    """Append the rows of a canonical batch whose key is not in the target (idempotent under replay).

    Only a target path that does not exist counts as empty; a target that cannot be read raises.
    """
    spark = batch.sparkSession
    canon = dedupe_by_key(drop_null_keys(batch), keys)
    canon = canon.withColumns({"year": partition_year("date"), "month": partition_month("date")})
    current = read_if_exists(spark, target, canon.schema)
    if current is not None:
        b = canon.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
        if b["lo"] is None:
            return
        # compare only against the target partitions the batch can touch (year/month pruned)
        cur = date_range(current, b["lo"], b["hi"], "date", partition_cols=("year", "month")).select(*keys)
        canon = canon.join(cur, keys, "left_anti")
    canon.write.mode("append").option("compression", "zstd").partitionBy("year", "month").parquet(target)


def ingest_landing(spark: SparkSession, landing: str, target: str, glob: str = "*.csv", checkpoint: str | None = None,
                   max_files_per_trigger: int = 1000) -> None:
    """Process every not-yet-seen landing file once, then stop (availableNow).

    The stream lists files only; each micro-batch, of at most ``max_files_per_trigger``
    files, is read by the drifting-header reader, so a file whose columns come in another
    order or under other names is bound by its own header.
    """
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", glob)
             .option("maxFilesPerTrigger", max_files_per_trigger).load(landing).select("path"))

    def insert(batch: DataFrame, _epoch: int) -> None:
        paths = [r[0] for r in batch.collect()]
        if paths:
            insert_new_rows(read_csv_drift(spark, paths, glob), target)

    q = (files.writeStream.foreachBatch(insert)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "landing-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
