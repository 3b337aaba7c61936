"""Session helpers: defaults that matter for correctness, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on.  Day logic is UTC; AQE re-plans joins and
# coalesces shuffle partitions at runtime; ANSI stays on (dirty input goes
# through try_* casts).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # partition columns such as month='01' must stay text (hazard H4)
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the JVM never compiles a method of more bytecode: wide projections are cut into smaller ones instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # DROPMALFORMED must drop short/long CSV rows even when only some columns are read (hazard H3)
    "spark.sql.csv.parser.columnPruning.enabled": "false",
}


def get_spark(master: str | None = None, app_name: str = "fleetlens",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session (or build one) with the library defaults applied."""
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (a shared file system); without it a
    cluster run stops, since a folder of one machine would be wrong there.  Only a local
    master (tests) without a setting takes a fresh temporary folder and registers it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not root and (not master.startswith("local") or master.startswith("local-cluster")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="fleetlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder (snapshots, staged files)."""
    return f"{checkpoint_root(spark)}/fleetlens/{name}-{uuid.uuid4().hex[:12]}"


def recommended_partitions(input_bytes: int, total_cores: int, shuffle_fraction: float = 0.3,
                           target_partition_bytes: int = 256 << 20, split_bytes: int = 512 << 20) -> dict:
    """Sizing for a run over ``input_bytes`` of Parquet on ``total_cores`` executor cores.

    Returns settings to apply at submit time (nothing is changed here):
    ``spark.sql.files.maxPartitionBytes`` keeps scan tasks few but memory-safe, and
    ``spark.sql.shuffle.partitions`` puts about ``target_partition_bytes`` of the
    (projected, pre-aggregated) shuffle into each reduce task while giving every
    core at least a few waves of the CPU-bound window stage.
    """
    shuffle_bytes = max(1, int(input_bytes * shuffle_fraction))
    by_size = -(-shuffle_bytes // target_partition_bytes)
    partitions = max(3 * total_cores, by_size)
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(int(partitions)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
    }
