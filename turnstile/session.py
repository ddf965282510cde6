"""Session helpers: build a session for tests/bench, find the shared checkpoint
folder, and a size-checked broadcast decision used by every helper join."""

from __future__ import annotations

import math
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes a side may have before we stop broadcasting it.  Every small side in
# this library is an aggregate (modes per group, dictionary entries, offsets),
# so measuring it is one pass over an already-reduced table.
BROADCAST_MAX_BYTES = 64 << 20
# Per row and per fixed-width value of a broadcast table, about.
ROW_BYTES, VALUE_BYTES = 32, 8


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "turnstile") -> SparkSession:
    """Session for tests and the bench harness (local mode)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir`` (or an earlier
    ``setCheckpointDir``).  Only a local-mode session may fall back to a fresh
    temporary folder; on a cluster a machine-local folder would be lost with
    the executor, so we refuse instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/...) so iterative operators can cut lineage reliably")
    folder = tempfile.mkdtemp(prefix="turnstile-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (never localCheckpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fit_partitions(df: DataFrame, n_rows: int, rows_per_partition: int,
                   per_core: int = 1) -> DataFrame:
    """Raise the number of partitions to the work per row before iterative jobs.

    Aim at ``ceil(n_rows / rows_per_partition)`` partitions, at most
    ``per_core`` x the cluster's default parallelism.  A frame that has as many
    is left as it is; partitions are never merged (adaptive execution does that
    by size).

    Call it on a checkpointed, cached or scan-and-project frame: counting the
    partitions of a plan with pending shuffles makes AQE run those stages.
    """
    cap = df.sparkSession.sparkContext.defaultParallelism * per_core
    wanted = max(1, min(cap, math.ceil(max(n_rows, 1) / rows_per_partition)))
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def measured_bytes(df: DataFrame) -> int:
    """About how many bytes ``df`` takes in memory: one aggregate."""
    width = F.lit(ROW_BYTES)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(c), F.lit(0)) + VALUE_BYTES
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            width = width + VALUE_BYTES
    return df.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def maybe_broadcast(small: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``small`` only if its measured size is within ``max_bytes``.

    Otherwise return it unchanged so Spark plans a shuffle join (AQE may still
    demote it to a broadcast at runtime from measured stage sizes, and splits
    skewed partitions of the large side).
    """
    return F.broadcast(small) if measured_bytes(small) <= max_bytes else small
