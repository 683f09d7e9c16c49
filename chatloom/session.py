"""Session helpers: defaults for local runs, shared work folders, size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bounds under which a join side may be broadcast. Both are checked on the data
# before the hint is given; beyond them the join stays a shuffle join.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024


def local_session(cpus: str = "*", app: str = "chatloom") -> SparkSession:
    """Session for tests and the local benchmark. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small local inputs with heavy work per row: do not merge them into one task
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` when the cluster names one.

    Only where the setting is absent on a local master (tests) is a temporary folder made and
    registered; a cluster without the setting is an error, never a machine-local folder.
    """
    context = spark.sparkContext
    configured = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="chatloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), "chatloom", f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once as Parquet into the shared folder and read from there: for tables of many rows that several passes read."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Measure rows and serialised bytes of ``df`` in one distributed aggregate.

    Frames that are costly to compute should be cut off with ``cut_lineage`` first, so that they are computed once.
    """
    probe = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.length(F.to_json(F.struct(*df.columns)))), F.lit(0)).alias("b"),
    ).first()
    return probe["n"] <= max_rows and probe["b"] <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint behind a measured bound; otherwise the frame comes back without a hint."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for a table that arrives in fewer pieces than there are cores.

    Worth it where the work per row is much larger than the row. Large inputs have more splits than the cluster has
    cores; they come back untouched and are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
