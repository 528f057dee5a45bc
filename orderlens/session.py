"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int | str = "*", app: str = "orderlens") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        # Small files on one machine: cut them finer so that every core reads.
        .config("spark.sql.files.openCostInBytes", str(1 << 20))
        # No Python call site is recorded per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def cluster_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Session settings for a cluster, sized by the bytes a job reads.

    Shuffles start with enough partitions that one holds about 128 MB even before
    compression of the shuffled columns helps; adaptive execution merges those that
    turn out small and splits skewed ones.
    """
    mb = 1 << 20
    partitions = max(2 * cores, -(-input_bytes // (128 * mb)))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * mb),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * mb),
        # Split a hot key even where the step after the join then needs its own shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * mb),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * mb),
    }


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is empty only a local master may fall back to a temporary
    folder; a cluster without it is a configuration error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    fallback = tempfile.mkdtemp(prefix="orderlens-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def settle(df: DataFrame) -> DataFrame:
    """Compute a reused aggregate once and cut its lineage with a reliable checkpoint."""
    return settle_counted(df)[0]


def settle_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """The settled frame and its row count, observed while it is written."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    seen = Observation()
    kept = df.observe(seen, F.count(F.lit(1)).alias("rows")).checkpoint(eager=True)
    return kept, seen.get["rows"]
