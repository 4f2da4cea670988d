"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE re-plans from real sizes: it coalesces small shuffle partitions, broadcasts a side only
# below the threshold, and splits the partitions of a hot join key even if that costs a shuffle.
# Narrow rows compress to some 15 bytes, and a task that joins and folds them holds 20 to 30 times that: 16 MB of a
# shuffle, not Spark's 64, are what a task can take in.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
    # recording the Python call site of every column expression doubles the time to build a plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def initial_partitions(input_bytes: int) -> int:
    """Shuffle partitions to start from: AQE merges small ones but cannot split large ones.

    The widest shuffles move about as many bytes as the input has, so 32 MiB of input a partition; at most
    100 000, beyond which the bookkeeping of a shuffle costs more than smaller partitions save.
    """
    return min(100_000, max(200, input_bytes // (32 << 20)))


def build_session(
    app: str = "martlet", master: str | None = None, input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with the library's settings; ``input_bytes`` sizes its shuffles."""
    settings = dict(SETTINGS)
    if input_bytes is not None:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(
            initial_partitions(input_bytes)
        )
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**settings, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def fit_joins(spark: SparkSession) -> None:
    """Lets AQE split a hot join key also below an aggregate on the same key, and merge partitions to no more than a task can hold.

    Set in sessions that were not built here too, because the joins count on it. The first acts only on
    partitions that AQE finds skewed; the second leaves a size that the session was given.
    """
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if spark.conf.get(size, None) is None:
        spark.conf.set(size, SETTINGS[size])


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir`` (shared by all executors).

    The folders of an application share a parent named after it, which may go when it has ended.
    Only a local session may go without the setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="martlet-")
    application = spark.sparkContext.applicationId
    return f"{base.rstrip('/')}/martlet/{application}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``checkpoint()`` at the session's folder if nothing has done so yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoint"))
