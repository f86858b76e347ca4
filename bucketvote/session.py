"""Session helpers: a local session for tests and bench, and the checkpoint
folder rule (use the cluster's ``spark.checkpoint.dir``; only set one when
it is unset, as in tests)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "bucketvote") -> SparkSession:
    """A local session with AQE on and the UI off (tests and bench only)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BUCKETVOTE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The checkpoint folder the session names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only a local test session without one gets a fresh folder.
    """
    d = checkpoint_dir(spark)
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return spark.sparkContext.getCheckpointDir() or d
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset; set it to a folder shared by the cluster")
    d = tempfile.mkdtemp(prefix="bucketvote-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


#: Rows of a task, at most, where a job deals its rows by their number.
ROWS_DEALT = 1_000_000


def parts_for(spark: SparkSession, rows: int) -> int:
    """Partitions for so many rows: tasks of at most ``ROWS_DEALT`` rows, and
    as many as there are cores once rows are not few.  The number follows the
    rows and no setting; AQE merges by compressed bytes, of which sorted bins
    have too few to bound a task's memory."""
    return max(1, -(-rows // ROWS_DEALT), min(spark.sparkContext.defaultParallelism, rows // 50_000))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint folder, for tables a job writes."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/bucketvote-{name}-{uuid.uuid4().hex[:12]}"
