"""Session defaults and the shared folder used for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM interprets methods beyond this size; six book sides in one would be one. Such a stage is
    # compiled operator by operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Python workers hold whole batches of texts, on both sides of the pipe.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("feedloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on (UTC rendering) and those scale depends on (AQE, batches)."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster such a folder
    exists on one machine only, and what is written there dies with it.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="feedloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_root(spark)}/feedloom/{name}-{uuid.uuid4().hex}"
