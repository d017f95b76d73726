"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# What every job relies on: dates in UTC, and plans that adapt to skew. An
# aggregate on the join key would otherwise keep a skewed join from being split.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# Data one shuffle task should get before compression, and how much larger rows are
# then than in columnar files. Larger tasks would spill, many more of them would weigh
# on the bookkeeping of map outputs.
TASK_BYTES = 1024 * 1024 * 1024
EXPANSION = 3


def build_session(app_name: str = "lodestone", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """The same settings for a session that was made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def sized_shuffles(spark: SparkSession, *paths: str) -> Iterator[int]:
    """Enough shuffle partitions for the largest of these inputs while the block runs, then the setting from before."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        yield size_shuffles(spark, *paths)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files of a folder; none if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(folder).getLength() if files.exists(folder) else 0


def size_shuffles(spark: SparkSession, *paths: str) -> int:
    """Enough shuffle partitions for the largest of these inputs; adaptive plans merge what is too many."""
    largest = max((stored_bytes(spark, path) for path in paths), default=0)
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-largest * EXPANSION // TASK_BYTES))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own; on a
    cluster a missing setting is an error, because a machine-local folder would
    be lost with its executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="lodestone-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that belongs to this application alone."""
    return f"{shared_dir(spark)}/lodestone/{spark.sparkContext.applicationId}/{name}"


def settled(df: DataFrame) -> DataFrame:
    """A small result that several later steps read, computed once and stored in
    the shared folder, where the loss of an executor cannot reach it."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
