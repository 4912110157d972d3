"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

# Settings that can be changed on a running session.  UTC fixes the meaning of
# day, week and month; the adaptive ones let Spark size partitions, turn joins
# into broadcasts only when the measured side is small, and split hot keys.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # What a Python worker gets at a time is bounded in bytes, not only in rows, whatever the length of texts.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def size_for(spark: SparkSession, shuffle_bytes: int, partition_bytes: int = 192 << 20) -> SparkSession:
    """Choose enough shuffle partitions for a job that moves about ``shuffle_bytes``.

    Adaptive execution merges partitions that turn out small, so too many cost little
    while too few would spill: 20 TB gives about 109,000 of 192 MiB.
    """
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shuffle_bytes // partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 << 20))
    return spark


def local_session(app: str = "adtally", cores: int | str = "*", memory: str = "8g",
                  shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Recording the caller of every column expression costs more than the expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a session on one machine, such as a test's, may leave it unset and gets a
    temporary one: elsewhere every executor would write to a disk of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir names no shared folder for master {master!r}")
        named = tempfile.mkdtemp(prefix="adtally-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused between calls."""
    return f"{shared_dir(spark)}/adtally/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders that are no longer needed, on whatever file system they are."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Ask the driver to collect its garbage, upon which Spark drops the shuffle files of finished jobs.

    Without it they may stay for long, as a driver that only plans makes little garbage.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
