"""Sessions for tests and benchmarks, and the folder shared by all executors."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import SparkSession


def local_session(app: str = "tidemark", cores: str = "8", memory: str = "8g") -> SparkSession:
    """A small local session; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.ui.showConsoleProgress", "false")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local session may fall back to a temporary one."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_scratch()
    raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is created or removed."""
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or one that matches the glob, is there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def remove_dirs(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove folders through the file system they lie in; a folder that is not there is none to remove."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


class Scratch:
    """The scratch tables of one run below the shared folder. The run that made them removes them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def path(self, label: str) -> str:
        self.paths.append(fresh_dir(self.spark, label))
        return self.paths[-1]

    def remove(self) -> None:
        remove_dirs(self.spark, self.paths)
        self.paths.clear()


#: Held while a run has changed the session's settings: threads share them.
SETTINGS = threading.RLock()


def _shuffle_settings(spark: SparkSession, data_bytes: int, partition_bytes: int) -> dict[str, str]:
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-data_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def size_shuffles(spark: SparkSession, data_bytes: int, partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Set partition sizes for the table at hand.

    AQE merges small shuffle partitions and splits skewed ones, but cannot raise
    their number: it must start from enough of them for the largest input.
    """
    settings = _shuffle_settings(spark, data_bytes, partition_bytes)
    for name, value in settings.items():
        spark.conf.set(name, value)
    return settings


@contextlib.contextmanager
def sized_shuffles(spark: SparkSession, data_bytes: int, partition_bytes: int = 256 * 1024 * 1024) -> Iterator[None]:
    """`size_shuffles` for the actions inside, where the session's own partitions are too few; the old settings come back."""
    if data_bytes <= int(spark.conf.get("spark.sql.shuffle.partitions")) * partition_bytes:
        yield
        return
    with SETTINGS:
        before = {name: spark.conf.get(name, None) for name in _shuffle_settings(spark, data_bytes, partition_bytes)}
        size_shuffles(spark, data_bytes, partition_bytes)
        try:
            yield
        finally:
            for name, value in before.items():
                if value is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, value)
