"""Intermediate tables in the cluster's shared folder, and joins by measured size."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import SETTINGS, Scratch, fresh_dir

#: Rows of ids up to which a list of ids goes to every task: about 16 bytes each.
BROADCAST_IDS = 500_000
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read again: later steps survive a lost executor and repeat nothing."""
    path = fresh_dir(rows.sparkSession, f"llm-{label}")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def written(rows: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """As `stored`, in a table that `scratch` removes."""
    path = scratch.path(f"llm-{label}")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextlib.contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """Each action inside removes its shuffle files when it ends; no DataFrame inside may be run twice. The old setting comes back."""
    with SETTINGS:
        before = spark.conf.get(_CLEANUP, None)
        spark.conf.set(_CLEANUP, "true")
        try:
            yield
        finally:
            spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def set_aside(rows: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """The rows with columns of a working name under another one, and the renaming that gives them their own back."""
    taken, away = {c.lower() for c in rows.columns} | set(names), {}
    for column in rows.columns:
        if column.lower() in names:
            other = column + "_"
            while other.lower() in taken:
                other += "_"
            taken.add(other.lower())
            away[column] = other
    return rows.withColumnsRenamed(away) if away else rows, {other: column for column, other in away.items()}


def of_ids(rows: DataFrame, ids: DataFrame, key: str, most: int = BROADCAST_IDS) -> DataFrame:
    """The rows whose key is among the distinct ids (a written table, counted here): broadcast up to `most`, else by a shuffle."""
    few = ids.count() <= most
    return rows.join(F.broadcast(ids) if few else ids.hint("merge"), key, "left_semi")
