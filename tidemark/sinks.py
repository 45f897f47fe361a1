"""Writing to tables that some other system keeps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.audit import AUDIT, AuditColumns
from tidemark.functions.names import as_key_list


def write_connector(
    df: DataFrame, fmt: str, table: str, mode: str = "append", partitions: int | None = None, **options: str
) -> None:
    """Stage (overwrite) or append rows through a Spark connector or JDBC.

    `partitions` bounds the connections a database sees at once; the rows are
    gathered without a shuffle.
    """
    out = df if partitions is None else df.coalesce(partitions)
    out.write.format(fmt).options(**options).option("dbtable", table).mode(mode).save()


def merge_into(
    stage: DataFrame, table: str, keys: str | Sequence[str], audit: AuditColumns = AUDIT
) -> None:
    """The upsert as one MERGE, for catalog tables whose format can rewrite rows."""
    keys = as_key_list(keys)
    condition = reduce(and_, [F.col(f"{table}.{k}") == F.col(f"stage.{k}") for k in keys])
    values = {c: F.col(f"stage.`{c}`") for c in stage.columns}
    updates = {c: v for c, v in values.items() if c == audit.loaded_at or not audit.is_insert_only(c)}
    merge = stage.alias("stage").mergeInto(table, condition)
    merge.whenMatched().update(updates).whenNotMatched().insert(values).merge()
