"""The run ledger: one appended row per run. The newest row of a process is its state."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from tidemark.functions.marks import mark_text
from tidemark.session import path_exists

LEDGER_SCHEMA = """
    process_name string, source_table string, target_table string, run_id bigint, batch_id string,
    mode string, incremental_column string, mark string, mark_type string, enddate timestamp_ntz,
    rows_read bigint, rows_updated bigint, rows_inserted bigint, target_slices bigint, target_rows bigint,
    version string, table_schema string, started_at timestamp_ntz, finished_at timestamp_ntz,
    control_enddate string, status string, error string, null_keys bigint, repeated_keys bigint,
    drift array<struct<column: string, status: string, source_type: string, target_type: string>>,
    part_key string, part_kind string, part_size bigint
"""
#: What became of a run (fixed values).
COMMITTED, FAILED = "committed", "failed"


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """Ledger rows below `path` (globs allowed), or None if no run was ever recorded."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(path) if path_exists(spark, path) else None


def append_ledger(spark: SparkSession, path: str, row: dict) -> None:
    """Record a run. This one-file append is the commit of everything the run wrote."""

    def value(field: StructField) -> Column:
        given = row.get(field.name)
        if given is None:
            return F.lit(None).cast(field.dataType)
        if isinstance(field.dataType, ArrayType):
            return F.from_json(F.lit(json.dumps(given)), field.dataType)
        return F.lit(mark_text(given)).cast(field.dataType)

    values = [value(f).alias(f.name) for f in StructType.fromDDL(LEDGER_SCHEMA).fields]
    spark.range(0, 1, 1, 1).select(*values).write.mode("append").parquet(path)


def ledger_current(
    ledger: DataFrame, process: str | Sequence[str] = "process_name", run: str = "run_id", *values: str
) -> DataFrame:
    """The newest run of each process. A hot process is reduced in each map task first."""
    by = [process] if isinstance(process, str) else list(process)
    kept = values or [c for c in ledger.columns if c not in {*by, run}]
    newest = ledger.groupBy(*by).agg(F.max_by(F.struct(run, *kept), F.col(run)).alias("newest"))
    return newest.select(*by, "newest.*")


def ledger_metadata(ledger: DataFrame) -> DataFrame:
    """Each run's state as JSON text."""
    last_run = F.date_format("finished_at", "yyyy-MM-dd'T'HH:mm:ss")
    state = F.struct(
        last_run.alias("last_run"),
        F.col("mark").alias("watermark"),
        F.col("process_name").alias("job_name"),
        F.col("source_table").alias("table"),
    )
    return ledger.select("process_name", F.to_json(state).alias("metadata"))


def run_metrics(ledger: DataFrame) -> DataFrame:
    """Rows and duration of each run."""
    took = F.expr(
        """CAST(extract(DAY FROM finished_at - started_at) * 86400 + extract(HOUR FROM finished_at - started_at) * 3600
        + extract(MINUTE FROM finished_at - started_at) * 60 + extract(SECOND FROM finished_at - started_at) AS DOUBLE)"""
    )
    counts = ("rows_read", "rows_updated", "rows_inserted")
    return ledger.select("process_name", "run_id", *counts, took.alias("seconds"), "finished_at")
