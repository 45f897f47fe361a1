"""Audit columns and row fingerprints."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.names import by_upper_name


@dataclass(frozen=True)
class AuditColumns:
    """Names of the audit columns. `by_prefix` takes every column whose name begins like one for an audit column."""

    loaded_at: str = "loaded_at"
    source_system: str = "source_system"
    by_prefix: bool = False

    def is_insert_only(self, column: str) -> bool:
        """Audit columns are written on insert and kept on update."""
        names = (self.loaded_at, self.source_system)
        return column.startswith(names) if self.by_prefix else column in names


AUDIT = AuditColumns()


def with_audit(df: DataFrame, run_ts: Column, source_system: str, audit: AuditColumns = AUDIT) -> DataFrame:
    """Add load time and source name. One fixed time per run keeps reruns equal."""
    present = by_upper_name(df.schema)
    for name in (audit.loaded_at, audit.source_system):
        if name.upper() in present:
            raise ValueError(f"the source already has an audit column {name!r}; choose other audit names")
    return df.select(
        "*",
        run_ts.cast("timestamp_ntz").alias(audit.loaded_at),
        F.lit(source_system).alias(audit.source_system),
    )


def row_fingerprint(*columns: str) -> Column:
    """md5 over the columns as text, each behind its length; NULL is `-`. No value can pose as another split."""
    texts = [F.col(c).cast("string") for c in columns]
    if not texts:
        return F.md5(F.lit(""))
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))
