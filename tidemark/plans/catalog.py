"""Targets that the session's catalog keeps: created, widened, appended to, replaced and merged by Spark's own commands.

A table made here is partitioned by the part of its key (`KeyParts`). A merge joins
the partitions that hold a part of the stage and writes them back by dynamic partition
overwrite. A table of a format that can rewrite rows is merged by one `mergeInto`.

Unlike versions of a store, a catalog table has one state: between the write and the
ledger row a crash leaves the new rows and the old mark. The next run reads them
again; for a merge that changes nothing but keyless rows, which come twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.functions.audit import AuditColumns
from tidemark.functions.names import by_upper_name
from tidemark.operators.quality import all_present, any_null
from tidemark.operators.schema import conform
from tidemark.operators.upsert import bounded_broadcast, changed_rows, matched_keys, upsert
from tidemark.plans.ledger import read_ledger
from tidemark.plans.store import KeyParts, Load, Loaded, Stage, TargetState, commit_row, plan_parts, read_state, stage_table
from tidemark.session import SETTINGS, sized_shuffles
from tidemark.sinks import merge_into

#: Partition column of tables made here.
PART = "key_part"


@contextmanager
def _overwrite(spark: SparkSession, how: str) -> Iterator[None]:
    name = "spark.sql.sources.partitionOverwriteMode"
    with SETTINGS:
        before = spark.conf.get(name)
        spark.conf.set(name, how)
        try:
            yield
        finally:
            spark.conf.set(name, before)


def _column(field: StructField, default: str | None = None) -> str:
    required = "" if field.nullable else " NOT NULL"
    return f"`{field.name}` {field.dataType.simpleString()}{required}" + (f" DEFAULT {default}" if default else "")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class CatalogTarget:
    """A catalog table and the ledger of its runs. `location` and `fmt` count when the table is made."""

    def __init__(self, spark: SparkSession, table: str, root: str, location: str | None = None, fmt: str = "parquet"):
        self.spark, self.table, self.location, self.fmt = spark, table, location, fmt
        self.ledger_path = f"{root.rstrip('/')}/{table}/ledger"

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def schema(self) -> StructType:
        return StructType([f for f in self.spark.table(self.table).schema.fields if f.name != PART])

    def ledger(self) -> DataFrame | None:
        return read_ledger(self.spark, self.ledger_path)

    def state(self, process_name: str | None = None, source_table: str | None = None) -> TargetState:
        """The ledger's newest run, with the schema that the table has now. A table that no run has loaded is counted."""
        state = read_state(self.ledger(), process_name, source_table)
        if not self.exists():
            return TargetState(state.run_id, state.version, None, {}, state.own_mark)
        last = state.last or {"target_rows": self.spark.table(self.table).count()}
        return TargetState(state.run_id, state.version, self.schema(), last, state.own_mark)

    def commit(self, row: dict) -> None:
        commit_row(self.spark, self.ledger_path, self.ledger(), row)

    def new_version(self, run_id: int) -> str:
        return f"{run_id:08d}-{uuid.uuid4().hex[:12]}"

    def read(self) -> DataFrame:
        return self.spark.table(self.table).drop(PART)

    def create(self, schema: StructType, audit: AuditColumns, source_system: str) -> None:
        """The table with NOT NULL columns and a default for the source name, partitioned by the key's part."""
        columns = [_column(f, _text(source_system) if f.name == audit.source_system else None) for f in schema.fields]
        where = f" LOCATION {_text(self.location)}" if self.location else ""
        self.spark.sql(f"CREATE TABLE {self.table} ({', '.join(columns)}, {PART} BIGINT) USING {self.fmt} PARTITIONED BY ({PART}){where}")

    def add_columns(self, schema: StructType) -> list[str]:
        """Columns of `schema` that the table lacks, added as nullable; old rows have NULL there."""
        present = by_upper_name(self.schema())
        new = [StructField(f.name, f.dataType, True) for f in schema.fields if f.name.upper() not in present]
        if new:
            self.spark.sql(f"ALTER TABLE {self.table} ADD COLUMNS ({', '.join(map(_column, new))})")
        return [f.name for f in new]

    def _insert(self, rows: DataFrame, parts: KeyParts | None, overwrite: str | None = None) -> None:
        """Insert rows of the table's columns. `overwrite`: "static" replaces the table, "dynamic" the partitions that come."""
        if PART in self.spark.table(self.table).columns:
            part = parts.of(rows.schema[parts.key].dataType) if parts else F.lit(None).cast("long")
            # AQE gathers a partition's rows into few files and splits a large one.
            rows = rows.withColumn(PART, part).hint("rebalance", PART)
        with _overwrite(self.spark, overwrite or "static"):
            rows.write.insertInto(self.table, overwrite=overwrite is not None)
        self.spark.catalog.refreshTable(self.table)

    def append_staged(self, rows: DataFrame, version: str) -> DataFrame:
        raise NotImplementedError("rows of a catalog table are staged first")

    def load(self, stage: Stage, want: Load, staged: bool) -> Loaded:
        made = not self.exists()
        if made:
            self.create(want.schema, want.audit, want.source_system)
        else:
            self.add_columns(want.schema)
        schema, counts = self.schema(), stage.counts
        parts = None if want.mode == "full" else want.state.parts
        if parts is None and want.keys and (made or want.mode == "full" or not want.state.rows):
            parts = plan_parts(want.keys[0], counts["lo"], counts["hi"], counts["bytes"], want.part_bytes)
        rows, updated, before = conform(stage.rows, schema, fill=want.mode != "merge"), 0, want.state.rows
        if want.mode == "full":
            self._insert(rows, parts, "static")
            inserted, before = counts["rows"], 0
        elif counts["rows"] == 0:
            inserted = 0
        elif want.mode == "append" or made:
            self._insert(conform(stage.rows, schema), parts)
            inserted = counts["rows"]
        else:
            updated, inserted = self._merge(rows, counts, want, schema, parts)
        layout = {"part_key": parts.key, "part_kind": parts.kind, "part_size": parts.size} if parts else {}
        ledger = {"target_rows": before + inserted, "version": want.version, "table_schema": schema.json()}
        return Loaded(updated, inserted, self.read, layout | ledger)

    def _merge(self, rows: DataFrame, counts: dict, want: Load, schema: StructType, parts: KeyParts | None) -> tuple[int, int]:
        keys, old = want.keys, self.spark.table(self.table)
        few = want.broadcast_bytes >= counts["key_bytes"]
        parted = PART in old.columns
        if parted:
            if parts is None or parts.key != keys[0]:
                raise ValueError(f"{self.table} is not partitioned by {keys[0]}; load it in full once with that key")
            wanted = rows.filter(all_present(keys)).select(parts.of(rows.schema[parts.key].dataType).alias(PART)).distinct()
            # Broadcast, the few part numbers prune the table's partitions.
            old = old.join(F.broadcast(wanted) if few else wanted, PART, "left_semi").drop(PART)
        if want.skip_unchanged:
            rows = stage_table(changed_rows(old, rows, keys, want.audit), want.scratch.path("changed"))
        matched = stage_table(matched_keys(old, rows, keys, few), want.scratch.path("matched"))
        updated = old.join(bounded_broadcast(matched, few), keys, "left_semi").count()
        inserted = rows.join(bounded_broadcast(matched, few), keys, "left_anti").count()
        if not parted:
            merge_into(rows, self.table, keys, want.audit)
            return updated, inserted
        with sized_shuffles(self.spark, counts["bytes"] * (1 + want.state.rows // max(counts["rows"], 1))):
            merged = upsert(old, rows.filter(all_present(keys)), keys, want.audit, broadcast=counts["bytes"] <= want.broadcast_bytes, matched=matched)
            self._insert(merged, parts, "dynamic")
        keyless = rows.filter(any_null(keys))
        if not keyless.isEmpty():
            self._insert(conform(keyless, schema), parts)
        return updated, inserted


def read_table(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table without the partition column that a target adds."""
    rows = spark.table(table).drop(PART)
    return rows.select(*columns) if columns else rows
