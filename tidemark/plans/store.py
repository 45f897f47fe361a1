"""Versions of a target as partitioned parquet, for places without a table format.

    <root>/<target>/data/__slice=<part>@<run>/   rows of one key range as one run wrote them, never changed
    <root>/<target>/slices/<run>/                the slices that make up the table after the run
    <root>/<target>/ledger/                      one row per run; naming the slices commits them

A slice is a partition of one parquet table, so Spark lists, prunes and reads them: a
version is that table joined on its partition column with the few slices of the
version, and what a run may have to rewrite is such a join too. Python sees no file.

The part of a row comes from its key: ranges of equal width for numbers, dates and
zone-free timestamps, a hash for other types. Rows without a key, and rows loaded
without one, lie in slices of their own. A run rewrites the slices that hold a key of
its stage and adds slices for the rest; all others are carried over by name. New columns
live in the recorded schema only: old slices read them as NULL. One writer per target
at a time: a run that finds another one committed since it began gives up, but two
commits in the same instant are not told apart.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tidemark.functions.audit import AuditColumns, row_fingerprint
from tidemark.operators.quality import all_present
from tidemark.operators.schema import conform
from tidemark.operators.upsert import unchanged_keys, update_columns, upsert
from tidemark.plans.ledger import COMMITTED, append_ledger, read_ledger
from tidemark.session import Scratch, remove_dirs, sized_shuffles

SLICE = "__slice"
SLICES_SCHEMA = "slice string, part bigint, known boolean, rows bigint"
_WHOLE = (ByteType, ShortType, IntegerType, LongType)
#: Every reading lists a target's slices, a task and a few KB for the driver each: large targets get wider parts, not more.
MAX_PARTS = 1024
#: In-memory bytes that a fingerprint adds to a row: a word and 32 hex digits.
PRINT_BYTES = 40


@dataclass(frozen=True)
class KeyParts:
    """How a key gives the part of a row: `size` is the width of a range, or the number of hashed parts."""

    key: str
    kind: str
    size: int

    def of(self, dtype: DataType) -> Column:
        size = F.lit(self.size).cast("long")
        if self.kind == "hash":
            key = F.col(f"`{self.key}`")
            # The two zeros are one key.
            return F.pmod(F.xxhash64(key + F.lit(0.0) if isinstance(dtype, (FloatType, DoubleType)) else key), size)
        number = key_number(self.key, dtype)
        return F.call_function("div", number, size) - F.when(number % size < 0, 1).otherwise(0)


def key_number(key: str, dtype: DataType) -> Column:
    """A key as a whole number in the key's order; NULL for types without one."""
    column = F.col(f"`{key}`")
    if isinstance(dtype, _WHOLE):
        return column.cast("long")
    if isinstance(dtype, DateType):
        return F.unix_date(column).cast("long")
    if isinstance(dtype, TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), column)
    return F.lit(None).cast("long")


def plan_parts(key: str, lo: int | None, hi: int | None, data_bytes: int, part_bytes: int) -> KeyParts | None:
    """At most `MAX_PARTS` parts of about `part_bytes` or more each for keys spread as evenly as these; None for no rows."""
    if not data_bytes:
        return None
    if lo is None or hi is None:
        return KeyParts(key, "hash", min(MAX_PARTS, max(1, -(-data_bytes // part_bytes))))
    keys = hi - lo + 1
    return KeyParts(key, "range", min(1 << 62, max(1, keys * part_bytes // data_bytes, -(-keys // MAX_PARTS))))


@dataclass(frozen=True)
class TargetState:
    """The newest committed run, if any."""

    run_id: int = 0
    version: str | None = None
    schema: StructType | None = None
    last: dict = field(default_factory=dict)
    own_mark: dict = field(default_factory=dict)

    @property
    def parts(self) -> KeyParts | None:
        last = self.last
        return KeyParts(last["part_key"], last["part_kind"], last["part_size"]) if last.get("part_key") else None

    @property
    def rows(self) -> int:
        return self.last.get("target_rows") or 0


@dataclass(frozen=True)
class Stage:
    """The written delta and what its writing told: rows, bytes, key_bytes, mark, lo, hi and more."""

    rows: DataFrame
    counts: dict


@dataclass(frozen=True)
class Load:
    """What a run wants of its target."""

    mode: str
    version: str
    schema: StructType
    keys: list[str]
    state: TargetState
    audit: AuditColumns
    broadcast_bytes: int
    part_bytes: int
    skip_unchanged: bool
    scratch: Scratch
    stamp: Column
    source_system: str


@dataclass(frozen=True)
class Loaded:
    """What became of it, with the ledger's columns for this kind of target."""

    updated: int
    inserted: int
    read: Callable[[], DataFrame]
    ledger: dict


def stage_table(df: DataFrame, path: str) -> DataFrame:
    """Write `df` over whatever an earlier attempt left at `path`, and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_state(ledger: DataFrame | None, process_name: str | None, source_table: str | None) -> TargetState:
    """The newest committed run of a ledger, with the newest mark that one process has set."""
    if ledger is None:
        return TargetState()
    own = (F.col("process_name") == F.lit(process_name)) & (F.col("source_table") == F.lit(source_table))
    committed = ledger.filter(F.col("status") == COMMITTED)
    found = committed.agg(
        F.max_by(F.struct("*"), "run_id").alias("last"),
        F.max_by(F.struct("mark", "mark_type", "enddate", "control_enddate"), F.when(own, F.col("run_id"))).alias("own"),
    ).first()
    if found.last is None:
        return TargetState()
    schema = StructType.fromJson(json.loads(found.last.table_schema))
    own_mark = found.own.asDict() if found.own else {}
    return TargetState(found.last.run_id, found.last.version, schema, found.last.asDict(), own_mark)


def commit_row(spark: SparkSession, path: str, ledger: DataFrame | None, row: dict) -> None:
    """Append a run's ledger row, unless another run was committed since this one began."""
    newest = None if ledger is None else ledger.filter(F.col("status") == COMMITTED).agg(F.max("run_id").alias("run_id")).first().run_id
    if newest is not None and newest >= row["run_id"]:
        raise RuntimeError(f"{path}: run {newest} was committed by another writer; run again")
    append_ledger(spark, path, row | {"status": COMMITTED})


class TargetStore:
    def __init__(self, spark: SparkSession, root: str, target: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/{target}"
        self.ledger_path = f"{self.path}/ledger"

    def ledger(self) -> DataFrame | None:
        return read_ledger(self.spark, self.ledger_path)

    def state(self, process_name: str | None = None, source_table: str | None = None) -> TargetState:
        return read_state(self.ledger(), process_name, source_table)

    def exists(self) -> bool:
        return self.state().schema is not None

    def commit(self, row: dict) -> None:
        commit_row(self.spark, self.ledger_path, self.ledger(), row)

    def new_version(self, run_id: int) -> str:
        """A name no other attempt uses, not even one that failed."""
        return f"{run_id:08d}-{uuid.uuid4().hex[:12]}"

    # Slices

    def slices(self, version: str | None) -> DataFrame:
        """The slices of a version: their part, whether it is known where their keys lie, and rows."""
        if version is None:
            return self.spark.createDataFrame([], SLICES_SCHEMA)
        return self.spark.read.schema(SLICES_SCHEMA).parquet(f"{self.path}/slices/{version}")

    def read_slices(self, schema: StructType, slices: DataFrame, named: bool = False) -> DataFrame:
        """Rows of some slices; Spark prunes all other partitions. `named` keeps the slice's name."""
        every = StructType([*schema.fields, StructField(SLICE, StringType())])
        rows = self.spark.read.schema(every).parquet(f"{self.path}/data")
        # The filter tells Spark that the few names are worth pruning by.
        wanted = slices.filter("rows > 0").select(F.col("slice").alias(SLICE))
        found = rows.join(F.broadcast(wanted), SLICE, "left_semi")
        return found.select(*[F.col(f"`{f.name}`") for f in schema.fields], *([SLICE] if named else []))

    def read(self) -> DataFrame:
        """The committed target."""
        state = self.state()
        if state.schema is None:
            raise ValueError(f"no committed target at {self.path}")
        return self.read_slices(state.schema, self.slices(state.version))

    def sliced(self, rows: DataFrame, version: str, parts: KeyParts | None) -> DataFrame:
        """Rows with the name of their slice."""
        if parts is None:
            return rows.withColumn(SLICE, F.lit(f"all@{version}"))
        part = F.coalesce(parts.of(rows.schema[parts.key].dataType).cast("string"), F.lit("none"))
        return rows.withColumn(SLICE, F.concat(part, F.lit(f"@{version}")))

    def write(self, rows: DataFrame, version: str, parts: KeyParts | None, keys: list[str]) -> None:
        """Write new slices. AQE gathers small ones into few tasks and splits a large one."""
        named = self.sliced(rows, version, parts)
        if parts is not None:
            named = named.hint("rebalance", SLICE).sortWithinPartitions(SLICE, *[F.col(f"`{k}`") for k in keys])
        named.write.mode("append").partitionBy(SLICE).parquet(f"{self.path}/data")

    def written(self, version: str) -> DataFrame:
        """The slices a run wrote, counted from the files' footers."""
        rows = self.spark.read.schema(f"{SLICE} string").parquet(f"{self.path}/data")
        counted = rows.filter(F.col(SLICE).endswith(f"@{version}")).groupBy(F.col(SLICE).alias("slice")).agg(F.count("*").alias("rows"))
        name = F.substring_index("slice", "@", 1)
        return counted.select("slice", name.try_cast("long").alias("part"), (name != "all").alias("known"), "rows")

    def list_slices(self, version: str, carried: DataFrame, written: DataFrame) -> dict:
        """Record the slices of a version; how many slices and rows it has."""
        saved = stage_table(carried.unionByName(written), f"{self.path}/slices/{version}")
        return saved.agg(F.count("*").alias("target_slices"), F.coalesce(F.sum("rows"), F.lit(0)).alias("target_rows")).first().asDict()

    def near(self, state: TargetState, stage: DataFrame, keys: list[str]) -> DataFrame:
        """Slices that may hold a key of the stage."""
        live, parts = self.slices(state.version), state.parts
        if parts is None or parts.key != keys[0]:
            return live.filter("part is not null or not known")
        wanted = stage.filter(all_present(keys)).select(parts.of(stage.schema[parts.key].dataType).alias("part")).distinct()
        return live.filter("part is not null").join(wanted, "part", "left_semi").select(*live.columns).unionByName(live.filter("not known"))

    # Loads

    def append_staged(self, rows: DataFrame, version: str) -> DataFrame:
        """Write rows without a key straight into a slice of the version; they count once that is committed."""
        self.write(rows, version, None, [])
        schema = StructType([f for f in rows.schema.fields])
        slices = self.spark.createDataFrame([(f"all@{version}", None, False, 1)], SLICES_SCHEMA)
        return self.read_slices(schema, slices)

    def load(self, stage: Stage, want: Load, staged: bool) -> Loaded:
        """Make the next version. `staged` says that the rows are in the version's own slice already."""
        state, counts = want.state, stage.counts
        if counts["rows"] == 0 and want.mode != "full" and state.schema is not None:
            kept = {k: state.last.get(k) for k in ("target_slices", "target_rows", "part_key", "part_kind", "part_size")}
            return Loaded(0, 0, self._reader(state.schema, state.version), kept | {"version": state.version, "table_schema": state.schema.json()})
        parts = None if want.mode == "full" else state.parts
        if parts is None and want.keys:
            parts = plan_parts(want.keys[0], counts["lo"], counts["hi"], counts["bytes"], want.part_bytes)
        carried, updated = (self.slices(None) if want.mode == "full" else self.slices(state.version)), 0
        if want.mode == "merge" and state.rows:
            carried, updated = self._merge(stage, want, parts, carried)
        elif not staged:
            self.write(stage.rows, want.version, parts, want.keys)
        total = self.list_slices(want.version, carried, self.written(want.version))
        layout = {"part_key": parts.key, "part_kind": parts.kind, "part_size": parts.size} if parts else {}
        inserted = total["target_rows"] - (0 if want.mode == "full" else state.rows)
        return Loaded(updated, inserted, self._reader(want.schema, want.version), total | layout | {"version": want.version, "table_schema": want.schema.json()})

    def _reader(self, schema: StructType, version: str | None) -> Callable[[], DataFrame]:
        return lambda: self.read_slices(schema, self.slices(version))

    def _merge(self, stage: Stage, want: Load, parts: KeyParts | None, live: DataFrame) -> tuple[DataFrame, int]:
        """Rewrite the slices that hold a stage key; the slices carried over, and the rows updated.

        Slices are found in two steps: by part, then by the key column alone. Only
        those that hold a match are read whole. With `skip_unchanged` the first reading
        takes the compared columns too, and slices of equal rows count as untouched.
        """
        counts, keys, schema = stage.counts, want.keys, want.schema
        sought = counts["key_bytes"] + (PRINT_BYTES * counts["rows"] if want.skip_unchanged else 0)
        small, few = counts["bytes"] <= want.broadcast_bytes, sought <= want.broadcast_bytes
        width = counts["bytes"] / max(counts["rows"], 1)
        near = stage_table(self.near(want.state, stage.rows, keys), want.scratch.path("near"))
        about = near.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

        def size(rows: int) -> int:
            return counts["bytes"] + int(width * rows)

        def sought_side(df: DataFrame) -> DataFrame:
            # Left to itself, Spark goes by the compressed files and may broadcast what measured as too large.
            return F.broadcast(df) if few else df.hint("merge")

        held = self.read_slices(schema, near, named=True).filter(all_present(keys))
        wanted = stage.rows.filter(all_present(keys))
        if want.skip_unchanged:
            compared = update_columns(stage.rows, keys, want.audit)
            held = held.select(*keys, SLICE, row_fingerprint(*compared).alias("__held"))
            wanted = wanted.select(*keys, row_fingerprint(*compared).alias("__new"))
            found = held.join(sought_side(wanted), keys).select(*keys, SLICE, (F.col("__held") == F.col("__new")).alias("__same"))
        else:
            # Written as it comes from the join: an aggregate here would keep AQE from splitting a hot key.
            found = held.select(*keys, SLICE).join(sought_side(wanted.select(*keys)), keys, "left_semi")
        with sized_shuffles(self.spark, size(about)):
            hits = stage_table(found, want.scratch.path("hits"))
        rows = stage.rows
        if want.skip_unchanged:
            same = unchanged_keys(hits, keys, "__same")
            rows = stage_table(rows.join(same, keys, "left_anti").select(*rows.columns), want.scratch.path("changed"))
            hits = hits.join(same, keys, "left_anti")
        touched = hits.groupBy(F.col(SLICE).alias("slice")).agg(F.count("*").alias("copies"))
        touched = stage_table(touched.join(near, "slice"), want.scratch.path("touched"))
        updated, old_rows = touched.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))).first()
        if not updated:
            self.write(conform(rows, schema), want.version, parts, keys)
            return live, 0
        old = self.read_slices(schema, touched)
        merged = upsert(old, rows, keys, want.audit, broadcast=small, matched=hits.select(*keys).distinct())
        with sized_shuffles(self.spark, size(old_rows)):
            self.write(merged, want.version, parts, keys)
        return live.join(touched.select("slice"), "slice", "left_anti").select(*live.columns), updated

    def adopt(self, existing: DataFrame, key: str | None = None, part_bytes: int = 512 << 20) -> None:
        """Take over a table kept elsewhere as the first version. It has no mark yet.

        Its columns are nullable: that a plan yields no NULL is no promise of the table.
        """
        if self.state().run_id:
            raise ValueError(f"{self.path} already has a committed version")
        version, parts = self.new_version(1), None
        if key is not None:
            number = key_number(key, existing.schema[key].dataType)
            lo, hi, n = existing.agg(F.min(number), F.max(number), F.count("*")).first()
            parts = plan_parts(key, lo, hi, n * 16 * (len(existing.columns) + 2), part_bytes)
        self.write(existing, version, parts, [key] if key else [])
        schema = StructType([StructField(f.name, f.dataType, True) for f in existing.schema.fields])
        total = self.list_slices(version, self.slices(None), self.written(version))
        layout = {"part_key": parts.key, "part_kind": parts.kind, "part_size": parts.size} if parts else {}
        name = self.path.rsplit("/", 1)[1]
        self.commit({"run_id": 1, "target_table": name, "version": version, "table_schema": schema.json()} | total | layout)

    def vacuum(self, keep_runs: int = 2) -> int:
        """Remove slices that none of the newest `keep_runs` committed runs has, and what failed runs left; how many went.

        Runs when no other run does. Only names of superseded partitions pass through the driver.
        """
        ledger = self.ledger()
        if ledger is None or keep_runs < 1:
            return 0
        newest = ledger.filter(F.col("status") == COMMITTED).select("run_id", "version").orderBy(F.desc("run_id")).limit(keep_runs)
        kept = [r.version for r in newest.collect()]
        live = self.slices(kept[0]).select("slice")
        for version in set(kept[1:]):
            live = live.union(self.slices(version).select("slice"))
        every = self.spark.read.schema(f"{SLICE} string").parquet(f"{self.path}/data").select(F.col(SLICE).alias("slice")).distinct()
        gone = [r.slice for r in every.join(live.distinct(), "slice", "left_anti").collect()]
        remove_dirs(self.spark, [f"{self.path}/data/{SLICE}={name}" for name in gone])
        return len(gone)
