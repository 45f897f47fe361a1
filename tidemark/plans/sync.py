"""One sync run: read past the mark, compare schemas, load, advance the mark, commit."""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType, TimestampNTZType, TimestampType

from tidemark.functions.audit import AUDIT, AuditColumns, with_audit
from tidemark.functions.layout import KEEP, to_layout
from tidemark.functions.marks import mark_text
from tidemark.functions.names import by_upper_name
from tidemark.functions.size import BROADCAST_BYTES, row_bytes
from tidemark.operators.quality import any_null, repeated_keys
from tidemark.operators.schema import MISMATCH, ColumnDrift, conform, diff_schemas, evolve_schema
from tidemark.operators.upsert import dedupe_latest
from tidemark.plans.catalog import CatalogTarget
from tidemark.plans.control import INCREMENTAL, Process
from tidemark.plans.ledger import FAILED, append_ledger
from tidemark.plans.store import Load, Stage, TargetState, TargetStore, key_number, stage_table
from tidemark.session import Scratch
from tidemark.sources.incremental import incremental_scan

#: In-memory bytes of the rows of one part of a target.
FILE_BYTES = 512 * 1024 * 1024
#: A zoned mark column as microseconds since 1970 in UTC, beside its wall-clock time.
INSTANT = "__instant"


@dataclass(frozen=True)
class SyncResult:
    """What a run did."""

    process: Process
    run_id: int
    rows_read: int
    rows_updated: int
    rows_inserted: int
    mark: str | None
    drift: list[ColumnDrift]
    _read: Callable[[], DataFrame]
    null_keys: int = 0
    repeated_keys: int = 0

    @property
    def target(self) -> DataFrame:
        """The version this run committed."""
        return self._read()


def _metrics(rows: DataFrame, keys: list[str], mark: str | None) -> list[Column]:
    """What is counted while the stage is written: no job of its own."""
    if INSTANT in rows.columns:
        top = F.max(INSTANT).cast("string")
    else:
        top = F.max(F.col(f"`{mark}`")).cast("string") if mark else F.lit(None).cast("string")
    number = key_number(keys[0], rows.schema[keys[0]].dataType) if keys else F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_bytes(rows.schema)), zero).alias("bytes"),
        (F.coalesce(F.sum(row_bytes(rows.select(*keys).schema)), zero) if keys else zero).alias("key_bytes"),
        (F.count_if(any_null(keys)) if keys else zero).alias("null_keys"),
        top.alias("mark"),
        F.min(number).alias("lo"),
        F.max(number).alias("hi"),
    ]


def _stage(delta: DataFrame, write: Callable[[DataFrame], DataFrame], process: Process, keys: list[str], duplicates: str, scratch: Scratch, once: bool) -> Stage:
    """Write the delta, counting on the way; with `latest`, thin out repeated keys if there are any.

    A stage that is read `once` is thinned out on that reading.
    """
    seen, mark = Observation(), process.incremental_column
    rows = write(delta.observe(seen, *_metrics(delta, keys, mark)))
    counts = {"rows": 0, "bytes": 0, "key_bytes": 0, "null_keys": 0, "mark": None, "lo": None, "hi": None} | seen.get
    counts["repeated"] = repeated_keys(rows, keys).count() if process.mode == "merge" and counts["rows"] else 0
    if counts["repeated"]:
        if duplicates != "latest" or not mark:
            raise ValueError(f"{process.name}: {counts['repeated']} keys of {keys} occur more than once in the stage")
        # Size only shrinks; mark and key range stay: the counts still hold.
        newest = dedupe_latest(rows, keys, INSTANT if INSTANT in rows.columns else mark)
        rows = newest if once else stage_table(newest, scratch.path("latest"))
    return Stage(rows.drop(INSTANT), counts)


def _instant(micros: int, zone: str) -> dict:
    """A mark that is an instant: text with its offset, and the wall-clock time in `zone`."""
    at = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=micros)
    return {"mark": at.isoformat(sep=" "), "mark_type": "timestamp", "enddate": at.astimezone(ZoneInfo(zone)).replace(tzinfo=None)}


def _next_mark(process: Process, state: TargetState, stage: Stage, drift: list[ColumnDrift], rewound: bool, zoned: bool, zone: str) -> dict:
    """The largest value this process has read, whoever else loads the target: no unread row falls behind it.

    Rows of an incremental run lie past the old mark, so the stage's largest value is
    the larger one, unless the target's type orders values in another way or the run went back.
    """
    none = {"mark": None, "mark_type": None, "enddate": None}
    column, top, old = process.incremental_column, stage.counts["mark"], state.own_mark
    if not column:
        return none
    if top is None:
        return none | old
    incremental = process.load_type.upper() == INCREMENTAL and old.get("mark") is not None
    if zoned:
        made = _instant(int(top), zone)
        if rewound and incremental and old["mark_type"] == "timestamp":
            if dt.datetime.fromisoformat(old["mark"]) > dt.datetime.fromisoformat(made["mark"]):
                return none | old
        return made
    dtype = stage.rows.select(column).schema[0].dataType
    retyped = any(d.status == MISMATCH and d.column == column.upper() for d in drift)
    if (retyped or rewound) and incremental:
        marks = [F.lit(m).try_cast(dtype) for m in (old["mark"], top)]
        if stage.rows.sparkSession.range(1).select(marks[0] > marks[1]).first()[0]:
            return none | old
    dated = isinstance(dtype, (DateType, TimestampNTZType))
    return {"mark": top, "mark_type": dtype.simpleString(), "enddate": top if dated else None}


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def sync(
    spark: SparkSession,
    process: Process,
    source: DataFrame | Callable[[Process], DataFrame],
    root: str,
    run_ts: dt.datetime | None = None,
    inclusive: bool = False,
    duplicates: str = "raise",
    flat: bool = False,
    zone: str = "UTC",
    audit: AuditColumns = AUDIT,
    broadcast_bytes: int = BROADCAST_BYTES,
    file_bytes: int = FILE_BYTES,
    from_mark: object | None = None,
    nested: str = KEEP,
    skip_unchanged: bool = False,
    target: TargetStore | CatalogTarget | None = None,
) -> SyncResult:
    """Run one process against its target: versions below `root`, or the catalog table given as `target`.

    `source` may be a function that opens it; that it can't is a failure of the run.
    `duplicates` says what several stage rows for one key mean: an error, or
    "latest" to keep the one with the largest incremental value. A failed run
    leaves a ledger row that says so, and the committed target and its mark as they were; run it again.

    `from_mark` reads again from an earlier mark on; so does a control row whose
    ENDDATE is not the one that the process's last run saw. The mark does not go back.
    The mark of a zoned column is the instant, whatever wall-clock times the target holds.

    `skip_unchanged` leaves out rows that would change nothing but their load time:
    what holds only such rows is not written.
    """
    started = _now()
    run_ts = run_ts or started
    if run_ts.tzinfo is not None:
        run_ts = run_ts.astimezone(dt.timezone.utc).replace(tzinfo=None)
    store = target or TargetStore(spark, root, process.target_name)
    state = store.state(process.name, process.source_table)
    row = {
        "process_name": process.name,
        "source_table": process.source_table,
        "target_table": process.target_table,
        "run_id": state.run_id + 1,
        "batch_id": run_ts.strftime("%Y%m%d%H%M%S"),
        "mode": process.mode,
        "incremental_column": process.incremental_column,
        "started_at": started,
        "control_enddate": _enddate_text(process),
    }
    scratch = Scratch(spark)
    version = store.new_version(row["run_id"])
    try:
        source = source(process) if callable(source) else source
        zoned = _is_zoned(process, source)
        start = _start(process, state, from_mark)
        stamp = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
        delta = with_audit(_read(process, start, source, inclusive, flat, zone, nested, zoned), stamp, process.source_system, audit)
        loaded_schema = delta.drop(INSTANT).schema
        schema = evolve_schema(state.schema or _created(source, delta.drop(INSTANT)), loaded_schema)
        drift = diff_schemas(loaded_schema, state.schema) if state.schema else []
        # Without rows to look up, the stage is the new data itself.
        direct = process.mode != "merge" or not state.rows
        delta = conform(delta, StructType([*schema.fields, StructField(INSTANT, LongType())]) if zoned else schema, fill=direct)
        fields = by_upper_name(schema)
        keys = [fields[k.upper()].name for k in process.keys]
        staged = direct and not keys and isinstance(store, TargetStore)

        def write(rows: DataFrame) -> DataFrame:
            if staged:
                return store.append_staged(rows.drop(INSTANT), version)
            return stage_table(rows, scratch.path("stage"))

        stage = _stage(delta, write, process, keys, duplicates, scratch, once=direct)
        want = Load(process.mode, version, schema, keys, state, audit, broadcast_bytes, file_bytes, skip_unchanged, scratch, stamp, process.source_system)
        loaded = store.load(stage, want, staged)
        mark = _next_mark(process, state, stage, drift, start != state.own_mark.get("mark"), zoned, zone)
        counts = stage.counts
        done = {"rows_read": counts["rows"], "rows_updated": loaded.updated, "rows_inserted": loaded.inserted}
        quality = {"null_keys": counts["null_keys"], "repeated_keys": counts["repeated"], "drift": [_drift_row(d) for d in drift]}
        store.commit(row | mark | {"control_enddate": row["control_enddate"]} | done | quality | loaded.ledger | {"finished_at": _now()})
    except Exception as failure:
        # The row only tells of the failure; what matters is the failure itself.
        with contextlib.suppress(Exception):
            error = f"{type(failure).__name__}: {failure}"[:2000]
            append_ledger(spark, store.ledger_path, row | {"status": FAILED, "error": error, "finished_at": _now()})
        raise
    finally:
        scratch.remove()
    return SyncResult(process, row["run_id"], counts["rows"], loaded.updated, loaded.inserted, mark["mark"], drift, loaded.read, counts["null_keys"], counts["repeated"])


def _drift_row(drift: ColumnDrift) -> dict:
    types = [f.dataType.simpleString() if f else None for f in (drift.source, drift.target)]
    return {"column": drift.column, "status": drift.status, "source_type": types[0], "target_type": types[1]}


def _is_zoned(process: Process, source: DataFrame) -> bool:
    """Whether the mark column holds instants."""
    column = by_upper_name(source.schema).get((process.incremental_column or "").upper())
    return column is not None and isinstance(column.dataType, TimestampType)


def _created(source: DataFrame, delta: DataFrame) -> StructType:
    """Schema of a new target: NOT NULL where the source says so, audit columns nullable."""
    required = {f.name for f in source.schema.fields if not f.nullable}
    return StructType([StructField(f.name, f.dataType, f.name not in required) for f in delta.schema.fields])


def _enddate_text(process: Process) -> str:
    return "" if process.enddate is None else mark_text(process.enddate)


def _start(process: Process, state: TargetState, from_mark: object | None) -> object | None:
    """Where a run begins: the mark asked for, a control row's new ENDDATE, else the process's own mark."""
    own, seen = state.own_mark.get("mark"), state.own_mark.get("control_enddate")
    if from_mark is not None:
        return from_mark
    moved = seen is not None and process.enddate is not None and _enddate_text(process) != seen
    return process.enddate if own is None or moved else own


def _read(process: Process, start: object | None, source: DataFrame, inclusive: bool, flat: bool, zone: str, nested: str, zoned: bool) -> DataFrame:
    """The source's rows past the mark, in the target's physical types, with the instant of a zoned mark column."""
    delta = source
    if process.load_type.upper() == INCREMENTAL:
        delta = incremental_scan(source, process.incremental_column, start, inclusive, zone)
    filtered = delta is not source
    if zoned:
        delta = delta.withColumn(INSTANT, F.unix_micros(F.col(f"`{process.incremental_column}`")))
    if filtered:
        # A filtered scan leaves a little in each of many partitions; gather it into few files.
        delta = delta.hint("rebalance")
    return to_layout(delta, flat, zone, nested)


def sync_all(
    spark: SparkSession,
    processes: DataFrame,
    read: Callable[[Process], DataFrame],
    root: str,
    workers: int = 1,
    open_target: Callable[[Process], TargetStore | CatalogTarget] | None = None,
    **options,
) -> list[SyncResult]:
    """Run every chosen process; none chosen is an error.

    `read` opens the source of a process, `open_target` its target if that is not a
    store below `root`. The rows are definitions, one per synced table, not data. Up to `workers`
    targets are loaded at a time, each in a scheduler pool of its own; the processes of one target run one after
    the other, in their order. A process that fails does not keep the others from
    running; the failures are raised together at the end.
    """
    zone = options.get("zone", "UTC")
    chosen = [Process.from_row(row) for row in to_layout(processes, zone=zone).collect()]
    if not chosen:
        raise ValueError("no active process")
    lanes: dict[str, list[int]] = {}
    for i, process in enumerate(chosen):
        lanes.setdefault(process.target_name, []).append(i)
    done: dict[int, SyncResult] = {}
    failed: dict[int, Exception] = {}

    def run_lane(name: str) -> None:
        if workers > 1:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        for i in lanes[name]:
            try:
                target = open_target(chosen[i]) if open_target else None
                done[i] = sync(spark, chosen[i], read, root, target=target, **options)
            except Exception as failure:
                failure.add_note(f"process {chosen[i].name}")
                failed[i] = failure

    if workers > 1:
        with ThreadPoolExecutor(workers) as pool:
            for lane in [pool.submit(inheritable_thread_target(spark)(run_lane), name) for name in lanes]:
                lane.result()
    else:
        for name in lanes:
            run_lane(name)
    if failed:
        raise ExceptionGroup(f"{len(failed)} of {len(chosen)} processes failed", [failed[i] for i in sorted(failed)])
    return [done[i] for i in sorted(done)]
