"""Upsert by key as a DataFrame plan that yields the new state of the target.

Matched rows take the stage's columns, NULLs included, and its load time; columns
the stage lacks and insert-only audit columns keep their value. Unmatched stage
rows are added. Target rows without a match are untouched. A NULL key matches nothing.

The target is always the left side of a left outer join: AQE can split a skewed
partition there, so a target key with very many rows does not end in one task.
Rows with a NULL key go around the join, for a shuffle would put all of them in
one partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import AtomicType

from tidemark.functions.audit import AUDIT, AuditColumns, row_fingerprint
from tidemark.functions.names import as_key_list, by_upper_name
from tidemark.functions.size import BROADCAST_BYTES, row_bytes
from tidemark.operators.quality import all_present, any_null
from tidemark.operators.schema import conform

_STAGE = "__stage_"


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the measured width of all rows of `df` stays within `limit`."""
    return df.agg(F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0))).first()[0] <= limit


def dedupe_latest(
    df: DataFrame, keys: str | Sequence[str], latest_by: str | Sequence[str], tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the one with the largest `latest_by`; ties go to the smallest other columns.

    Spark keeps a single row per key in each map task before the shuffle
    (`WindowGroupLimit`), so a hot key is cheap. Rows with a NULL key are not
    copies of each other and all stay.
    """
    keys = as_key_list(keys)
    latest = as_key_list(latest_by)
    if tiebreak is None:
        tiebreak = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    ties = [F.col(c).asc() for c in tiebreak if c not in {*keys, *latest}]
    order = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in latest], *ties)
    kept = df.filter(all_present(keys)).withColumn("__rank", F.row_number().over(order))
    return kept.filter(F.col("__rank") == 1).drop("__rank").unionByName(df.filter(any_null(keys)))


def bounded_broadcast(df: DataFrame, broadcast: bool) -> DataFrame:
    """Hint a side whose size the caller has measured."""
    return F.broadcast(df) if broadcast else df


def _on(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k) == F.col(_STAGE + k) for k in keys])


def _conformed(stage: DataFrame, target: DataFrame) -> DataFrame:
    return conform(stage, target.schema, fill=False)


def _target_keys(target: DataFrame, keys: str | Sequence[str]) -> list[str]:
    fields = by_upper_name(target.schema)
    return [fields[k.upper()].name for k in as_key_list(keys)]


def matched_keys(target: DataFrame, stage: DataFrame, keys: str | Sequence[str], broadcast: bool = False) -> DataFrame:
    """Distinct stage keys the target holds: never more rows than the stage.

    Without a broadcast the target's keys are made distinct before the join, so
    that copies of a hot key are combined in the map tasks. After it, the
    distinct would keep AQE from splitting the hot partition.
    """
    keys = _target_keys(target, keys)
    wanted = _conformed(stage, target).filter(all_present(keys)).select(*keys)
    held = target.filter(all_present(keys)).select(*keys)
    if broadcast:
        return held.join(F.broadcast(wanted), keys, "left_semi").distinct()
    return held.distinct().join(wanted, keys, "left_semi")


def update_columns(stage: DataFrame, keys: Sequence[str], audit: AuditColumns = AUDIT) -> list[str]:
    """The stage's columns that an update writes, but for the load time."""
    known = {k.upper() for k in keys}
    return [c for c in stage.columns if c.upper() not in known and not audit.is_insert_only(c)]


def unchanged_keys(hits: DataFrame, keys: Sequence[str], same: str) -> DataFrame:
    """Keys of `hits` of which every copy in the target equals the stage's row."""
    return hits.groupBy(*keys).agg(F.bool_and(same).alias(same)).filter(same).select(*keys)


def changed_rows(target: DataFrame, stage: DataFrame, keys: str | Sequence[str], audit: AuditColumns = AUDIT) -> DataFrame:
    """The stage without the rows that would update nothing but the load time.

    Rows are compared by fingerprint, taken over the columns an update writes, in the
    target's types. A key that the target repeats is unchanged only if all copies are.
    """
    keys = _target_keys(target, keys)
    stage = _conformed(stage, target)
    print_of = row_fingerprint(*update_columns(stage, keys, audit))
    # Distinct before the join: copies of a hot key combine in the map tasks.
    held = target.filter(all_present(keys)).select(*keys, print_of.alias("__held")).distinct()
    new = stage.filter(all_present(keys)).select(*keys, print_of.alias("__new"))
    hits = held.join(new, keys).select(*keys, (F.col("__held") == F.col("__new")).alias("__same"))
    return stage.join(unchanged_keys(hits, keys, "__same"), keys, "left_anti").select(*stage.columns)


def _joined(target: DataFrame, stage: DataFrame, keys: Sequence[str], how: str, broadcast: bool) -> DataFrame:
    staged = stage.filter(all_present(keys))
    staged = staged.select(*[F.col(f"`{c}`").alias(_STAGE + c) for c in staged.columns])
    return target.join(bounded_broadcast(staged, broadcast), _on(keys), how)


def _merged_columns(target: DataFrame, stage: DataFrame, keys: Sequence[str], audit: AuditColumns) -> list[Column]:
    hit = F.col(_STAGE + keys[0]).isNotNull()

    def pick(name: str) -> Column:
        kept = F.col(f"`{name}`")
        loaded = name.upper() == audit.loaded_at.upper()
        if name not in stage.columns or name in keys or (audit.is_insert_only(name) and not loaded):
            return kept
        return F.when(hit, F.col(f"`{_STAGE}{name}`")).otherwise(kept).alias(name)

    return [pick(name) for name in target.columns]


def matched_rows(
    target: DataFrame, stage: DataFrame, keys: str | Sequence[str], audit: AuditColumns = AUDIT, broadcast: bool = False
) -> DataFrame:
    """Only the target rows that the stage updates, after the update."""
    keys = _target_keys(target, keys)
    stage = _conformed(stage, target)
    keyed = target.filter(all_present(keys))
    return _joined(keyed, stage, keys, "inner", broadcast).select(*_merged_columns(target, stage, keys, audit))


def inserted_rows(
    target: DataFrame,
    stage: DataFrame,
    keys: str | Sequence[str],
    broadcast: bool = False,
    matched: DataFrame | None = None,
) -> DataFrame:
    """Only the stage rows without a target key, in the target's columns."""
    keys = _target_keys(target, keys)
    if matched is None:
        matched = matched_keys(target, stage, keys, broadcast)
    rows = conform(stage, target.schema)
    new = rows.filter(all_present(keys)).join(bounded_broadcast(matched.select(*keys), broadcast), keys, "left_anti")
    return new.select(*target.columns).unionByName(rows.filter(any_null(keys)))


def upsert(
    target: DataFrame,
    stage: DataFrame,
    keys: str | Sequence[str],
    audit: AuditColumns = AUDIT,
    broadcast: bool = False,
    matched: DataFrame | None = None,
    unique_target: bool = False,
) -> DataFrame:
    """The target after the stage is merged into it.

    The stage must hold one row per key (`require_unique_keys`, `dedupe_latest`).
    `broadcast` keeps the target from being shuffled; set it only after
    `fits_broadcast`. `matched` may hand in keys known to match, to save a scan.
    `unique_target` states that the target holds one row per key as well: no key
    can be hot then, and a single full outer join does both legs.
    """
    keys = _target_keys(target, keys)
    if unique_target and not broadcast:
        return _full_outer(target, stage, keys, audit)
    added = inserted_rows(target, stage, keys, broadcast, matched)
    stage = _conformed(stage, target)
    columns = _merged_columns(target, stage, keys, audit)
    if broadcast:
        return _joined(target, stage, keys, "left", True).select(*columns).unionByName(added)
    kept = _joined(target.filter(all_present(keys)), stage, keys, "left", False).select(*columns)
    return kept.unionByName(target.filter(any_null(keys))).unionByName(added)


def _full_outer(target: DataFrame, stage: DataFrame, keys: Sequence[str], audit: AuditColumns) -> DataFrame:
    """Both legs in one join: a row without a target key is the stage's own row."""
    filled = conform(stage, target.schema)
    present = _conformed(stage, target).columns
    updated = _merged_columns(target, filled.select(*present), keys, audit)
    held = F.col("__held").isNotNull()
    columns = [
        F.when(held, update).otherwise(F.col(f"`{_STAGE}{name}`")).alias(name)
        for name, update in zip(target.columns, updated)
    ]
    keyed = target.filter(all_present(keys)).withColumn("__held", F.lit(True))
    merged = _joined(keyed, filled, keys, "full_outer", False).select(*columns)
    return merged.unionByName(target.filter(any_null(keys))).unionByName(filled.filter(any_null(keys)))
