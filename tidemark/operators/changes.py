"""What changed between a target and its source: rows with both values, and keys that are gone."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.audit import AUDIT, AuditColumns
from tidemark.functions.names import as_key_list, by_upper_name
from tidemark.operators.quality import all_present, any_null

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def change_feed(target: DataFrame, source: DataFrame, keys: str | Sequence[str], deletes: bool = True, audit: AuditColumns = AUDIT) -> DataFrame:
    """The keys, `kind`, `before` and `after` of each row that an upsert of `source` would insert or update.

    `before` and `after` are structs of the columns both sides have, but for keys and audit
    columns, in the target's types; rows equal in all of them are left out. With `deletes` the source is
    whole, and target rows whose key it lacks are deletions. A NULL key matches nothing:
    in the source it is an insertion, in the target nothing. The source holds one row per key.
    """
    fields = by_upper_name(target.schema)
    keys = [fields[k.upper()].name for k in as_key_list(keys)]
    ours = by_upper_name(source.schema)
    shared = [f for f in target.schema.fields if f.name.upper() in ours and f.name not in keys and not audit.is_insert_only(f.name)]

    def side(df: DataFrame, mark: str) -> DataFrame:
        values = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in shared]
        named = [F.col(f"`{k}`").cast(fields[k.upper()].dataType).alias(f"{mark}_{k}") for k in keys]
        return df.select(*named, F.struct(*values, F.lit(True).alias("__held")).alias(mark))

    held, new = side(target.filter(all_present(keys)), "before"), side(source, "after")
    on = reduce(and_, [F.col(f"before_{k}") == F.col(f"after_{k}") for k in keys])
    # Rows without a key go around the join: a shuffle would put all of them in one partition.
    lost = [f"after_{k}" for k in keys]
    joined = held.join(new.filter(all_present(lost)), on, "full_outer" if deletes else "right_outer")
    both = joined.unionByName(new.filter(any_null(lost)), allowMissingColumns=True)
    kind = F.when(F.col("before").isNull(), INSERT).when(F.col("after").isNull(), DELETE).when(~F.col("before").eqNullSafe(F.col("after")), UPDATE)

    def shown(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.struct(*[F.col(f"{name}.`{f.name}`").alias(f.name) for f in shared])).alias(name)

    named = [F.coalesce(f"after_{k}", f"before_{k}").alias(k) for k in keys]
    return both.select(*named, kind.alias("kind"), shown("before") if shared else F.lit(None).alias("before"), shown("after") if shared else F.lit(None).alias("after")).filter("kind is not null")


def deleted_keys(target: DataFrame, source: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Distinct keys of the target that the whole source has no more. NULL keys are left out: they match nothing."""
    fields = by_upper_name(target.schema)
    keys = [fields[k.upper()].name for k in as_key_list(keys)]
    present = source.select(*[F.col(f"`{k}`").cast(fields[k.upper()].dataType).alias(k) for k in keys])
    # Distinct before the join: copies of a hot key combine in the map tasks.
    return target.filter(all_present(keys)).select(*keys).distinct().join(present, keys, "left_anti")


def soft_delete(target: DataFrame, source: DataFrame, keys: str | Sequence[str], run_ts: Column, column: str = "deleted_at") -> DataFrame:
    """The target with the time at which a row's key was first missing in the whole source; NULL for rows that are there (again)."""
    fields = by_upper_name(target.schema)
    keys = [fields[k.upper()].name for k in as_key_list(keys)]
    gone = deleted_keys(target, source, keys).select(*[F.col(k).alias(f"__gone_{k}") for k in keys])
    on = reduce(and_, [F.col(f"`{k}`") == F.col(f"__gone_{k}") for k in keys])
    before = F.col(f"`{column}`") if column in target.columns else F.lit(None).cast("timestamp_ntz")
    when = F.when(F.col(f"__gone_{keys[0]}").isNotNull(), F.coalesce(before, run_ts.cast("timestamp_ntz")))
    # Rows without a key are never missing: they keep what they have.
    when = F.when(any_null(keys), before).otherwise(when)
    kept = [F.col(f"`{c}`") for c in target.columns if c != column]
    return target.join(gone, on, "left").select(*kept, when.alias(column))
