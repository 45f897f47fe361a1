"""Schema comparison and additive evolution, and what they mean for the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from tidemark.functions.names import by_upper_name

NEW = "new"
MISMATCH = "type_mismatch"
TARGET_ONLY = "target_only"


@dataclass(frozen=True)
class ColumnDrift:
    column: str
    status: str
    source: StructField | None
    target: StructField | None


def _same_type(a: DataType, b: DataType, strict: bool) -> bool:
    return a.simpleString() == b.simpleString() if strict else type(a) is type(b)


def diff_schemas(source: StructType, target: StructType, strict: bool = False) -> list[ColumnDrift]:
    """Columns that differ. Types match by class; `strict` compares precision and elements too."""
    ours, theirs = by_upper_name(source), by_upper_name(target)
    drift = []
    for name, field in ours.items():
        if name not in theirs:
            drift.append(ColumnDrift(name, NEW, field, None))
        elif not _same_type(field.dataType, theirs[name].dataType, strict):
            drift.append(ColumnDrift(name, MISMATCH, field, theirs[name]))
    drift += [ColumnDrift(name, TARGET_ONLY, None, f) for name, f in theirs.items() if name not in ours]
    return drift


def _report(df: DataFrame, rows: list[dict[str, Column]]) -> DataFrame:
    """One aggregate pass over `df`, one output row per entry."""
    packed = F.array(*[F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows])
    return df.agg(packed.alias("report")).select(F.inline("report"))


def _type_name(field: StructField | None) -> Column:
    return F.lit(field.dataType.simpleString() if field else None).cast("string")


def schema_drift(source: DataFrame, target: DataFrame, strict: bool = False) -> DataFrame:
    """Differing columns with the number of values each difference touches.

    New and mismatched columns count the source's values, target-only columns the
    target's. Each side is scanned at most once and only in the columns that differ.
    """
    drift = diff_schemas(source.schema, target.schema, strict)

    def rows(side: str, entries: list[ColumnDrift]) -> list[dict[str, Column]]:
        return [
            {
                "column": F.lit(d.column),
                "status": F.lit(d.status),
                "source_type": _type_name(d.source),
                "target_type": _type_name(d.target),
                "non_null": F.count(F.col(f"`{getattr(d, side).name}`")),
            }
            for d in entries
        ]

    parts = []
    for df, side, wanted in ((source, "source", True), (target, "target", False)):
        entries = [d for d in drift if (d.status != TARGET_ONLY) is wanted]
        if entries:
            parts.append(_report(df, rows(side, entries)))
    if not parts:
        spark = source.sparkSession
        return spark.createDataFrame(
            [], "column string, status string, source_type string, target_type string, non_null bigint"
        )
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def type_drift_profile(source: DataFrame, target: StructType, strict: bool = False) -> DataFrame:
    """Per mismatched column, how many values a cast to the target's type would lose. One pass."""
    rows = []
    for d in diff_schemas(source.schema, target, strict):
        if d.status != MISMATCH:
            continue
        value = F.col(f"`{d.source.name}`")
        lost = ~_fits(value, d.source, d.target.dataType)
        rows.append(
            {
                "column": F.lit(d.column),
                "source_type": _type_name(d.source),
                "target_type": _type_name(d.target),
                "non_null": F.count(value),
                "lost": F.count_if(lost),
            }
        )
    if not rows:
        return source.sparkSession.createDataFrame(
            [], "column string, source_type string, target_type string, non_null bigint, lost bigint"
        )
    return _report(source, rows)


def evolve_schema(target: StructType, source: StructType) -> StructType:
    """The target's columns, then the source's new ones, nullable. Nothing is retyped or removed."""
    added = [d.source for d in diff_schemas(source, target) if d.status == NEW]
    return StructType(target.fields + [StructField(f.name, f.dataType, True) for f in added])


def add_columns(target: DataFrame, source: StructType) -> DataFrame:
    """The target with the source's new columns, NULL on every row it already has."""
    return conform(target, evolve_schema(target.schema, source))


def _fits(value: Column, field: StructField, dtype: DataType) -> Column:
    """Whether a value survives the cast: cast back, it is what it was. Text and nested values need only cast."""
    there = value.try_cast(dtype)
    if isinstance(field.dataType, (StringType, ArrayType, MapType, StructType)) or isinstance(dtype, StringType):
        return value.isNull() | there.isNotNull()
    return value.isNull() | F.coalesce(there.try_cast(field.dataType).eqNullSafe(value), F.lit(False))


def _checked_cast(column: Column, field: StructField, dtype: DataType) -> Column:
    """Cast to the target's type; a value the type cannot hold stops the load, in any ANSI mode."""
    if field.dataType.simpleString() == dtype.simpleString():
        return column
    converted = column.try_cast(dtype)
    failure = F.concat(
        F.lit(f"column {field.name}: value does not fit {dtype.simpleString()}: "), column.cast("string")
    )
    return F.when(~_fits(column, field, dtype), F.raise_error(failure).cast(dtype)).otherwise(converted)


def conform(df: DataFrame, schema: StructType, fill: bool = True) -> DataFrame:
    """Project `df` to the names, types and order of `schema`, matching names without case.

    Columns `df` lacks become NULL (or are left out if `fill` is false). Columns the
    schema lacks are an error: evolve the schema first. NOT NULL is enforced.
    """
    present = by_upper_name(df.schema)
    unknown = present.keys() - by_upper_name(schema).keys()
    if unknown:
        raise ValueError(f"columns missing from the target: {sorted(unknown)}")
    columns = []
    for field in schema.fields:
        own = present.get(field.name.upper())
        if own is None:
            if not fill:
                continue
            value = F.lit(None).cast(field.dataType)
        else:
            value = _checked_cast(F.col(f"`{own.name}`"), own, field.dataType)
        if not field.nullable and (own is None or own.nullable):
            failure = F.raise_error(F.lit(f"column {field.name} may not be NULL")).cast(field.dataType)
            value = F.coalesce(value, failure)
        columns.append(value.alias(field.name))
    return df.select(*columns)
