"""Physical types of the target, applied to a whole table as one projection.

Scalars keep their type. Zoned timestamps become zone-free in a stated zone, also
inside arrays, maps and structs. Nested values stay nested, become JSON text (`flat`, or
"json"), or a variant. A column that is zone-free, varchar or char already is not turned
into a variant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    CharType,
    DataType,
    MapType,
    NullType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
    VarcharType,
    VariantType,
)

NESTED = (ArrayType, MapType, StructType, VariantType)
KEEP, JSON, VARIANT = "keep", "json", "variant"


def _layout(flat: bool, nested: str) -> str:
    if nested not in (KEEP, JSON, VARIANT):
        raise ValueError(f"unknown layout of nested values: {nested!r}")
    return JSON if flat else nested


def physical_type(dtype: DataType, flat: bool = False, nested: str = KEEP) -> DataType:
    """The type that a column of `dtype` has in the target."""
    layout = _layout(flat, nested)
    if isinstance(dtype, NESTED) and layout != KEEP:
        return StringType() if layout == JSON else VariantType()
    return _inner_type(dtype)


def _inner_type(dtype: DataType) -> DataType:
    if isinstance(dtype, TimestampType):
        return TimestampNTZType()
    if isinstance(dtype, (VarcharType, CharType, NullType)):
        return StringType()
    if isinstance(dtype, ArrayType):
        return ArrayType(_inner_type(dtype.elementType), dtype.containsNull)
    if isinstance(dtype, MapType):
        return MapType(_inner_type(dtype.keyType), _inner_type(dtype.valueType), dtype.valueContainsNull)
    if isinstance(dtype, StructType):
        return StructType([StructField(f.name, _inner_type(f.dataType), f.nullable) for f in dtype.fields])
    return dtype


def without_zone(column: Column, zone: str = "UTC") -> Column:
    """The wall-clock time of an instant in `zone`, whatever the session zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(column), epoch)
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def _inner(column: Column, dtype: DataType, zone: str) -> Column:
    """A value with everything in it in its physical type. What has it already is left as it is.

    Two instants can have one wall-clock time where clocks go back, so those that are
    keys of a map, which must differ, are given in UTC.
    """
    target = _inner_type(dtype)
    if target == dtype:
        return column
    if isinstance(dtype, TimestampType):
        return without_zone(column, zone)
    if isinstance(dtype, ArrayType):
        return F.transform(column, lambda x: _inner(x, dtype.elementType, zone))
    if isinstance(dtype, MapType):
        if target.keyType != dtype.keyType:
            column = F.transform_keys(column, lambda k, _: _inner(k, dtype.keyType, "UTC"))
        if target.valueType != dtype.valueType:
            column = F.transform_values(column, lambda _, v: _inner(v, dtype.valueType, zone))
        return column
    if isinstance(dtype, StructType):
        fields = [_inner(column.getField(f.name), f.dataType, zone).alias(f.name) for f in dtype.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column.cast(target)


def _text_keys(column: Column, dtype: DataType) -> Column:
    """A variant's objects have text as keys."""
    if isinstance(dtype, MapType):
        column = F.transform_values(column, lambda _, v: _text_keys(v, dtype.valueType))
        return F.transform_keys(column, lambda k, _: k.cast("string"))
    if isinstance(dtype, ArrayType):
        return F.transform(column, lambda x: _text_keys(x, dtype.elementType))
    if isinstance(dtype, StructType):
        return F.when(column.isNotNull(), F.struct(*[_text_keys(column.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]))
    return column


def to_layout(df: DataFrame, flat: bool = False, zone: str = "UTC", nested: str = KEEP) -> DataFrame:
    """Project every column to its physical type; unchanged columns stay prunable and pushable."""
    layout = _layout(flat, nested)

    def lay_out(name: str, dtype: DataType) -> Column:
        column = F.col(f"`{name}`")
        if physical_type(dtype, nested=layout) == dtype:
            return column
        made = _inner(column, dtype, zone)
        if isinstance(dtype, NESTED) and layout == JSON:
            made = F.to_json(made)
        elif isinstance(dtype, NESTED) and layout == VARIANT:
            made = F.to_variant_object(_text_keys(made, _inner_type(dtype)))
        return made.alias(name)

    return df.select(*[lay_out(f.name, f.dataType) for f in df.schema.fields])
