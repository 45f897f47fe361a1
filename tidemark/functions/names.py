"""Column names are matched without regard to case."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql.types import StructField, StructType


def by_upper_name(schema: StructType) -> dict[str, StructField]:
    """Fields keyed by upper-cased name; names equal but for case are refused."""
    fields: dict[str, StructField] = {}
    for field in schema.fields:
        other = fields.setdefault(field.name.upper(), field)
        if other is not field:
            raise ValueError(f"columns {other.name!r} and {field.name!r} differ only in case")
    return fields


def as_key_list(keys: str | Iterable[str]) -> list[str]:
    names = [keys] if isinstance(keys, str) else list(keys)
    if not names:
        raise ValueError("at least one key column is needed")
    return names
