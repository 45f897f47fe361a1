"""Measured in-memory width of rows, the evidence for every broadcast."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F
from pyspark.sql.types import BinaryType, DecimalType, StringType, StructType

from tidemark.functions.layout import NESTED

BROADCAST_BYTES = 64 * 1024 * 1024
_WORD = 8


def row_bytes(schema: StructType) -> Column:
    """Bytes one row takes: a word per column and for the row, plus what varies in length."""
    varying = []
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            varying.append(F.octet_length(column))
        elif isinstance(field.dataType, NESTED):
            # Nested values take up to a word per element; their JSON text, with NULL
            # fields spelled out, has two bytes or more each.
            varying.append(F.octet_length(F.to_json(column, {"ignoreNullFields": "false"})) * 4)
        elif isinstance(field.dataType, DecimalType):
            varying.append(F.lit(2 * _WORD))
    fixed = F.lit(_WORD * (len(schema.fields) + 2)).cast("long")
    return reduce(add, [F.coalesce(v.cast("long"), F.lit(0)) for v in varying], fixed)
