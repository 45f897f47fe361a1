"""High-water marks: stored as text with their type, compared as typed literals."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, SparkSession, functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

_HAS_ZONE = re.compile(r":\d\d(\.\d+)?\s*(Z|[+-]\d\d?:?\d*|[A-Za-z]+/\w+|UTC.*)$")


def mark_text(value: object) -> str:
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return str(value)


def mark_literal(spark: SparkSession, value: object, dtype: DataType, zone: str = "UTC") -> Column:
    """`value` as a literal of the column's own type, so that the scan can push the filter.

    A mark that cannot be read as that type is an error: compared as text it
    would select the wrong rows, and as NULL it would select none.
    """
    text = mark_text(value)
    if isinstance(dtype, TimestampType) and not _HAS_ZONE.search(text):
        text = f"{text} {zone}" if ":" in text else f"{text} 00:00:00 {zone}"
    name = dtype.simpleString()
    unreadable = spark.sql(f"SELECT try_cast(:mark AS {name}) IS NULL AS bad", {"mark": text}).first().bad
    if unreadable:
        raise ValueError(f"mark {text!r} is not a {name}")
    return F.lit(text).cast(dtype)


def as_enddate(value: Column, dtype: DataType) -> Column:
    """Date or timestamp marks as a zone-free timestamp; other marks have no end date."""
    if isinstance(dtype, (DateType, TimestampNTZType)):
        return value.cast("timestamp_ntz")
    return F.lit(None).cast("timestamp_ntz")


def batch_id(run_ts: Column) -> Column:
    return F.date_format(run_ts, "yyyyMMddHHmmss")
