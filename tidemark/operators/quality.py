"""Counts over keys and marks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.marks import as_enddate
from tidemark.functions.names import as_key_list


def any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def all_present(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def dq_profile(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows, rows with a NULL key, distinct keys (NULL counts as one) and duplicates, in one job.

    Rows are counted per key before the shuffle, so a key with a third of all
    rows costs one row per map task.
    """
    keys = as_key_list(keys)
    per_key = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    zero = F.lit(0).cast("long")
    return per_key.agg(
        F.coalesce(F.sum("copies"), zero).alias("total_rows"),
        F.coalesce(F.sum(F.when(any_null(keys), F.col("copies"))), zero).alias("null_keys"),
        F.count("*").alias("distinct_keys"),
    ).withColumn("duplicates", F.col("total_rows") - F.col("distinct_keys"))


def repeated_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys held by more than one row. NULL keys are left out: they match nothing."""
    keys = as_key_list(keys)
    counted = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    return counted.filter((F.col("copies") > 1) & all_present(keys))


def require_unique_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """`df` itself, once it is shown that no key occurs twice."""
    keys = as_key_list(keys)
    examples = repeated_keys(df, keys).take(3)
    if examples:
        raise ValueError(f"stage holds several rows for one key of {keys}, for example {examples}")
    return df


def high_water_mark(df: DataFrame, column: str) -> DataFrame:
    """The largest value of `column`, NULL if there is none, also as an end date."""
    dtype = df.select(column).schema[0].dataType
    top = df.agg(F.max(column).alias("mark"))
    return top.select("mark", as_enddate(F.col("mark"), dtype).alias("enddate"))
