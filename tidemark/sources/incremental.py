"""Rows past the high-water mark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.marks import mark_literal


def incremental_scan(
    df: DataFrame, column: str | None, mark: object | None, inclusive: bool = False, zone: str = "UTC"
) -> DataFrame:
    """Rows whose `column` is past `mark`; NULLs never are. Without a mark, every row.

    Strict by default: a row that arrives later with the very value of the mark
    is not read. `inclusive` reads the mark's own rows again, which is safe when
    the load is an upsert.
    """
    if not column or mark is None or mark == "":
        return df
    bound = mark_literal(df.sparkSession, mark, df.select(column).schema[0].dataType, zone)
    return df.filter(F.col(column) >= bound if inclusive else F.col(column) > bound)
