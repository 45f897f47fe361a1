"""Table scans. Connection details always come from the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_files(
    spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet", schema: StructType | None = None, **options: str
) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path if isinstance(path, str) else list(path))


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    split: tuple[str, object, object, int] | None = None,
    fetchsize: int = 10_000,
    **options: str,
) -> dict[str, str]:
    """Reader options for a table or a derived table, read whole or in ranges of a split column.

    Spark takes `query` or a split, not both; a split query goes in as a derived table.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    made = {"url": url, "fetchsize": str(fetchsize), "preferTimestampNTZ": "true"}
    if query is not None and split is None:
        made["query"] = query
    else:
        made["dbtable"] = table if table is not None else f"({query}) derived"
    if split is not None:
        column, lower, upper, parts = split
        made |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }
    return made | options


def read_jdbc(spark: SparkSession, url: str, predicates: Sequence[str] | None = None, **spec) -> DataFrame:
    """JDBC scan, one partition per split range or per predicate. Spark pushes filters into it."""
    options = jdbc_options(url, **spec)
    if predicates is None:
        return spark.read.format("jdbc").options(**options).load()
    if "dbtable" not in options or "partitionColumn" in options:
        raise ValueError("predicates go with a table and replace a split")
    return spark.read.jdbc(
        options.pop("url"), options.pop("dbtable"), predicates=list(predicates), properties=options
    )


def mod_predicates(column: str, parts: int) -> list[str]:
    """Even JDBC partitions over a unique integer key whose ranges are uneven. NULL goes to the first."""
    tests = [f"MOD(ABS({column}), {parts}) = {i}" for i in range(parts)]
    return [f"({tests[0]} OR {column} IS NULL)", *tests[1:]]


def split_bounds(spark: SparkSession, url: str, table: str, column: str, **options: str) -> tuple[object, object]:
    """Smallest and largest split value, computed by the database."""
    row = read_jdbc(
        spark, url, query=f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}", **options
    ).first()
    return row[0], row[1]


def read_connector(
    spark: SparkSession, fmt: str, table: str | None = None, query: str | None = None, **options: str
) -> DataFrame:
    """A warehouse table or a query that the warehouse runs, through its Spark connector."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    what = {"dbtable": table} if table is not None else {"query": query}
    return spark.read.format(fmt).options(**options, **what).load()


def preview(df: DataFrame, n: int, *order_by: str) -> DataFrame:
    """The first n rows; with an order it is a top-n plan and the same on every run."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
