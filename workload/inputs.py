"""Change history derived from single snapshots by predicate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.audit import with_audit

MARK = "2000-01-01 00:00:00"
OLD_MARK = "2000-12-31 00:00:00"
RUN = dt.datetime(2025, 1, 1)
SOURCE = "SRC"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def old_target(orders: DataFrame) -> DataFrame:
    """T0: the orders as an earlier load left them: up to a later day than the mark, at older prices."""
    return (
        orders.filter(F.col("o_orderdate") <= ntz(OLD_MARK))
        .withColumn("o_totalprice", F.floor("o_totalprice").cast("double"))
        .withColumn("source_system", F.lit("OLD"))
        .withColumn("loaded_at", ntz("2024-01-01 00:00:00"))
    )


def delta(orders: DataFrame) -> DataFrame:
    """S: orders past the mark."""
    return orders.filter(F.col("o_orderdate") > ntz(MARK))


def delta_with_nulls(orders: DataFrame) -> DataFrame:
    """S with NULL prices on urgent orders, plus a copy of pending ones with NULL keys."""
    priced = delta(orders).withColumn(
        "o_totalprice", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice"))
    )
    keyless = priced.filter(F.col("o_orderstatus") == "P").withColumn("o_orderkey", F.lit(None).cast("long"))
    return priced.unionByName(keyless)


def audited(rows: DataFrame) -> DataFrame:
    return with_audit(rows, ntz(str(RUN)), SOURCE)


def control_rows(customer: DataFrame) -> DataFrame:
    """A control table with one process per customer."""
    return customer.select(
        F.col("c_name").alias("PROCESS_NAME"),
        F.when(F.col("c_acctbal") >= 0, "Y").when(F.col("c_acctbal") >= -500, "N").alias("ACTIVE_FLAG"),
        F.col("c_mktsegment").alias("SOURCE_SYSTEM"),
        F.when(F.col("c_nationkey") < 12, "DWH").otherwise("LAKE").alias("TARGET_SYSTEM"),
        F.when(F.col("c_acctbal") > 5000, "FULL").otherwise("INCREMENTAL").alias("LOAD_TYPE"),
    )


def run_rows(orders: DataFrame) -> DataFrame:
    """A run ledger with one process per customer and one run per order."""
    return orders.select(
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("process_name"),
        F.col("o_orderpriority").alias("source_table"),
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderdate").cast("string").alias("mark"),
        F.col("o_orderdate").alias("enddate"),
        F.expr("o_orderdate - make_dt_interval(0, 0, 0, o_custkey)").alias("started_at"),
        F.col("o_orderdate").alias("finished_at"),
        (F.col("o_orderkey") * 3).alias("rows_read"),
        F.col("o_orderkey").alias("rows_updated"),
        (F.col("o_orderkey") * 2).alias("rows_inserted"),
    )
