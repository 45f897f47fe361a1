"""The physical plans are the ones meant for large tables."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedupe_latest, dq_profile, high_water_mark, repeated_keys, upsert
from tidemark.operators.upsert import matched_keys
from tidemark.sources import incremental_scan

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **conf):
    names = {"spark.sql." + k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.fixture
def no_auto_broadcast(spark):
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        yield


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{SF_DIR}/orders.parquet")


def test_mark_and_columns_reach_the_scan(orders):
    plan = plan_of(incremental_scan(orders, "o_orderdate", "2000-01-01").select("o_orderkey"))
    assert "GreaterThan(o_orderdate,2000-01-01T00:00)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "Exchange" not in plan


def test_broadcast_upsert_does_not_shuffle_the_target(orders, no_auto_broadcast):
    stage = orders.filter("o_orderkey % 100 = 0")
    plan = plan_of(upsert(orders, stage, "o_orderkey", broadcast=True))
    shuffled = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(shuffled) == 1, "only the matched keys are shuffled, to be made distinct"
    assert "SortMergeJoin" not in plan


def test_shuffled_upsert_is_split_by_aqe_on_the_target_side(orders, no_auto_broadcast):
    plan = plan_of(upsert(orders, orders.filter("o_orderkey % 2 = 0"), "o_orderkey"))
    assert "LeftOuter" in plan and "FullOuter" not in plan
    assert "isnull(o_orderkey" in plan, "rows with a NULL key go around the join"


def test_matched_keys_combine_copies_before_the_shuffle(orders, no_auto_broadcast):
    plan = plan_of(matched_keys(orders, orders.filter("o_orderkey % 2 = 0"), "o_orderkey"))
    assert plan.index("LeftSemi") < plan.index("HashAggregate"), "the distinct lies below the join"
    assert "o_totalprice" not in plan


def test_full_outer_is_one_join(orders, no_auto_broadcast):
    plan = plan_of(upsert(orders, orders.filter("o_orderkey % 2 = 0"), "o_orderkey", unique_target=True))
    assert plan.count("SortMergeJoin") == 1


def test_profiles_combine_in_map_tasks_and_shuffle_once(orders):
    for df in (dq_profile(orders, "o_orderkey"), repeated_keys(orders, "o_orderkey")):
        plan = plan_of(df)
        assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan
        assert "o_totalprice" not in plan


def test_dedupe_keeps_one_row_per_key_in_each_map_task(orders):
    plan = plan_of(dedupe_latest(orders, "o_custkey", "o_orderdate"))
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", plan)


def test_mark_reads_one_column(orders):
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan_of(high_water_mark(orders, "o_orderdate"))


def _partition_sizes(df):
    sizes = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return [r["count"] for r in sizes]


def test_null_keys_do_not_meet_in_one_partition(spark, no_auto_broadcast, tmp_path):
    """A third of all rows without a key, on both sides of a shuffled upsert."""
    source = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"), F.col("id").alias("v")
    )
    source.write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    out = upsert(target, target.filter("k % 2 = 0 OR k IS NULL"), "k")
    with settings(spark, adaptive__coalescePartitions__enabled="false", shuffle__partitions="8"):
        sizes = _partition_sizes(out)
    assert sum(sizes) == 40_000
    assert max(sizes) < 5_000


def test_hot_target_key_is_split_by_aqe(spark, no_auto_broadcast, tmp_path):
    """A third of the target under one key: the partition is split, and every copy updated."""
    with settings(
        spark,
        adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="50KB",
    ):
        target = spark.range(0, 120_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.rand(1).alias("v")
        )
        target.write.parquet(str(tmp_path / "t"))
        target = spark.read.parquet(str(tmp_path / "t"))
        stage = spark.range(0, 60_000).select(F.col("id").alias("k"), F.lit(-1.0).alias("v"))
        out = upsert(target, stage, "k")
        out.write.parquet(str(tmp_path / "out"))
        done = spark.read.parquet(str(tmp_path / "out"))
        assert done.filter("k = 1 AND v = -1").count() == 40_001, "40,000 hot rows and id 1 itself"
        assert done.count() == 120_000 + stage.join(target, "k", "left_anti").count()
        out.collect()
        assert "skew=true" in plan_of(out)
