import pytest

from tidemark.session import fresh_dir, shared_dir, size_shuffles, sized_shuffles


class FakeSession:
    """Just the settings that `shared_dir` reads."""

    def __init__(self, master, configured=None):
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}
        self.sparkContext = type("Context", (), {"master": master, "getCheckpointDir": lambda self: None})()


def test_the_cluster_names_the_shared_folder():
    assert shared_dir(FakeSession("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession("yarn"))
    assert "tidemark-" in shared_dir(FakeSession("local[2]"))


def test_each_run_gets_a_new_folder(spark):
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_shuffles_start_from_enough_partitions(spark):
    other = spark.newSession()
    gib = 1024**3
    assert size_shuffles(other, 100 * 1024 * gib)["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == str(
        4 * 100 * 1024
    )
    few = size_shuffles(other, 10)["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    assert few == spark.conf.get("spark.sql.shuffle.partitions")
    assert other.conf.get("spark.sql.files.maxPartitionBytes") == str(gib // 4)


def test_a_run_gives_the_settings_back(spark):
    other, name = spark.newSession(), "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = other.conf.get(name, None)
    with sized_shuffles(other, 100 * 1024**4):
        assert other.conf.get(name) == str(4 * 100 * 1024)
    assert other.conf.get(name, None) == before
    with sized_shuffles(other, 10):
        assert other.conf.get(name, None) == before
