import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.functions.marks import mark_literal
from tidemark.sinks import merge_into, write_connector
from tidemark.sources import incremental_scan, mod_predicates, preview, read_connector, read_files
from tidemark.sources.tables import jdbc_options

URL = "jdbc:somedb://host/db"


def rows(spark, cast):
    days = [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03"), (4, None)]
    return spark.createDataFrame(days, "id int, t string").select("id", F.col("t").cast(cast).alias("t"))


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("cast", ["date", "timestamp_ntz", "timestamp", "string"])
def test_mark_is_strict_and_null_is_never_past_it(spark, cast):
    df = rows(spark, cast)
    zone = spark.conf.get("spark.sql.session.timeZone")
    assert ids(incremental_scan(df, "t", "2024-01-02", zone=zone)) == [3]
    assert ids(incremental_scan(df, "t", "2024-01-02", inclusive=True, zone=zone)) == [2, 3]


def test_mark_keeps_its_time_of_day(spark):
    times = [(1, dt.datetime(2024, 1, 1, 10, 0, 0, 5)), (2, dt.datetime(2024, 1, 1, 10, 0, 0, 6))]
    df = spark.createDataFrame(times, "id int, t timestamp_ntz")
    assert ids(incremental_scan(df, "t", dt.datetime(2024, 1, 1, 10, 0, 0, 5))) == [2]
    assert ids(incremental_scan(df, "t", "2024-01-01 10:00:00.000005")) == [2]


def test_numeric_mark_compares_as_number(spark):
    df = spark.createDataFrame([(9,), (10,), (100,)], "id bigint")
    assert ids(incremental_scan(df, "id", "9")) == [10, 100]
    assert ids(incremental_scan(df, "ID", 10)) == [100]


def test_no_mark_or_no_column_reads_all(spark):
    df = rows(spark, "date")
    for column, mark in ((None, "2024-01-02"), ("t", None), ("t", ""), ("", "2024-01-02")):
        assert ids(incremental_scan(df, column, mark)) == [1, 2, 3, 4]


def test_mark_of_another_type_is_refused(spark):
    with pytest.raises(ValueError, match="is not a bigint"):
        incremental_scan(spark.range(3), "id", "2024-01-01 00:00:00")


def test_zoned_column_reads_the_mark_in_the_stated_zone(spark):
    df = spark.sql("SELECT 1 AS id, timestamp'2024-01-01 00:30:00 UTC' AS t")
    assert ids(incremental_scan(df, "t", "2024-01-01 00:00:00")) == [1]
    assert ids(incremental_scan(df, "t", "2024-01-01 01:00:00", zone="Europe/Berlin")) == [1]
    assert ids(incremental_scan(df, "t", "2024-01-01 01:30:00", zone="Europe/Berlin")) == []
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert ids(incremental_scan(df, "t", "2024-01-01 00:00:00")) == [1]
        assert ids(incremental_scan(df, "t", "2024-01-01 00:30:00")) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_mark_literal_is_a_constant(spark):
    literal = mark_literal(spark, "2024-01-01", spark.sql("SELECT timestamp_ntz'2024-01-01' t").schema["t"].dataType)
    plan = spark.range(1).filter(literal > F.lit("2023-01-01").cast("timestamp_ntz"))
    assert "Filter" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_jdbc_options_table_query_and_split():
    assert jdbc_options(URL, table="t")["dbtable"] == "t"
    assert jdbc_options(URL, query="SELECT 1")["query"] == "SELECT 1"
    split = jdbc_options(URL, query="SELECT * FROM t", split=("id", 1, 1000, 16), user="u")
    assert split["dbtable"] == "(SELECT * FROM t) derived" and "query" not in split
    assert (split["partitionColumn"], split["numPartitions"], split["user"]) == ("id", "16", "u")
    with pytest.raises(ValueError):
        jdbc_options(URL)
    with pytest.raises(ValueError):
        jdbc_options(URL, table="t", query="SELECT 1")


def test_mod_predicates_cover_every_row_once(spark):
    df = spark.createDataFrame([(i,) for i in range(-50, 50)] + [(None,)], "k bigint")
    parts = [df.filter(p).count() for p in mod_predicates("k", 4)]
    assert sum(parts) == 101 and max(parts) < 30


def test_preview(spark):
    assert [r.id for r in preview(spark.range(100), 3, "id").collect()] == [0, 1, 2]
    assert preview(spark.range(100), 3).count() == 3


def test_connector_round_trip_and_argument_check(spark, tmp_path):
    path = str(tmp_path / "t")
    write_connector(spark.range(10), "parquet", "t", mode="overwrite", partitions=2, path=path)
    write_connector(spark.range(5), "parquet", "t", path=path)
    assert read_connector(spark, "parquet", table="t", path=path).count() == 15
    assert read_files(spark, [path]).count() == 15
    with pytest.raises(ValueError):
        read_connector(spark, "parquet")


def test_merge_into_resolves_and_leaves_the_rest_to_the_catalog(spark):
    """Parquet cannot rewrite rows: the plan gets as far as that, with all columns resolved."""
    spark.sql("CREATE TABLE IF NOT EXISTS merge_target (k INT, v STRING, loaded_at TIMESTAMP_NTZ) USING parquet")
    stage = spark.sql("SELECT 1 AS k, 'x' AS v, timestamp_ntz'2024-01-01' AS loaded_at")
    try:
        with pytest.raises(Exception, match="MERGE|UNSUPPORTED") as failure:
            merge_into(stage, "merge_target", "k")
        assert "UNRESOLVED" not in str(failure.value)
    finally:
        spark.sql("DROP TABLE merge_target")


def test_missing_path_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_files(spark, str(tmp_path / "none"))
