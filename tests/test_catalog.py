"""Targets that the session's catalog keeps."""

import datetime as dt
import threading
import uuid

import pytest

from tidemark import CatalogTarget, Process, sync, sync_all
from tidemark.plans.catalog import PART
from tidemark.plans.ledger import read_ledger

RUN, LATER = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)
COLUMNS = "k int, t int, v string"
P = Process("P", "src", "tgt", "SRC", incremental_column="t", keys=("k",))


@pytest.fixture
def target(spark, tmp_path):
    made = CatalogTarget(spark, f"t_{uuid.uuid4().hex}", str(tmp_path / "ledgers"), location=str(tmp_path / "table"))
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made.table}")


def run(spark, target, source, process=P, columns=COLUMNS, run_ts=RUN, **options):
    df = spark.createDataFrame(source, columns) if isinstance(source, list) else source
    return sync(spark, process, df, "", run_ts=run_ts, target=target, **options)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or ("k", "t", "v")).collect()), key=repr)


@pytest.mark.parametrize("bytes_", [64 << 20, -1])
def test_merge_writes_back_the_partitions_it_touches(spark, target, bytes_):
    first = run(spark, target, [(i, 1, "a") for i in range(100)] + [(None, 1, "n")], file_bytes=2000)
    assert (first.rows_inserted, first.rows_updated) == (101, 0)
    parts = spark.table(target.table).select(PART).distinct().count()
    assert parts > 3, "several ranges, and one for rows without a key"
    files = set(spark.table(target.table).inputFiles())
    second = run(spark, target, [(3, 2, None), (200, 2, "new"), (None, 2, "m")], run_ts=LATER, broadcast_bytes=bytes_)
    assert (second.rows_read, second.rows_updated, second.rows_inserted) == (3, 1, 2)
    want = [(i, 1, "a") for i in range(100) if i != 3] + [(3, 2, None), (200, 2, "new"), (None, 1, "n"), (None, 2, "m")]
    assert rows(target.read()) == sorted(want, key=repr)
    assert len(files - set(spark.table(target.table).inputFiles())) <= 2, "one range was written anew"
    loaded = {r.k: r.loaded_at for r in target.read().filter("k < 5").collect()}
    assert loaded[3] == LATER and loaded[4] == RUN
    assert run(spark, target, [(3, 2, "late")]).rows_read == 0


def test_columns_are_added_and_defaults_declared(spark, target):
    run(spark, target, [(1, 1, "a")])
    wide = run(spark, target, [(1, 2, "b", 1.5), (2, 2, "c", 2.5)], columns=COLUMNS + ", extra double")
    assert [(d.column, d.status) for d in wide.drift] == [("EXTRA", "new")]
    assert rows(target.read(), "k", "v", "extra", "source_system") == [(1, "b", 1.5, "SRC"), (2, "c", 2.5, "SRC")]
    spark.sql(f"INSERT INTO {target.table} (k, t, v) VALUES (9, 9, 'by hand')")
    assert target.read().filter("k = 9").first().source_system == "SRC"
    with pytest.raises(Exception, match="does not fit"):
        run(spark, target, [("x", 10, "d")], columns="k string, t int, v string")
    assert [r.status for r in target.ledger().orderBy("started_at").collect()] == ["committed", "committed", "failed"]


def test_append_full_and_empty_runs(spark, target):
    append = Process("P", "src", "tgt", "SRC", incremental_column="t")
    run(spark, target, [(1, 1, "a")], append)
    assert rows(run(spark, target, [(1, 1, "a"), (1, 2, "b")], append).target) == [(1, 1, "a"), (1, 2, "b")]
    assert run(spark, target, [(1, 1, "a")], append).rows_read == 0
    with pytest.raises(ValueError, match="load it in full"):
        run(spark, target, [(1, 3, "c")], P)
    full = Process("F", "src", "tgt", "SRC", load_type="FULL", keys=("k",))
    run(spark, target, [(5, 1, "z"), (6, 1, "y")], full)
    assert rows(target.read()) == [(5, 1, "z"), (6, 1, "y")]
    assert rows(run(spark, target, [(5, 7, "w")], P).target) == [(5, 7, "w"), (6, 1, "y")]
    assert run(spark, target, [], full).target.count() == 0


def test_a_table_of_another_making_needs_a_format_that_rewrites_rows(spark, target, tmp_path):
    spark.sql(f"CREATE TABLE {target.table} (k INT, t INT, v STRING, loaded_at TIMESTAMP_NTZ, source_system STRING) USING parquet LOCATION '{tmp_path}/own'")
    spark.sql(f"INSERT INTO {target.table} VALUES (1, 1, 'a', TIMESTAMP_NTZ'2024-01-01', 'O')")
    assert run(spark, target, [(2, 5, "b")], Process("A", "src", "tgt", "SRC", incremental_column="t")).target.count() == 2
    with pytest.raises(Exception, match="(?i)merge"):
        run(spark, target, [(1, 9, "x")])
    assert target.read().count() == 2


def test_unchanged_rows_keep_their_load_time(spark, target):
    run(spark, target, [(1, 1, "a"), (2, 1, "b")])
    again = Process("P", "src", "tgt", "SRC", keys=("k",))
    out = run(spark, target, [(1, 1, "a"), (2, 1, "c")], again, run_ts=LATER, skip_unchanged=True)
    assert out.rows_updated == 1
    assert rows(target.read(), "k", "v", "loaded_at") == [(1, "a", RUN), (2, "c", LATER)]


def test_targets_are_loaded_side_by_side_and_one_target_in_order(spark, tmp_path):
    shape = """PROCESS_NAME string, SOURCE_SYSTEM string, LOAD_TYPE string, SOURCE_TABLE_NAME string, TARGET_TABLE_NAME string, _CONDITION string, PRIMARY_KEY string"""
    control = [(f"P{i}", "SRC", "INCREMENTAL", f"s{i}", f"t{i % 3}", "id", "id") for i in range(6)]
    control.append(("BAD", "SRC", "INCREMENTAL", "bad", "t9", "id", "id"))
    threads, order = set(), []

    def read(process):
        threads.add(threading.current_thread().name)
        order.append(process.name)
        if process.name == "BAD":
            raise OSError("no such source")
        return spark.range(int(process.name[1:]) + 3).selectExpr("id", f"'{process.name}' AS v")

    with pytest.raises(ExceptionGroup) as failed:
        sync_all(spark, spark.createDataFrame(control, shape), read, str(tmp_path), workers=3, run_ts=RUN)
    assert [str(e) for e in failed.value.exceptions] == ["no such source"] and len(threads) > 1
    assert [order.index(f"P{i}") < order.index(f"P{i + 3}") for i in range(3)] == [True] * 3
    good = sync_all(spark, spark.createDataFrame(control[:6], shape), read, str(tmp_path / "again"), workers=3, run_ts=RUN)
    alone = sync_all(spark, spark.createDataFrame(control[:6], shape), read, str(tmp_path / "alone"), run_ts=RUN)
    assert [r.process.name for r in good] == [f"P{i}" for i in range(6)]
    assert [rows(r.target, "id", "v") for r in good] == [rows(r.target, "id", "v") for r in alone]
    assert read_ledger(spark, f"{tmp_path}/t9/ledger").first().status == "failed"
