import datetime as dt

import pytest

from tidemark import Process, TargetStore, select_processes, sync_all
from tidemark.plans.ledger import ledger_current, read_ledger

SCHEMA = """PROCESS_NAME string, ACTIVE_FLAG string, SOURCE_SYSTEM string, TARGET_SYSTEM string, LOAD_TYPE string,
SOURCE_TABLE_NAME string, TARGET_TABLE_NAME string, _CONDITION string, PRIMARY_KEY string, ENDDATE timestamp"""


def control(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def row(name="P", active="Y", load="INCREMENTAL", keys="id", enddate=None):
    return (name, active, "SRC", "DWH", load, "src_" + name, "tgt_" + name, "id", keys, enddate)


def test_all_matching_rows_are_kept_and_null_matches_nothing(spark):
    table = control(spark, row("A"), row("B"), row("C", active="N"), row("D", active=None), row("E", load=None))
    chosen = select_processes(table, source_system="SRC", load_type="INCREMENTAL")
    assert sorted(r.PROCESS_NAME for r in chosen.collect()) == ["A", "B"]
    assert select_processes(table, process_name="A").count() == 1
    assert select_processes(table, source_system="OTHER").count() == 0


def test_no_active_process_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no active process"):
        sync_all(spark, control(spark, row()).filter("false"), None, str(tmp_path))


@pytest.mark.parametrize(
    ("load", "keys", "mode"),
    [("INCREMENTAL", ("k",), "merge"), ("INCREMENTAL", (), "append"), ("FULL", ("k",), "full")],
)
def test_mode(load, keys, mode):
    assert Process("P", "s", "t", "SRC", load_type=load, keys=keys).mode == mode


def test_an_unknown_load_type_is_an_error():
    with pytest.raises(ValueError, match="INCREMENTL"):
        Process("P", "s", "t", "SRC", load_type="INCREMENTL")


def test_control_row_binds_composite_keys(spark):
    process = Process.from_row(control(spark, row(keys="a, b")).first())
    assert process.keys == ("a", "b") and process.incremental_column == "id"


def test_sync_all_runs_every_process_and_keeps_separate_ledgers(spark, tmp_path):
    table = control(spark, row("A"), row("B", load="FULL"), row("C", keys=None))
    sizes = {"src_A": 3, "src_B": 4, "src_C": 5}
    read = lambda p: spark.range(sizes[p.source_table]).selectExpr("id", "id * 2 AS v")
    results = sync_all(spark, table, read, str(tmp_path), run_ts=dt.datetime(2025, 1, 1))
    assert {r.process.name: r.target.count() for r in results} == {"A": 3, "B": 4, "C": 5}
    newest = ledger_current(read_ledger(spark, f"{tmp_path}/*/ledger"), "process_name").collect()
    assert {r.process_name: (r["mode"], r.mark, r.batch_id) for r in newest} == {
        "A": ("merge", "2", "20250101000000"),
        "B": ("full", "3", "20250101000000"),
        "C": ("append", "4", "20250101000000"),
    }


def test_ledger_of_nothing(spark, tmp_path):
    store = TargetStore(spark, str(tmp_path), "none")
    assert store.ledger() is None and not store.exists() and store.state().run_id == 0
    with pytest.raises(ValueError, match="no committed target"):
        store.read()


def test_zoned_enddate_of_the_control_table_is_read_in_utc(spark, tmp_path):
    """The driver's own time zone plays no part."""
    table = control(spark, row("A")[:-1] + (None,)).drop("ENDDATE").selectExpr(
        "*", "timestamp'2024-01-01 12:00:00 UTC' AS ENDDATE"
    ).drop("_CONDITION").selectExpr("*", "'t' AS _CONDITION")
    source = spark.sql("SELECT id, timestamp_ntz'2024-01-01 12:00:00' + make_dt_interval(0, 0, 0, id - 1) AS t FROM range(1, 3)")
    result = sync_all(spark, table, lambda p: source, str(tmp_path))[0]
    assert [r.id for r in result.target.collect()] == [2]


def test_control_names_in_any_case_and_targets_of_equal_name_kept_apart(spark, tmp_path):
    base = control(spark, row("A")).selectExpr("* EXCEPT (TARGET_TABLE_NAME)", "'tgt' AS target_table_name")
    table = base.selectExpr("*", "'dw' AS TARGET_DATABASE", "'x' AS TARGET_SCHEMA").unionByName(
        base.selectExpr("*", "'dw' AS TARGET_DATABASE", "'y' AS TARGET_SCHEMA")
    )
    results = sync_all(spark, table, lambda p: spark.range(3), str(tmp_path))
    assert [r.process.target_name for r in results] == ["dw.x.tgt", "dw.y.tgt"]
    assert [r.run_id for r in results] == [1, 1]
    assert TargetStore(spark, str(tmp_path), "dw.y.tgt").read().count() == 3


def test_keys_given_as_text_are_refused():
    with pytest.raises(TypeError, match="tuple"):
        Process("P", "s", "t", "SRC", keys="id")
