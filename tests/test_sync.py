import dataclasses
import datetime as dt
import importlib

import pytest
from pyspark.sql import functions as F

import tidemark.plans.store as store_module
from tidemark import Process, TargetStore, sync
from tidemark.plans.ledger import COMMITTED, FAILED
from tidemark.session import shared_dir

sync_module = importlib.import_module("tidemark.plans.sync")

RUN = dt.datetime(2025, 1, 1)
LATER = dt.datetime(2025, 2, 1)
P = Process("P", "src", "tgt", "SRC", incremental_column="t", keys=("k",))
COLUMNS = "k int, t int, v string"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or ("k", "t", "v")).collect()), key=repr)


class Fixture:
    def __init__(self, spark, root, broadcast_bytes):
        self.spark, self.root, self.broadcast_bytes = spark, root, broadcast_bytes
        self.store = TargetStore(spark, root, "tgt")

    def run(self, source, process=P, columns=COLUMNS, run_ts=RUN, **options):
        df = self.spark.createDataFrame(source, columns) if isinstance(source, list) else source
        options = {"broadcast_bytes": self.broadcast_bytes} | options
        return sync(self.spark, process, df, self.root, run_ts=run_ts, **options)

    def files(self):
        return {r.slice for r in self.store.slices(self.store.state().version).collect()}


@pytest.fixture(params=[64 << 20, -1], ids=["broadcast", "shuffle"])
def fx(request, spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param < 0:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Fixture(spark, str(tmp_path), request.param)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_first_load_then_increment(fx):
    first = fx.run([(1, 1, "a"), (2, 2, "b"), (None, 2, "n")])
    assert (first.rows_read, first.rows_updated, first.rows_inserted, first.mark) == (3, 0, 3, "2")
    # Row 1 changed; row 2 did not; row 3 is new; a keyless row comes again; row 4 is late and never read.
    second = fx.run([(1, 3, None), (2, 2, "b"), (3, 4, "c"), (None, 3, "m"), (4, 2, "late")], run_ts=LATER)
    assert (second.rows_read, second.rows_updated, second.rows_inserted, second.mark) == (3, 1, 2, "4")
    assert rows(fx.store.read()) == sorted(
        [(1, 3, None), (2, 2, "b"), (3, 4, "c"), (None, 2, "n"), (None, 3, "m")], key=repr
    )
    loaded = {r.k: r.loaded_at for r in fx.store.read().filter("k IS NOT NULL").collect()}
    assert loaded == {1: LATER, 2: RUN, 3: LATER}
    assert {r.source_system for r in fx.store.read().collect()} == {"SRC"}


def test_seed_mark_applies_until_a_run_sets_one(fx):
    seeded = Process("P", "src", "tgt", "SRC", incremental_column="t", keys=("k",), enddate=1)
    assert rows(fx.run([(1, 1, "a"), (2, 2, "b")], seeded).target) == [(2, 2, "b")]
    assert fx.run([(1, 1, "a"), (2, 2, "b")], seeded).rows_read == 0


def test_empty_batch_changes_nothing_but_the_ledger(fx):
    fx.run([(1, 1, "a")])
    files = fx.files()
    empty = fx.run([(1, 1, "a")], run_ts=LATER)
    assert (empty.rows_read, empty.mark, fx.files()) == (0, "1", files)
    assert fx.store.state().run_id == 2 and rows(fx.store.read()) == [(1, 1, "a")]


def test_empty_first_run_creates_the_target(fx):
    assert not fx.store.exists()
    empty = fx.run([])
    assert fx.store.exists() and empty.target.count() == 0 and empty.mark is None
    assert fx.store.read().columns == ["k", "t", "v", "loaded_at", "source_system"]
    assert rows(fx.run([(1, 1, "a")]).target) == [(1, 1, "a")]


def test_inclusive_rerun_is_idempotent_and_sees_late_rows_of_the_mark(fx):
    fx.run([(1, 1, "a"), (2, 2, "b")])
    again = fx.run([(1, 1, "a"), (2, 2, "b"), (3, 2, "c")], inclusive=True)
    assert (again.rows_read, again.rows_updated, again.rows_inserted) == (2, 1, 1)
    assert rows(again.target) == [(1, 1, "a"), (2, 2, "b"), (3, 2, "c")]


def test_repeated_stage_keys_stop_the_run_or_keep_the_latest(fx):
    fx.run([(1, 1, "a")])
    repeated = [(1, 2, "x"), (1, 3, "y"), (None, 2, "n"), (None, 2, "n")]
    with pytest.raises(ValueError, match="more than once"):
        fx.run(repeated)
    assert rows(fx.store.read()) == [(1, 1, "a")] and fx.store.state().run_id == 1
    latest = fx.run(repeated, duplicates="latest")
    assert rows(latest.target) == sorted([(1, 3, "y"), (None, 2, "n"), (None, 2, "n")], key=repr)
    assert (latest.rows_read, latest.rows_updated, latest.rows_inserted) == (4, 1, 2)


def test_repeated_keys_in_a_first_load(fx):
    repeated = [(1, 2, "x"), (1, 3, "y")]
    with pytest.raises(ValueError, match="more than once"):
        fx.run(repeated)
    assert not fx.store.exists()
    latest = fx.run(repeated, duplicates="latest")
    assert rows(latest.target) == [(1, 3, "y")] and (latest.rows_read, latest.rows_inserted) == (2, 1)


def test_only_files_with_a_match_are_replaced(fx):
    source = [(i, i, "a") for i in range(100)]
    old = fx.spark.createDataFrame(source, COLUMNS)
    audited = old.selectExpr("*", "timestamp_ntz'2024-01-01' AS loaded_at", "'OLD' AS source_system")
    fx.store.adopt(audited, "k", 2240)
    before = fx.files()
    assert len(before) == 5
    fx.run([(3, 200, "z"), (4, 201, "z"), (500, 202, "new")])
    assert len(before - fx.files()) == 1, "one of five slices held keys 3 and 4"
    before = fx.files()
    fx.run([(501, 300, "new")])
    assert before <= fx.files(), "an insert replaces nothing"
    expected = [(i, i, "a") for i in range(100) if i not in (3, 4)]
    expected += [(3, 200, "z"), (4, 201, "z"), (500, 202, "new"), (501, 300, "new")]
    assert rows(fx.store.read()) == sorted(expected, key=repr)


def near(fx, key, *keys):
    stage = fx.spark.createDataFrame([(k,) for k in keys], f"{key} int")
    return fx.store.near(fx.store.state(), stage, [key]).count()


def ranged_target(fx, key):
    """Five slices of twenty keys each, and one whose keys are all NULL."""
    keyed = fx.spark.range(100).selectExpr("CAST(id AS int) AS k", "CAST(id AS int) AS t", "'a' AS v")
    none = keyed.limit(3).selectExpr("CAST(NULL AS int) AS k", "t", "v").coalesce(1)
    rows = keyed.union(none)
    fx.store.adopt(rows.selectExpr("*", "timestamp_ntz'2024-01-01' AS loaded_at", "'O' AS source_system"), key, 2308)


def test_slices_apart_from_the_stage_are_not_opened(fx, monkeypatch):
    ranged_target(fx, "k")
    assert len(fx.files()) == 6
    assert near(fx, "k", 3, 4) == 1
    assert near(fx, "k", *range(0, 100, 5)) == 5, "the keyless slice can hold no match"
    assert near(fx, "k", 1000, 2000, -7) == near(fx, "k", None) == 0
    assert near(fx, "t", 3, 4) == 5, "nothing is known about another key"
    opened, read_slices = [], TargetStore.read_slices

    def counting(self, schema, slices, named=False):
        opened.append(slices.count())
        return read_slices(self, schema, slices, named)

    monkeypatch.setattr(TargetStore, "read_slices", counting)
    before = fx.files()
    out = fx.run([(3, 200, "z"), (45, 202, "z"), (100, 201, "new")])
    assert opened[:2] == [2, 2], "searched by key, then read whole"
    monkeypatch.undo()
    assert (out.rows_updated, out.rows_inserted, len(before - fx.files())) == (2, 1, 2)
    last = fx.store.state().last
    assert (last["target_slices"], last["target_rows"]) == (len(fx.files()), out.target.count()) == (len(fx.files()), 104)


def test_other_partitions_are_pruned_by_spark(fx):
    ranged_target(fx, "k")
    state = fx.store.state()
    some = fx.store.read_slices(state.schema, fx.store.slices(state.version).filter("part = 2"))
    assert some.count() == 20
    assert "dynamicpruning" in some._jdf.queryExecution().toString()


def test_negative_and_far_keys_have_parts_of_their_own(fx):
    parts = store_module.KeyParts("k", "range", 10)
    keys = [-21, -20, -11, -1, 0, 9, 10, None]
    frame = fx.spark.createDataFrame([(k,) for k in keys], "k int")
    assert [r[0] for r in frame.select(parts.of(frame.schema["k"].dataType)).collect()] == [k // 10 if k is not None else None for k in keys]
    far = fx.spark.createDataFrame([(-(1 << 63),), ((1 << 63) - 1,)], "k long")
    assert [r[0] for r in far.select(parts.of(far.schema["k"].dataType)).collect()] == [-(1 << 63) // 10, ((1 << 63) - 1) // 10]
    floats = fx.spark.createDataFrame([(0.0,), (-0.0,)], "k double")
    assert floats.select(store_module.KeyParts("k", "hash", 97).of(floats.schema["k"].dataType)).distinct().count() == 1


def test_not_null_comes_from_the_source_not_from_an_adopted_plan(fx):
    fx.store.adopt(fx.spark.sql("SELECT 1 AS k, 0 AS t, 'a' AS v, timestamp_ntz'2024-01-01' AS loaded_at, 'O' AS source_system"))
    assert rows(fx.run([(None, 1, "n")]).target) == sorted([(1, 0, "a"), (None, 1, "n")], key=repr)
    required = fx.spark.range(1).selectExpr("CAST(id AS int) AS k", "1 AS t", "'a' AS v")
    declared = Process("D", "src", "declared", "SRC", incremental_column="t", keys=("k",))
    fx.run(required, declared)
    with pytest.raises(Exception, match="may not be NULL"):
        fx.run([(None, 2, "n")], declared)


def test_slices_of_unknown_range_are_always_searched(fx):
    ranged_target(fx, None)
    assert near(fx, "k", 3, 4) == 1
    assert fx.run([(3, 200, "z")]).rows_updated == 1


def test_every_match_is_found_whatever_key_the_files_were_loaded_by(fx):
    by_k = Process("K", "src", "tgt", "SRC", incremental_column="t", keys=("k",))
    by_v = Process("V", "other", "tgt", "SRC", incremental_column="t", keys=("v",))
    fx.run([(1, 1, "a"), (2, 1, "b")], by_k)
    fx.run([(9, 2, "b"), (8, 2, "c")], by_v)
    fx.run([(1, 3, "x"), (9, 3, "y"), (8, 3, "z")], by_k)
    assert rows(fx.store.read()) == [(1, 3, "x"), (8, 3, "z"), (9, 3, "y")]


def test_key_ranges_are_compared_in_the_key_type(fx):
    """9 and 10 lie on either side of each other as numbers and as text."""
    for cast in ("int", "string", "date", "timestamp_ntz"):
        process = Process("P", "src", f"tgt_{cast}", "SRC", incremental_column="t", keys=("k",))
        text = {"date": "date_add(date'2024-01-01', n)", "timestamp_ntz": "timestamp_ntz'2024-01-01' + make_dt_interval(n)"}
        key = text.get(cast, f"CAST(n AS {cast})")

        def source(t, *keys):
            return fx.spark.createDataFrame([(n,) for n in keys], "n int").selectExpr(f"{key} AS k", f"{t} AS t", "n AS v")

        fx.run(source(1, 2, 9, 10, 100, -5), process)
        out = fx.run(source(2, 9, 10, 11), process)
        assert (out.rows_updated, out.rows_inserted) == (2, 1), cast


def test_new_columns_are_added_without_rewriting_old_files(fx):
    fx.run([(1, 1, "a"), (2, 1, "b")])
    before = fx.files()
    wide = fx.run([(3, 2, "c", 9)], columns="K int, t int, v string, extra int")
    assert [(d.column, d.status) for d in wide.drift] == [("EXTRA", "new")]
    assert before <= fx.files()
    assert rows(fx.store.read(), "k", "extra") == [(1, None), (2, None), (3, 9)]
    # The source loses the column again: kept on update, NULL on insert.
    narrow = fx.run([(3, 3, "d"), (4, 3, "e")])
    assert rows(narrow.target, "k", "v", "extra") == [(1, "a", None), (2, "b", None), (3, "d", 9), (4, "e", None)]


def test_changed_type_is_cast_or_stops_and_never_retypes_the_target(fx):
    fx.run([(1, 1, "a")])
    text = fx.run([("2", 2, "b")], columns="k string, t int, v string")
    assert [(d.column, d.status) for d in text.drift] == [("K", "type_mismatch")]
    assert dict(text.target.dtypes)["k"] == "int" and rows(text.target) == [(1, 1, "a"), (2, 2, "b")]
    with pytest.raises(Exception, match="does not fit int"):
        fx.run([("x", 3, "c")], columns="k string, t int, v string")
    assert fx.store.state().run_id == 2


def test_text_key_range_does_not_hide_matches_of_another_type(fx):
    """As text '9' > '10': a range taken from the stage's numbers would miss keys."""
    fx.run([("9", 1, "a"), ("10", 1, "b"), ("100", 1, "c")], columns="k string, t int, v string")
    out = fx.run([(9, 2, "x"), (100, 2, "z")])
    assert rows(out.target) == [("10", 1, "b"), ("100", 2, "z"), ("9", 2, "x")]


def test_keys_that_become_equal_in_the_target_type_are_repeated_keys(fx):
    fx.run([(1, 1, "a")])
    text = [("2", 2, "b"), ("02", 3, "c")]
    with pytest.raises(ValueError, match="more than once"):
        fx.run(text, columns="k string, t int, v string")
    out = fx.run(text, columns="k string, t int, v string", duplicates="latest")
    assert rows(out.target) == [(1, 1, "a"), (2, 3, "c")]


def test_mark_of_a_retyped_column_is_the_target_maximum(fx):
    fx.run([(1, "5", "a")], columns="k int, t string, v string")
    assert fx.run([(2, 10, "b")], columns="k int, t int, v string").mark == "5", "as text '5' > '10'"


def test_append_without_a_key_and_full_load(fx):
    append = Process("P", "src", "tgt", "SRC", incremental_column="t")
    fx.run([(1, 1, "a")], append)
    assert rows(fx.run([(1, 1, "a"), (1, 2, "a")], append).target) == [(1, 1, "a"), (1, 2, "a")]
    full = Process("P", "src", "tgt", "SRC", load_type="FULL", incremental_column="t", keys=("k",))
    result = fx.run([(7, 1, "z")], full)
    assert rows(fx.store.read()) == [(7, 1, "z")] and result.mark == "1"
    assert fx.run([], full).target.count() == 0


def test_mark_is_what_the_process_has_read_whoever_loads_the_target(fx):
    fx.store.adopt(fx.spark.sql("SELECT 1 AS k, 50 AS t, 'a' AS v, timestamp_ntz'2024-01-01' AS loaded_at, 'O' AS source_system"))
    assert fx.run([(2, 7, "b")]).mark == "7"
    other = Process("Q", "src2", "tgt", "SRC2", incremental_column="t", keys=("k",))
    assert fx.run([(3, 60, "c")], other).mark == "60"
    # The first process goes on from its own mark and reads what lies under the other's.
    assert fx.run([(4, 51, "d"), (5, 50, "read"), (6, 7, "not past the mark")]).mark == "51"
    assert rows(fx.store.read(), "k") == [(1,), (2,), (3,), (4,), (5,)]


def test_update_that_lowers_nothing_keeps_the_mark_exact(fx):
    fx.run([(1, 10, "a"), (2, 5, "b")])
    assert fx.run([(1, 12, "a")]).mark == "12"
    assert fx.store.read().agg(F.max("t")).first()[0] == 12


@pytest.mark.parametrize("point", ["list_slices", "commit"])
def test_a_crash_before_the_commit_leaves_the_old_state(fx, monkeypatch, point):
    fx.run([(1, 1, "a"), (2, 1, "b"), (None, 1, "n")])
    before, files = rows(fx.store.read()), fx.files()
    source = [(1, 2, "x"), (3, 2, "c"), (None, 2, "m")]

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(store_module.TargetStore, point, crash)
        with pytest.raises(RuntimeError, match="lost"):
            fx.run(source)
    assert (rows(fx.store.read()), fx.files(), fx.store.state().own_mark) == (before, files, {})
    assert fx.store.state("P", "src").own_mark["mark"] == "1"
    again = fx.run(source)
    assert rows(again.target) == sorted(
        [(1, 2, "x"), (2, 1, "b"), (3, 2, "c"), (None, 1, "n"), (None, 2, "m")], key=repr
    )


def test_a_run_overtaken_by_another_gives_up(fx, monkeypatch):
    fx.run([(1, 1, "a")])
    stage_table = sync_module.stage_table

    def overtaken(df, path):
        monkeypatch.setattr(sync_module, "stage_table", stage_table)
        fx.run([(2, 2, "b")])
        return stage_table(df, path)

    monkeypatch.setattr(sync_module, "stage_table", overtaken)
    with pytest.raises(RuntimeError, match="another writer"):
        fx.run([(3, 3, "c")])
    assert rows(fx.store.read()) == [(1, 1, "a"), (2, 2, "b")]


def test_older_versions_stay_readable(fx):
    first = fx.run([(1, 1, "a")]).target
    fx.run([(1, 2, "b")])
    assert rows(first) == [(1, 1, "a")] and rows(fx.store.read()) == [(1, 2, "b")]


def test_composite_key_with_a_null_part_matches_nothing(fx):
    process = Process("P", "src", "tgt", "SRC", incremental_column="t", keys=("k", "v"))
    fx.run([(1, 1, "a"), (1, 1, None), (2, 1, "a")], process)
    out = fx.run([(1, 2, "a"), (1, 2, None), (2, 2, "b")], process)
    assert rows(out.target) == sorted(
        [(1, 2, "a"), (1, 1, None), (1, 2, None), (2, 1, "a"), (2, 2, "b")], key=repr
    )


def test_nested_columns_stay_nested_or_become_text(fx):
    def source(t):
        return fx.spark.sql(
            f"""SELECT 1 AS k, {t} AS t, array({t}, 2) AS a, map('x', {t}) AS m, named_struct('y', {t}) AS s,
            timestamp'2024-01-01 00:00:00 UTC' AS at"""
        )

    fx.run(source(1))
    kept = fx.run(source(2)).target.first()
    assert (kept.a, kept.m, kept.s.y, kept["at"]) == ([2, 2], {"x": 2}, 2, dt.datetime(2024, 1, 1))
    flat = Process("F", "src", "flat", "SRC", incremental_column="t", keys=("k",))
    fx.run(source(1), flat, flat=True)
    text = fx.run(source(2), flat, flat=True)
    assert tuple(text.target.select("a", "m", "s").first()) == ("[2,2]", '{"x":2}', '{"y":2}') and text.drift == []


def test_many_random_batches_equal_one_dictionary(fx):
    import random

    rng = random.Random(5)
    truth, keyless = {}, []
    for batch in range(5):
        keys = rng.sample(range(30), 8)
        delta = [(k, batch + 1, rng.choice(["x", "y", None])) for k in keys]
        delta += [(None, batch + 1, str(batch))] * rng.randrange(3)
        result = fx.run(delta)
        truth |= {k: (k, t, v) for k, t, v in delta if k is not None}
        keyless += [row for row in delta if row[0] is None]
        assert rows(result.target) == sorted([*truth.values(), *keyless], key=repr)


def test_incremental_stage_is_gathered_into_few_files(fx, monkeypatch):
    """Each of many scan tasks leaves a few rows past the mark."""
    fx.run([(0, 0, "a")])
    written, stage_table = [], sync_module.stage_table

    def counting(df, path):
        out = stage_table(df, path)
        written.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(sync_module, "stage_table", counting)
    wide = fx.spark.range(1, 4000, 1, 200).selectExpr("CAST(id AS int) AS k", "CAST(id % 50 AS int) AS t", "'v' AS v")
    fx.run(wide)
    assert written[0] <= 8


def test_hot_key_and_keyless_third_of_a_delta(fx):
    """A third of the delta under one key, a third under none: nothing is lost."""
    source = fx.spark.range(0, 9000, 1, 8).selectExpr(
        "CAST(CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END AS int) AS k",
        "CAST(id + 1 AS int) AS t",
        "'v' AS v",
    )
    fx.run([(7, 0, "old"), (8, 0, "old")])
    out = fx.run(source, duplicates="latest").target
    assert out.filter("k IS NULL").count() == 3000
    assert rows(out.filter("k = 7")) == [(7, 8998, "v")], "8997 is the largest multiple of three"
    assert out.count() == 3000 + 1 + 3000


def test_a_spread_update_leaves_slices_by_key(fx):
    """A third of the rows share key 0."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("k")
    held = fx.spark.range(6000).select(key, F.lit(1).alias("t"), F.col("id").cast("string").alias("v"))
    fx.store.adopt(held.repartition(8), "k", 40_000)
    fx.run([(k, 2, "s") for k in range(1, 6000, 100) if k % 3], file_bytes=40_000)
    files = fx.files()
    assert len(files) >= 8
    fx.run([(k, 3, "n") for k in range(3001, 3101) if k % 3], file_bytes=40_000)
    assert 1 <= len(files - fx.files()) <= 3
    assert fx.store.read().count() == 6000
    assert fx.store.read().filter("v = 'n'").count() == len([k for k in range(3001, 3101) if k % 3])


def test_a_large_target_has_wider_parts_not_more(fx, monkeypatch):
    """Every reading lists all slices: their number does not grow with the first load."""
    monkeypatch.setattr(store_module, "MAX_PARTS", 8)
    held = fx.spark.range(2000).selectExpr("nullif(CAST(id AS int), -1) AS k", "1 AS t", "'a' AS v")
    fx.run(held, file_bytes=1)
    assert 2 <= len(fx.files()) <= 9
    fx.run([(k, 2, "b") for k in range(0, 2000, 7)] + [(2000, 2, "b"), (None, 2, "n")], file_bytes=1)
    want = [(k, 1, "a") if k % 7 else (k, 2, "b") for k in range(2000)] + [(2000, 2, "b"), (None, 2, "n")]
    assert rows(fx.store.read()) == sorted(want, key=repr)


@pytest.mark.parametrize("lo, hi", [(0, 10**9), (-5, 1500), (7, 7), (-(1 << 63), (1 << 63) - 1), (None, None)])
def test_parts_are_bounded(lo, hi):
    parts = store_module.plan_parts("k", lo, hi, 1 << 50, 1 << 18)
    if parts.kind == "hash":
        assert parts.size == store_module.MAX_PARTS
    else:
        assert 1 <= hi // parts.size - lo // parts.size + 1 <= store_module.MAX_PARTS + 1
    assert store_module.plan_parts("k", 0, 999, 1000, 100).size == 100, "a small table keeps the size asked for"


def test_a_run_can_go_back(fx):
    fx.run([(1, 1, "a"), (2, 5, "b")])
    again = fx.run([(1, 1, "A"), (2, 5, "b")], from_mark=0)
    assert (again.rows_read, again.mark, rows(again.target)) == (2, "5", [(1, 1, "A"), (2, 5, "b")])
    assert fx.run([(1, 1, "Z")], from_mark=0).mark == "5", "the mark does not go back"
    moved = dataclasses.replace(P, enddate=0)
    assert fx.run([(1, 1, "c"), (2, 5, "b")], moved).rows_read == 2
    assert fx.run([(1, 1, "c"), (2, 5, "b")], moved).rows_read == 0, "the same ENDDATE asks once"


def test_repeated_keys_leave_nothing_in_the_target(fx):
    fx.run([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], duplicates="latest")
    assert rows(fx.spark.read.parquet(f"{fx.store.path}/data/*")) == [(1, 2, "b"), (2, 1, "c")]


def ledger_rows(fx):
    return [(r.run_id, r.status) for r in fx.store.ledger().orderBy("started_at").collect()]


def test_a_failure_leaves_a_ledger_row_but_no_version(fx):
    fx.run([(1, 1, "a")])
    with pytest.raises(ValueError, match="more than once"):
        fx.run([(2, 2, "b"), (2, 3, "c")])
    assert ledger_rows(fx) == [(1, COMMITTED), (2, FAILED)]
    failed = fx.store.ledger().filter(F.col("status") == FAILED).first()
    assert "more than once" in failed.error and failed.version is None and failed.finished_at is not None
    assert fx.store.state().run_id == 1 and fx.run([(2, 2, "b")]).run_id == 2
    assert rows(fx.store.read()) == [(1, 1, "a"), (2, 2, "b")]


def test_the_ledger_holds_quality_and_drift(fx):
    fx.run([(1, 1, "a"), (None, 1, "n")])
    out = fx.run([("2", 2, "b", 1.5), ("2", 3, "c", 2.5), (None, 2, "n", 0.0)], columns="k string, t int, v string, extra double", duplicates="latest")
    assert (out.null_keys, out.repeated_keys) == (1, 1)
    last = fx.store.ledger().orderBy(F.desc("run_id")).first()
    assert (last.null_keys, last.repeated_keys, last.rows_read) == (1, 1, 3)
    assert sorted(tuple(d) for d in last.drift) == [("EXTRA", "new", "double", None), ("K", "type_mismatch", "string", "int")]


def instants(fx, *texts):
    quoted = ", ".join(f"({i}, timestamp'{t} UTC')" for i, t in enumerate(texts))
    return fx.spark.sql(f"SELECT CAST(k AS int) AS k, t FROM VALUES {quoted} AS s(k, t)")


def test_a_zoned_mark_is_an_instant_across_a_clock_change(fx):
    """05:50 and 06:20 UTC are 01:50 and 01:20 in New York on 3 November 2024."""
    append = Process("P", "src", "tgt", "SRC", incremental_column="t")
    source = instants(fx, "2024-11-03 05:50:00", "2024-11-03 06:20:00.000001")
    first = fx.run(source, append, zone="America/New_York")
    assert (first.rows_read, first.mark) == (2, "2024-11-03 06:20:00.000001+00:00")
    assert fx.run(source, append, zone="America/New_York").rows_read == 0
    later = instants(fx, "2024-11-03 05:50:00", "2024-11-03 06:20:00.000001", "2024-11-03 06:20:00.000002")
    assert fx.run(later, append, zone="America/New_York").rows_read == 1
    at = sorted(r.t for r in fx.store.read().collect())
    assert at == [dt.datetime(2024, 11, 3, 1, 20, 0, 1), dt.datetime(2024, 11, 3, 1, 20, 0, 2), dt.datetime(2024, 11, 3, 1, 50)]
    assert fx.store.state("P", "src").own_mark["enddate"] == dt.datetime(2024, 11, 3, 1, 20, 0, 2)
    back = fx.run(instants(fx, "2024-11-03 05:50:00"), append, zone="America/New_York", from_mark="2024-11-03 00:00:00")
    assert (back.rows_read, back.mark) == (1, "2024-11-03 06:20:00.000002+00:00")


def test_the_latest_of_a_repeated_hour_is_the_later_instant(fx):
    process = Process("P", "src", "tgt", "SRC", incremental_column="t", keys=("k",))
    source = fx.spark.sql("SELECT 1 AS k, t, v FROM VALUES (timestamp'2024-11-03 05:50:00 UTC', 'early'), (timestamp'2024-11-03 06:20:00 UTC', 'late') AS s(t, v)")
    assert [r.v for r in fx.run(source, process, zone="America/New_York", duplicates="latest").target.collect()] == ["late"]


def test_unchanged_rows_are_skipped_and_their_slices_not_written(fx):
    ranged_target(fx, "k")
    before = fx.files()
    source = [(3, 200, "a"), (4, 200, "a")]
    changing = Process("P", "src", "tgt", "SRC", incremental_column="x", keys=("k",))
    wide = [(k, k, "a" if k != 45 else "b", 9) for k in range(100)]
    fx.run(fx.spark.createDataFrame(wide, "k int, t int, v string, x int").drop("x"), dataclasses.replace(changing, incremental_column=None), skip_unchanged=True, run_ts=LATER)
    assert len(before - fx.files()) == 1
    got = {r.k: (r.v, r.loaded_at) for r in fx.store.read().filter("k is not null").collect()}
    assert got[45] == ("b", LATER) and got[44][1] == dt.datetime(2024, 1, 1) and len(got) == 100
    again = fx.run(source, skip_unchanged=True, run_ts=LATER)
    assert (again.rows_read, again.rows_updated) == (2, 2), "t differs"


def test_a_repeated_target_key_is_unchanged_only_if_all_copies_are(fx):
    fx.store.adopt(fx.spark.sql("SELECT k, 1 AS t, v, timestamp_ntz'2024-01-01' AS loaded_at, 'O' AS source_system FROM VALUES (1, 'a'), (1, 'b'), (2, 'c'), (2, 'c') AS s(k, v)"))
    out = fx.run([(1, 1, "a"), (2, 1, "c")], dataclasses.replace(P, incremental_column=None), skip_unchanged=True)
    assert out.rows_updated == 2 and rows(out.target) == [(1, 1, "a"), (1, 1, "a"), (2, 1, "c"), (2, 1, "c")]


def test_fingerprints_count_for_the_broadcast(fx, monkeypatch):
    """Keys alone would fit, keys with fingerprints do not: they are shuffled, whatever Spark makes of the small files."""
    plans = []

    def staged(df, path):
        if "/hits-" in path:
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stage_table(df, path)

    stage_table = store_module.stage_table
    monkeypatch.setattr(store_module, "stage_table", staged)
    fx.run([(k, 1, "a") for k in range(100)])
    key_bytes = 100 * 8 * 3
    again = [(k, 1, "b" if k == 7 else "a") for k in range(100)]
    for limit, strategy in ((key_bytes, "merge"), (key_bytes + 100 * 40, "broadcast")):
        done = fx.run(again, dataclasses.replace(P, incremental_column=None), skip_unchanged=True, broadcast_bytes=limit)
        assert f"rightHint=(strategy={strategy})" in plans[-1]
        assert done.rows_updated == (1 if strategy == "merge" else 0)
    assert rows(fx.store.read()) == sorted(again, key=repr)


def test_runs_leave_no_scratch_tables_and_vacuum_no_old_slices(fx):
    import os

    scratch = f"{shared_dir(fx.spark)}/tidemark"
    before = set(os.listdir(scratch)) if os.path.exists(scratch) else set()
    for i in range(1, 5):
        fx.run([(1, i, str(i)), (i, i, str(i))] if i > 1 else [(1, 1, "1")])
    with pytest.raises(ValueError):
        fx.run([(8, 9, "x"), (8, 9, "y")])
    assert set(os.listdir(scratch)) == before
    older = fx.store.slices(next(r.version for r in fx.store.ledger().filter("run_id = 3").collect()))
    held = rows(fx.store.read())
    assert fx.store.vacuum(keep_runs=2) >= 1
    assert rows(fx.store.read()) == held and fx.store.read_slices(fx.store.state().schema, older).count() == 3
    assert fx.store.vacuum(keep_runs=2) == 0
