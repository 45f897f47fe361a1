import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions.audit import AuditColumns
from tidemark.operators import (
    dedupe_latest,
    dq_profile,
    high_water_mark,
    inserted_rows,
    matched_rows,
    repeated_keys,
    require_unique_keys,
    upsert,
)
from tidemark.operators.upsert import fits_broadcast

VARIANTS = {"broadcast": {"broadcast": True}, "split": {}, "full_outer": {"unique_target": True}}
COLUMNS = "k int, v string, note string, loaded_at string, source_system string"
STAGE = "k int, v string, loaded_at string, source_system string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(params=VARIANTS.values(), ids=VARIANTS.keys())
def variant(request):
    return request.param


def brute_force(target, stage):
    """One row at a time: what a MERGE does."""
    out = []
    by_key = {s[0]: s for s in stage if s[0] is not None}
    for k, v, note, at, system in target:
        hit = by_key.get(k) if k is not None else None
        out.append((k, hit[1], note, hit[2], system) if hit else (k, v, note, at, system))
    held = {t[0] for t in target if t[0] is not None}
    out += [(k, v, None, at, system) for k, v, at, system in stage if k is None or k not in held]
    return sorted(out, key=repr)


def test_updates_inserts_and_leaves_the_rest(spark, variant):
    target = [(1, "a", "n1", "old", "O"), (2, "b", "n2", "old", "O"), (None, "c", "n3", "old", "O")]
    stage = [(1, None, "new", "S"), (3, "z", "new", "S"), (None, "y", "new", "S")]
    out = upsert(spark.createDataFrame(target, COLUMNS), spark.createDataFrame(stage, STAGE), "k", **variant)
    assert rows(out) == brute_force(target, stage)
    assert (1, None, "n1", "new", "O") in rows(out), "NULL overwrites; target-only and insert-only columns stay"


key = st.one_of(st.none(), st.integers(0, 6))
value = st.one_of(st.none(), st.sampled_from("abc"))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    target=st.lists(st.tuples(key, value, value, st.just("old"), st.just("O")), max_size=8),
    stage=st.lists(st.tuples(key, value, st.just("new"), st.just("S")), max_size=8),
)
def test_variants_equal_brute_force(spark, target, stage):
    seen, unique = set(), []
    for row in stage:
        if row[0] is None or row[0] not in seen:
            unique.append(row)
            seen.add(row[0])
    t, s = spark.createDataFrame(target, COLUMNS), spark.createDataFrame(unique, STAGE)
    expected = brute_force(target, unique)
    once = len({r[0] for r in target if r[0] is not None}) == sum(r[0] is not None for r in target)
    for name, options in VARIANTS.items():
        if name != "full_outer" or once:
            assert rows(upsert(t, s, "k", **options)) == expected, name


def test_repeated_target_key_is_updated_in_every_row(spark):
    target = spark.createDataFrame([(1, "a", "x", "old", "O"), (1, "b", "y", "old", "O")], COLUMNS)
    stage = spark.createDataFrame([(1, "z", "new", "S")], STAGE)
    for broadcast in (True, False):
        out = rows(upsert(target, stage, "k", broadcast=broadcast))
        assert out == [(1, "z", "x", "new", "O"), (1, "z", "y", "new", "O")]


def test_legs_add_up_to_the_whole(spark):
    target = spark.createDataFrame([(i, "t", "n", "old", "O") for i in range(10)], COLUMNS)
    stage = spark.createDataFrame([(i, "s", "new", "S") for i in range(5, 15)], STAGE)
    assert sorted(r.k for r in matched_rows(target, stage, "k").collect()) == list(range(5, 10))
    assert sorted(r.k for r in inserted_rows(target, stage, "k").collect()) == list(range(10, 15))


def test_audit_prefix_columns_are_inserted_but_not_updated(spark, variant):
    audit = AuditColumns(loaded_at="loaded_at", source_system="source_system", by_prefix=True)
    columns = "k int, source_system_id int, loaded_at string"
    target = spark.createDataFrame([(1, 10, "old")], columns)
    stage = spark.createDataFrame([(1, 11, "new"), (2, 12, "new")], columns)
    assert rows(upsert(target, stage, "k", audit, **variant)) == [(1, 10, "new"), (2, 12, "new")]


def test_names_match_without_case_and_values_take_the_target_type(spark, variant):
    target = spark.createDataFrame([(1, 5)], "Id bigint, Val bigint")
    stage = spark.createDataFrame([("1", 6), ("2", 7)], "ID string, VAL int")
    out = upsert(target, stage, "id", **variant)
    assert out.schema == target.schema and rows(out) == [(1, 6), (2, 7)]


def test_stage_column_unknown_to_the_target_is_an_error(spark):
    with pytest.raises(ValueError, match="missing from the target"):
        upsert(spark.range(1), spark.range(1).withColumn("x", F.lit(1)), "id")


def test_empty_sides(spark, variant):
    target = spark.createDataFrame([(1, "a", "n", "old", "O")], COLUMNS)
    stage = spark.createDataFrame([(2, "s", "new", "S")], STAGE)
    assert rows(upsert(target, stage.filter("false"), "k", **variant)) == rows(target)
    assert rows(upsert(target.filter("false"), stage, "k", **variant)) == [(2, "s", None, "new", "S")]


def test_dup_guard_ignores_null_keys(spark):
    df = spark.createDataFrame([(1,), (None,), (None,), (2,)], "k int")
    assert require_unique_keys(df, "k") is df
    with pytest.raises(ValueError, match="several rows for one key"):
        require_unique_keys(df.union(df), "k")
    assert rows(repeated_keys(df.union(df), "k")) == [(1, 2), (2, 2)]


def test_dedupe_keeps_the_latest_and_every_null_key(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, None, "n"), (2, 0, "o"), (None, 1, "p"), (None, 1, "p")],
        "k int, t int, v string",
    )
    assert rows(dedupe_latest(df, "k", "t")) == sorted(
        [(1, 3, "c"), (2, 0, "o"), (None, 1, "p"), (None, 1, "p")], key=repr
    )


def test_dedupe_breaks_ties_the_same_way_in_any_row_order(spark):
    data = [(1, 1, v) for v in "dbca"]
    for order in (data, data[::-1]):
        assert rows(dedupe_latest(spark.createDataFrame(order, "k int, t int, v string"), "k", "t")) == [(1, 1, "a")]


def test_profile_counts_null_as_one_key(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    assert rows(dq_profile(df, "k")) == [(5, 2, 3, 2)]
    assert rows(dq_profile(df.filter("false"), "k")) == [(0, 0, 0, 0)]


def test_high_water_mark_of_nothing_and_of_numbers(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "k int")
    assert rows(high_water_mark(df, "k")) == [(5, None)]
    assert rows(high_water_mark(df.filter("false"), "k")) == [(None, None)]


def test_size_is_measured_not_guessed(spark):
    wide = spark.range(1000).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    assert fits_broadcast(wide, 1_100_000) and not fits_broadcast(wide, 1_000_000)
    assert fits_broadcast(wide.filter("false"), 0)
    hollow = ", ".join(f"'f{i}', CAST(NULL AS BIGINT)" for i in range(50))
    structs = spark.range(100).selectExpr(f"named_struct({hollow}) AS s")
    assert not fits_broadcast(structs, 100 * 50 * 8), "NULL fields take their word too"
