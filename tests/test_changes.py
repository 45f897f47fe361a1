"""Change feed, deletes, skipped rows and nested layouts on inline rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.audit import AuditColumns
from tidemark.functions.layout import to_layout
from tidemark.operators import change_feed, changed_rows, deleted_keys, soft_delete, upsert

RUN = dt.datetime(2025, 1, 1)


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "a", None, "O"), (2, "b", 2, "O"), (3, "c", 3, "O"), (None, "n", 4, "O")], "K int, v string, w int, source_system string")


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([(1, "a", None), (2, None, 2), (5, "e", 5), (None, "m", 6)], "k long, v string, w int")


def feed(df):
    return sorted(((r.K, r.kind, tuple(r.before) if r.before else None, tuple(r.after) if r.after else None) for r in df.collect()), key=repr)


def test_feed_has_both_sides(target, source):
    delta = [(2, "update", ("b", 2), (None, 2)), (5, "insert", None, ("e", 5)), (None, "insert", None, ("m", 6))]
    assert feed(change_feed(target, source, "k", deletes=False)) == sorted(delta, key=repr)
    whole = [*delta, (3, "delete", ("c", 3), None)]
    assert feed(change_feed(target, source, "k")) == sorted(whole, key=repr)
    assert feed(change_feed(target, source.filter("false"), "k", deletes=False)) == []
    assert [f[1] for f in feed(change_feed(target.filter("false"), source, "k"))] == ["insert"] * 4


def test_deleted_keys_and_soft_delete(spark, target, source):
    assert [tuple(r) for r in deleted_keys(target.union(target), source, "k").collect()] == [(3,)]
    once = soft_delete(target, source, "k", F.lit(str(RUN)).cast("timestamp_ntz"))
    got = {r.v: r.deleted_at for r in once.collect()}
    assert got == {"a": None, "b": None, "c": RUN, "n": None}
    again = soft_delete(once, source.filter("k <> 2"), "k", F.lit("2026-01-01").cast("timestamp_ntz"))
    assert {r.v: r.deleted_at for r in again.collect()} == got | {"b": dt.datetime(2026, 1, 1)}
    back = spark.createDataFrame([(3,), (2,), (1,)], "k int")
    assert all(r.deleted_at is None for r in soft_delete(again, back, "k", F.current_timestamp()).collect())


def test_rows_that_change_nothing_are_left_out(target, source):
    kept = changed_rows(target, source, "k")
    assert sorted(((r.K, r.v, r.w) for r in kept.collect()), key=repr) == sorted([(2, None, 2), (5, "e", 5), (None, "m", 6)], key=repr)
    assert changed_rows(target.filter("false"), source, "k").count() == 4
    assert changed_rows(target, source.select("k"), "k").count() == 2, "without columns only new keys are left"


def test_only_the_audit_columns_themselves_are_insert_only(spark):
    old = spark.createDataFrame([(1, "x", "OLD")], "k int, source_system_code string, source_system string")
    new = spark.createDataFrame([(1, "y", "NEW")], "k int, source_system_code string, source_system string")
    assert tuple(upsert(old, new, "k").first()) == (1, "y", "OLD")
    assert tuple(upsert(old, new, "k", AuditColumns(by_prefix=True)).first()) == (1, "x", "OLD")


def test_instants_inside_nested_values(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.sql(
            """SELECT array(timestamp'2024-07-01 12:00:00 UTC', NULL) AS a, map(timestamp'2024-07-01 12:00:00 UTC', array(timestamp'2024-01-01 00:00:00 UTC')) AS m,
            named_struct('at', timestamp'2024-07-01 12:00:00 UTC', 'n', 1, 'in', named_struct('at', timestamp'2024-01-01 00:00:00 UTC')) AS s,
            CAST(NULL AS struct<at: timestamp>) AS none, array(1, 2) AS plain"""
        )
        kept = to_layout(df, zone="Europe/Berlin")
        assert kept.schema.simpleString() == "struct<a:array<timestamp_ntz>,m:map<timestamp_ntz,array<timestamp_ntz>>,s:struct<at:timestamp_ntz,n:int,in:struct<at:timestamp_ntz>>,none:struct<at:timestamp_ntz>,plain:array<int>>"
        row = kept.first()
        assert row.a == [dt.datetime(2024, 7, 1, 14), None] and row.none is None and row.s["in"]["at"] == dt.datetime(2024, 1, 1, 1)
        assert row.m == {dt.datetime(2024, 7, 1, 12): [dt.datetime(2024, 1, 1, 1)]}, "keys stay apart in UTC"
        text = to_layout(df, flat=True, zone="Europe/Berlin").first()
        assert (text.a, text.none) == ('["2024-07-01T14:00:00.000",null]', None)
        assert text.s == '{"at":"2024-07-01T14:00:00.000","n":1,"in":{"at":"2024-01-01T01:00:00.000"}}'
        variant = to_layout(df, nested="variant", zone="Europe/Berlin")
        assert {t for _, t in variant.dtypes} == {"variant"}
        got = variant.selectExpr("variant_get(s, '$.in.at', 'timestamp_ntz') AS at", "variant_get(plain, '$[1]', 'int') AS n", "none IS NULL AS none").first()
        assert (got["at"], got.n, got.none) == (dt.datetime(2024, 1, 1, 1), 2, True)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    with pytest.raises(ValueError, match="unknown layout"):
        to_layout(df, nested="xml")
