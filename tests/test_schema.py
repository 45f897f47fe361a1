import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    CharType,
    DateType,
    DayTimeIntervalType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
    VarcharType,
    VariantType,
)

from tidemark.functions.audit import row_fingerprint, with_audit
from tidemark.functions.layout import physical_type, to_layout
from tidemark.operators import add_columns, conform, diff_schemas, evolve_schema, schema_drift, type_drift_profile

SCALARS = [
    DecimalType(10, 2), StringType(), IntegerType(), LongType(), ShortType(), ByteType(), FloatType(),
    DoubleType(), BooleanType(), DateType(), BinaryType(), TimestampNTZType(), DayTimeIntervalType(),
]


@pytest.mark.parametrize("dtype", SCALARS, ids=str)
def test_scalars_keep_their_type(dtype):
    assert physical_type(dtype) == dtype and physical_type(dtype, flat=True) == dtype


def test_types_that_change():
    assert physical_type(TimestampType()) == TimestampNTZType()
    for text in (VarcharType(10), CharType(3), NullType()):
        assert physical_type(text) == StringType()
    nested = [ArrayType(IntegerType()), MapType(StringType(), LongType()), StructType([]), VariantType()]
    for dtype in nested:
        assert physical_type(dtype) == dtype and physical_type(dtype, flat=True) == StringType()


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_layout_takes_wall_time_in_the_stated_zone(spark, session_zone):
    df = spark.sql("SELECT timestamp'2024-07-01 12:00:00.000001 UTC' AS t, array(1, 2) AS a, named_struct('x', 1) AS s")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        assert to_layout(df).first().t == dt.datetime(2024, 7, 1, 12, 0, 0, 1)
        assert to_layout(df, zone="Europe/Berlin").first().t == dt.datetime(2024, 7, 1, 14, 0, 0, 1)
        flat = to_layout(df, flat=True).first()
        assert (flat.a, flat.s) == ("[1,2]", '{"x":1}')
        assert to_layout(df).first().a == [1, 2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def schema(**columns):
    return StructType([StructField(n, t) for n, t in columns.items()])


def test_diff_matches_names_without_case_and_types_by_class():
    ours = schema(Id=IntegerType(), price=DecimalType(10, 2), tags=ArrayType(IntegerType()), added=StringType())
    theirs = schema(ID=LongType(), PRICE=DecimalType(12, 4), TAGS=ArrayType(StringType()), loaded_at=TimestampNTZType())
    assert [(d.column, d.status) for d in diff_schemas(ours, theirs)] == [
        ("ID", "type_mismatch"),
        ("ADDED", "new"),
        ("LOADED_AT", "target_only"),
    ]
    strict = {d.column for d in diff_schemas(ours, theirs, strict=True) if d.status == "type_mismatch"}
    assert strict == {"ID", "PRICE", "TAGS"}


def test_names_equal_but_for_case_are_refused():
    with pytest.raises(ValueError, match="differ only in case"):
        diff_schemas(schema(Id=IntegerType(), ID=IntegerType()), schema(id=IntegerType()))


def test_drift_of_equal_schemas_is_empty(spark):
    df = spark.range(3)
    assert schema_drift(df, df).count() == 0
    assert type_drift_profile(df, df.schema).count() == 0


def test_type_drift_counts_lost_values(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), (" 5 ",)], "v string")
    row = type_drift_profile(df, schema(V=IntegerType())).first()
    assert (row["column"], row.source_type, row.target_type, row.non_null, row.lost) == ("V", "string", "int", 3, 1)


def test_evolution_only_adds_nullable_columns():
    target = schema(id=LongType(), v=StringType())
    source = StructType([StructField("ID", IntegerType()), StructField("extra", DateType(), False)])
    evolved = evolve_schema(target, source)
    assert evolved.names == ["id", "v", "extra"]
    assert evolved["id"].dataType == LongType() and evolved["extra"].nullable


def test_add_columns_leaves_null(spark):
    out = add_columns(spark.range(2), schema(ID=LongType(), note=StringType()))
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(0, None), (1, None)]


def test_conform_casts_without_loss_or_stops(spark):
    text = spark.createDataFrame([("1",), ("2",)], "ID string")
    assert [r.id for r in conform(text, schema(id=IntegerType())).orderBy("id").collect()] == [1, 2]
    with pytest.raises(Exception, match="does not fit int"):
        conform(spark.createDataFrame([("x",)], "id string"), schema(id=IntegerType())).collect()
    with pytest.raises(ValueError, match="evolve|missing from the target"):
        conform(text, schema(other=IntegerType()))


def test_conform_enforces_not_null(spark):
    required = StructType([StructField("id", LongType(), False)])
    assert conform(spark.range(2), required).count() == 2
    with pytest.raises(Exception, match="may not be NULL"):
        conform(spark.sql("SELECT CAST(NULL AS BIGINT) AS id"), required).collect()


def test_audit_names_may_not_clash(spark):
    with pytest.raises(ValueError, match="audit column"):
        with_audit(spark.sql("SELECT 1 AS k, 'x' AS Source_System"), F.current_timestamp(), "SRC")


def test_fingerprint_tells_null_from_shifted_values(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "a")], "x string, y string")
    assert df.select(row_fingerprint("x", "y").alias("f")).distinct().count() == 3
