import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul import (
    ColumnSpec,
    conform,
    decode_binary,
    decode_bits,
    encode_binary,
    fit_report,
    split_valid,
    target_type,
    with_defaults,
)
from tablehaul.functions.types import spec_of_field
from tests.conftest import rows

TYPES = [
    (ColumnSpec("c", "varchar", 20), T.StringType()),
    (ColumnSpec("c", "CHAR", 4), T.StringType()),
    (ColumnSpec("c", "longtext"), T.StringType()),
    (ColumnSpec("c", "TINYINT"), T.IntegerType()),
    (ColumnSpec("c", "mediumint"), T.IntegerType()),
    (ColumnSpec("c", "DECIMAL", numeric_precision=15, numeric_scale=2), T.DecimalType(15, 2)),
    (ColumnSpec("c", "FLOAT", numeric_precision=12), T.DoubleType()),
    (ColumnSpec("c", "double"), T.DoubleType()),
    (ColumnSpec("c", "DATETIME"), T.TimestampNTZType()),
    (ColumnSpec("c", "timestamp"), T.TimestampNTZType()),
    (ColumnSpec("c", "MEDIUMBLOB"), T.BinaryType()),
    (ColumnSpec("c", "VARBINARY"), T.BinaryType()),
    (ColumnSpec("c", "smallint"), T.ShortType()),
    (ColumnSpec("c", "smallint", unsigned=True), T.IntegerType()),
    (ColumnSpec("c", "int"), T.IntegerType()),
    (ColumnSpec("c", "int", unsigned=True), T.LongType()),
    (ColumnSpec("c", "bigint"), T.LongType()),
    (ColumnSpec("c", "bigint", unsigned=True), T.DecimalType(20, 0)),
    (ColumnSpec("c", "date"), T.DateType()),
    (ColumnSpec("c", "time"), T.StringType()),
    (ColumnSpec("c", "json"), T.StringType()),
    (ColumnSpec("c", "enum"), T.StringType()),
    (ColumnSpec("c", "year"), T.IntegerType()),
    (ColumnSpec("c", "bit", numeric_precision=1), T.BooleanType()),
    (ColumnSpec("c", "bit", numeric_precision=9), T.LongType()),
    (ColumnSpec("c", "bit", numeric_precision=64), T.DecimalType(20, 0)),
    (ColumnSpec("c", "array<float>"), T.ArrayType(T.FloatType())),
]


@pytest.mark.parametrize("spec,wanted", TYPES, ids=lambda v: str(getattr(v, "data_type", v)))
def test_type_mapping(spark, spec, wanted):
    assert target_type(spec) == wanted


def test_types_that_have_no_place(spark):
    with pytest.raises(ValueError, match="precision"):
        target_type(ColumnSpec("c", "DECIMAL", numeric_precision=60, numeric_scale=2))
    with pytest.raises(ValueError, match="unknown type"):
        target_type(ColumnSpec("c", "geometry"))


@pytest.mark.parametrize(
    "kind",
    ["string", "int", "bigint", "smallint", "double", "float", "decimal(9,3)", "date", "boolean",
     "timestamp", "timestamp_ntz", "binary", "array<float>", "struct<a:int>"],
)
def test_spark_columns_keep_their_type(spark, kind):
    field = spark.createDataFrame([], f"c {kind}").schema["c"]
    assert target_type(spec_of_field(field)) == field.dataType


def test_conform_takes_by_name_and_keeps_records(spark, tmp_path):
    df = spark.createDataFrame([("7", "x", 1.5)], "B string, unused string, a double")
    specs = [
        ColumnSpec("A", "DECIMAL", numeric_precision=5, numeric_scale=1, is_nullable=False),
        ColumnSpec("b", "INT", column_default="3"),
    ]
    got = conform(df, specs)
    assert got.dtypes == [("a", "decimal(5,1)"), ("b", "int")]
    assert rows(got) == [(Decimal("1.5"), 7)]
    got.write.parquet(str(tmp_path / "t"))
    again = spark.read.parquet(str(tmp_path / "t")).schema
    assert [spec_of_field(f) for f in again.fields] == specs


def test_conform_is_generated_code_over_the_scan(spark, plan):
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    text = plan(conform(df, [ColumnSpec("c_custkey", "INT")]))
    assert "Python" not in text and "Exchange" not in text
    assert "ReadSchema: struct<c_custkey:bigint>" in text


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="no column"):
        conform(spark.range(1), [ColumnSpec("x", "INT")])


BAD = [
    (ColumnSpec("c", "VARCHAR", 3), "string", ["abc", "äöü", "abcd", None], {"length": 1}),
    (ColumnSpec("c", "INT"), "string", ["1", "x", "2.5", None], {"cast": 2}),
    (ColumnSpec("c", "INT"), "bigint", [1, 2**40, None], {"cast": 1}),
    (ColumnSpec("c", "INT"), "double", [1.0, 2.5, None], {"cast": 1}),
    (ColumnSpec("c", "BIGINT"), "int", [1, None], {}),
    (ColumnSpec("c", "INT", is_nullable=False), "int", [1, None], {"not_null": 1}),
    (
        ColumnSpec("c", "DECIMAL", numeric_precision=4, numeric_scale=1),
        "string", ["999.9", "1000", "x", None], {"decimal": 1, "cast": 1},
    ),
    (
        ColumnSpec("c", "DECIMAL", numeric_precision=4, numeric_scale=1),
        "double", [999.9, -1000.0, float("nan"), None], {"decimal": 2},
    ),
    (
        ColumnSpec("c", "DATETIME"),
        "string", ["2021-02-01 12:12:00", "0000-00-00 00:00:00", None], {"cast": 1},
    ),
    (ColumnSpec("c", "BLOB"), "string", ["\\x00ff", "\\xzz", "plain", None], {"cast": 1}),
    (ColumnSpec("c", "BIT", numeric_precision=1), "binary", [b"\0", b"\1", None], {}),
    (ColumnSpec("c", "DATETIME"), "timestamp", [datetime.datetime(2020, 1, 1), None], {}),
    (
        ColumnSpec("c", "DECIMAL", numeric_precision=12, numeric_scale=2),
        "int", [2**31 - 1, -(2**31), None], {},
    ),
    (
        ColumnSpec("c", "DECIMAL", numeric_precision=11, numeric_scale=2),
        "int", [2**31 - 1, 5, None], {"decimal": 1},
    ),
    (
        ColumnSpec("c", "DECIMAL", numeric_precision=5, numeric_scale=1),
        "decimal(5,2)", [Decimal("999.99"), None], {},
    ),
    (
        ColumnSpec("c", "DECIMAL", numeric_precision=4, numeric_scale=1),
        "decimal(5,2)", [Decimal("999.99"), Decimal("1.00"), None], {"decimal": 1},
    ),
]


@pytest.mark.parametrize("spec,kind,values,broken", BAD)
def test_rules(spark, spec, kind, values, broken):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    found = {r.rule: r.violations for r in fit_report(df, [spec]).collect()}
    assert found == broken
    good, quarantine = split_valid(df, [spec])
    assert quarantine.count() == sum(broken.values())
    assert good.count() + quarantine.count() == len(values)
    assert {r.reject_reason for r in quarantine.collect()} == {
        f"c:{rule}" for rule, n in broken.items() if n
    }


def test_length_in_bytes(spark):
    df = spark.createDataFrame([("äöü",)], "c string")
    specs = [ColumnSpec("c", "VARCHAR", 3)]
    assert fit_report(df, specs, "byte").first().violations == 1
    assert fit_report(df, specs, "char").first().violations == 0


def test_every_reason_of_a_row_is_named(spark):
    df = spark.createDataFrame([(None, "long"), (1, "ok")], "a int, b string")
    specs = [ColumnSpec("a", "INT", is_nullable=False), ColumnSpec("b", "CHAR", 2)]
    for stage in (False, True):
        good, quarantine = split_valid(df, specs, stage=stage)
        assert rows(good) == [(1, "ok")]
        assert [tuple(r) for r in quarantine.collect()] == [(None, "long", "a:not_null,b:length")]


def test_report_reads_once(spark, plan):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    specs = [ColumnSpec("text", "VARCHAR", 255), ColumnSpec("lang", "CHAR", 2)]
    text = plan(fit_report(df, specs))
    assert text.count("FileScan") == 1
    assert "ReadSchema: struct<text:string,lang:string>" in text


def test_binary_text_and_back(spark):
    df = spark.createDataFrame([(1, b"\x00\xffa"), (2, b""), (3, None)], "k int, b binary")
    text = encode_binary(df, ["b"])
    assert rows(text) == [(1, "\\x00FF61"), (2, "\\x"), (3, None)]
    assert decode_binary(text, ["b"]).exceptAll(df).count() == 0


@pytest.mark.parametrize(
    "value,width,wanted",
    [(b"\0", 1, False), (b"\1", 1, True), (b"\x01\x05", 16, 261), (None, 8, None),
     (b"\xff" * 8, 64, Decimal(2**64 - 1)), (b"\x7f" + b"\xff" * 7, 63, 2**63 - 1)],
)
def test_bits(spark, value, width, wanted):
    df = spark.createDataFrame([(value,)], "b binary")
    assert decode_bits(df, ["b"], width).first().b == wanted


def test_defaults(spark):
    specs = [
        ColumnSpec("a", "INT", column_default="5"),
        ColumnSpec("b", "VARCHAR", 9, column_default=""),
        ColumnSpec("c", "VARCHAR", 9, column_default="( 'user' )"),
        ColumnSpec("d", "DATETIME", column_default="CURRENT_TIMESTAMP"),
        ColumnSpec("e", "VARCHAR", 99, column_default="CURRENT_TIMESTAMP"),
        ColumnSpec("f", "INT", column_default="1 + 1", default_is_expression=True),
        ColumnSpec("g", "DATE"),
        ColumnSpec("h", "INT", column_default="8"),
    ]
    df = spark.createDataFrame([(None,)], "h int")
    row = with_defaults(df, specs).first()
    assert (row.a, row.b, row.c, row.e, row.f, row.g, row.h) == (
        5, "", "user", "CURRENT_TIMESTAMP", 2, None, None,
    )
    assert isinstance(row.d, datetime.datetime)
    with pytest.raises(ValueError, match="NOT NULL"):
        with_defaults(df, [ColumnSpec("z", "INT", is_nullable=False)])
    assert with_defaults(df.select(F.lit(1).alias("H")), specs[-1:]).first().h == 1
