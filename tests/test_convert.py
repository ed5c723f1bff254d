"""Types and converters by worked values."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import convert as V
from tideline.functions.types import field, spark_type
from tideline.sources import rowcodec as R


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def lit(x, kind):
    return F.lit(x).cast(kind)


@pytest.mark.parametrize(
    "text,want",
    [
        ("bit(1)", T.BooleanType()), ("BIT(16)", T.BinaryType()), ("tinyint(1)", T.BooleanType()), ("tinyint", T.ByteType()), ("TINYINT(3) UNSIGNED", T.ShortType()), ("smallint unsigned zerofill", T.IntegerType()),
        ("mediumint", T.IntegerType()), ("mediumint unsigned", T.LongType()), ("int(11)", T.IntegerType()), ("int unsigned", T.LongType()), ("bigint", T.LongType()), ("bigint(20) unsigned", T.DecimalType(20, 0)),
        ("serial", T.DecimalType(20, 0)), ("float", T.FloatType()), ("double precision", T.DoubleType()), ("decimal(10,2)", T.DecimalType(10, 2)), ("decimal(10,2) unsigned", T.DecimalType(10, 2)), ("numeric(65,30)", T.StringType()),
        ("date", T.DateType()), ("datetime(6)", T.TimestampNTZType()), ("timestamp(3)", T.TimestampType()), ("year", T.IntegerType()), ("varchar(255)", T.StringType()), ("enum('a','b')", T.StringType()),
        ("set('a','b,c')", T.ArrayType(T.StringType())), ("json", T.StringType()), ("polygon", T.StringType()), ("varbinary(9)", T.BinaryType()), ("longblob", T.BinaryType()), ("bool", T.BooleanType()),
    ],
)
def test_types(text, want):
    assert spark_type(text) == want


def test_time_type_and_unknown_types():
    assert spark_type("time(6)").simpleString() == "interval hour to second"
    for bad in ("vector(3)", "", "???"):
        with pytest.raises(ValueError):
            spark_type(bad)
    f = field("a", "int unsigned", False, comment="c")
    assert (f.dataType, f.nullable, f.metadata) == (T.LongType(), False, {"source_type": "int unsigned", "comment": "c"})


@pytest.mark.parametrize("kind,of,want", [("tinyint", "tinyint", 255), ("smallint", "smallint", 65535), ("mediumint", "int", 16777215), ("int", "int", 4294967295), ("bigint", "bigint", Decimal(18446744073709551615))])
def test_unsigned(spark, kind, of, want):
    assert value(spark, V.unsigned(lit(-1, of), kind)) == want
    assert value(spark, V.unsigned(lit(5, of), kind)) == 5
    assert value(spark, V.unsigned(lit(None, of), kind)) is None


def test_values(spark):
    abc = ["a", "b", "c"]
    assert [value(spark, V.enum_label(lit(i, "int"), abc)) for i in (0, 1, 3, 4, None)] == ["", "a", "c", None, None]
    assert [value(spark, V.set_text(lit(m, "bigint"), abc)) for m in (5, 0, 7, None)] == ["a,c", "", "a,b,c", None]
    assert [value(spark, V.set_array(F.lit(t))) for t in ("a,c", "")] == [["a", "c"], [""]]
    assert [value(spark, V.full_year(lit(y, "int"))) for y in (0, 69, 70, 99, 2024)] == [2000, 2069, 1970, 1999, 2024]
    assert [value(spark, V.time_micros(F.lit(t))) for t in ("-838:59:59", "12:34:56.5", "1:2", "x")] == [-3020399000000, 45296500000, 3720000000, None]
    assert value(spark, V.time_interval(F.lit("-01:00:00.25"))) == dt.timedelta(seconds=-3600.25)
    assert [value(spark, V.date_or_null(F.lit(t))) for t in ("0000-00-00", "2024-00-10", "2024-01-00", "2024-02-29", "2023-02-29")] == [None, None, None, dt.date(2024, 2, 29), None]
    assert value(spark, V.timestamp_or_null(F.lit("2024-00-10 01:02:03"))) is None
    assert value(spark, V.timestamp_or_null(F.lit("2024-10-10 01:02:03.5"))) == dt.datetime(2024, 10, 10, 1, 2, 3, 500000)
    assert bytes(value(spark, V.padded(F.lit(b"\x01"), 4))) == b"\x01\0\0\0"
    assert bytes(value(spark, V.padded(F.lit(b"\x01\x02\x03\x04\x05"), 4))) == b"\x01\x02\x03\x04\x05"
    assert [value(spark, V.rounded_default(F.lit(t))) for t in ("2.5", "-2.5", "7")] == [3, -2, 7]
    assert [value(spark, V.json_text(F.lit(b""), n)) for n in (True, False)] == [None, "{}"]
    assert bytes(value(spark, V.bit_bytes(F.lit("0000000111111111"), 16))) == b"\x01\xff"
    assert value(spark, V.decoded(F.lit(b"\xe9"), "latin1")) == "é"
    assert value(spark, V.little_endian(F.lit(b"\xff" * 8))) == Decimal(2**64 - 1)
    assert value(spark, V.little_endian(F.lit(b"\x01\x02\0\0"))) == 513
    assert value(spark, V.tso_millis(lit(453633636633935897, "bigint"))) == 1730474993263
    assert [value(spark, V.clamped_time(lit(x, "bigint"))) for x in (3_600_000_000, -1_000_000, 10**12)] == ["01:00:00", "00:00:01", "23:59:59"]
    assert V.quoted("a`b") == "`a``b`"


def test_geometry(spark):
    import json
    import struct

    point = struct.pack("<BIdd", 1, 1, 1.5, 2.0)
    line = struct.pack(">BII", 0, 2, 2) + struct.pack(">dddd", 0, 1, 2, 3)
    bag = struct.pack("<BII", 1, 7, 2) + point + line
    assert json.loads(value(spark, V.geometry_json(F.lit(struct.pack("<I", 4326) + bag)))) == {
        "type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1.5, 2.0]}, {"type": "LineString", "coordinates": [[0, 1], [2, 3]]}], "srid": 4326,
    }
    assert value(spark, V.geometry_json(F.lit(b"\0\0\0\0broken"))) is None


@pytest.mark.parametrize(
    "text,kind,nullable,want",
    [
        (None, "int", True, None), ("2.5", "int", True, 3), ("-2.5", "smallint", True, -2), ("true", "int", True, 1), ("_utf8'x''y'", "varchar(9)", True, "x'y"), (" 1.005 ", "decimal(5,2)", True, Decimal("1.01")),
        ("0000-00-00", "date", True, None), ("0000-00-00", "date", False, dt.date(1970, 1, 1)), ("2020/1/2 3-4-5", "datetime", True, dt.datetime(2020, 1, 2, 3, 4, 5)), ("20200102", "date", True, dt.date(2020, 1, 2)),
        ("CURRENT_TIMESTAMP(3)", "timestamp", True, dt.datetime(1970, 1, 1)), ("b'101'", "bit(9)", True, b"\0\x05"), ("1", "bit(1)", True, True), ("-01:00:00", "time", True, dt.timedelta(hours=-1)), ("1e3", "double", True, 1000.0),
    ],
)
def test_defaults(text, kind, nullable, want):
    assert V.default_value(text, kind, nullable) == want


def test_versions():
    assert V.version_key("5.7.44-log") == (5, 7, 44) and V.version_key("8") == (8, 0, 0)
    assert V.version_key("5.10.1") > V.version_key("5.9.9")


def test_row_codec(spark):
    columns = [R.ColumnInfo(1, "id", "int", handle=True), R.ColumnInfo(2, "n", "int"), R.ColumnInfo(300, "s", "string"), R.ColumnInfo(4, "u", "uint"), R.ColumnInfo(5, "gone", "string", default="d"), R.ColumnInfo(6, "x", "double")]
    values = {2: (-5).to_bytes(2, "little", signed=True), 300: "é".encode(), 4: (2**64 - 1).to_bytes(8, "little"), 6: bytes.fromhex("bff8000000000000")}
    for wide in (True, False):
        row = R.join_row(values if wide else {k: v for k, v in values.items() if k < 256} | {7: None})
        assert R.split_row(row) == (values if wide else {k: v for k, v in values.items() if k < 256} | {7: None})
    data = R.join_row(values)
    want = (9, -5, "é", Decimal(2**64 - 1), "d", 1.5)
    assert R.decode_row(data, 9, columns) == want
    assert tuple(value(spark, R.decode_rows(F.lit(data), lit(9, "bigint"), columns))) == want
    assert set(value(spark, R.decode_rows(F.lit(b"no row"), lit(9, "bigint"), columns))) == {None}
    key = R.record_key(-3, 2**40)
    assert R.split_key(key) == (-3, 2**40) and R.split_key(b"t") is None
    assert R.record_key(1, -1) < R.record_key(1, 0) < R.record_key(2, -9)
