"""Types of source columns as Spark types. The source's own type stays in the field's metadata."""

from __future__ import annotations

import re

from pyspark.sql import types as T

TIME = T.DayTimeIntervalType(T.DayTimeIntervalType.HOUR, T.DayTimeIntervalType.SECOND)
# The source's type names by the Spark type they become.
SIMPLE: dict[str, T.DataType] = {
    **dict.fromkeys(("BOOL", "BOOLEAN"), T.BooleanType()),
    "TINYINT": T.ByteType(),
    **dict.fromkeys(("TINYINT UNSIGNED", "SMALLINT"), T.ShortType()),
    **dict.fromkeys(("SMALLINT UNSIGNED", "INT", "INTEGER", "MEDIUMINT", "YEAR"), T.IntegerType()),
    **dict.fromkeys(("INT UNSIGNED", "INTEGER UNSIGNED", "MEDIUMINT UNSIGNED", "BIGINT"), T.LongType()),
    **dict.fromkeys(("BIGINT UNSIGNED", "SERIAL"), T.DecimalType(20, 0)),
    **dict.fromkeys(("FLOAT", "FLOAT UNSIGNED"), T.FloatType()),
    **dict.fromkeys(("REAL", "REAL UNSIGNED", "DOUBLE", "DOUBLE UNSIGNED", "DOUBLE PRECISION", "DOUBLE PRECISION UNSIGNED"), T.DoubleType()),
    "TIME": TIME,
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(),
    **dict.fromkeys(("CHAR", "VARCHAR", "TINYTEXT", "TEXT", "MEDIUMTEXT", "LONGTEXT", "JSON", "ENUM"), T.StringType()),
    **dict.fromkeys(("GEOMETRY", "POINT", "LINESTRING", "POLYGON", "MULTIPOINT", "MULTILINESTRING", "MULTIPOLYGON", "GEOMETRYCOLLECTION", "GEOMCOLLECTION"), T.StringType()),
    **dict.fromkeys(("BINARY", "VARBINARY", "TINYBLOB", "BLOB", "MEDIUMBLOB", "LONGBLOB"), T.BinaryType()),
    "SET": T.ArrayType(T.StringType()),
}
DECIMALS = frozenset(("DECIMAL", "NUMERIC", "FIXED"))


def parse_type(text: str) -> tuple[str, list[str]]:
    """A column type as written: its name, upper case and without ZEROFILL, and its arguments."""
    m = re.fullmatch(r"\s*([A-Za-z][A-Za-z ]*?)\s*(?:\((.*)\))?\s*((?:UNSIGNED|SIGNED|ZEROFILL|\s)*)", text, re.I | re.S)
    if not m:
        raise ValueError(f"not a column type: {text!r}")
    name, tail = re.sub(r"\s+", " ", m[1].upper()), (m[3] or "").upper()
    for word in ("ZEROFILL", "SIGNED"):
        name = re.sub(rf"(^| ){word}$", "", name)
    unsigned = "UNSIGNED" in tail.split() or "ZEROFILL" in tail.split()
    if unsigned and not name.endswith("UNSIGNED"):
        name += " UNSIGNED"
    return name, re.findall(r"'(?:[^']|'')*'|[^,\s]+", m[2] or "")


def spark_type(text: str) -> T.DataType:
    """The Spark type of a source type; raises ValueError for types that have none."""
    name, args = parse_type(text)
    base = name.removesuffix(" UNSIGNED")
    if base == "BIT":
        return T.BooleanType() if int(args[0] if args else 1) == 1 else T.BinaryType()
    if base == "TINYINT" and args == ["1"]:
        return T.BooleanType()
    if base in DECIMALS:
        precision, scale = int(args[0]) if args else 10, int(args[1]) if len(args) > 1 else 0
        return T.DecimalType(precision, scale) if precision <= 38 else T.StringType()
    if name in SIMPLE:
        return SIMPLE[name]
    if base in SIMPLE and base not in ("TINYINT", "SMALLINT", "INT", "INTEGER", "MEDIUMINT", "BIGINT"):
        return SIMPLE[base]
    raise ValueError(f"no Spark type for {text!r}")


def field(name: str, text: str, nullable: bool = True, **more) -> T.StructField:
    """A column with its source type, and what else is known of it (default, comment, charset, key place), as metadata."""
    return T.StructField(name, spark_type(text), nullable, {"source_type": text, **{k: v for k, v in more.items() if v is not None}})
