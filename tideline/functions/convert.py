"""Value converters: raw source values to Spark values, as column expressions."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of unsigned integers, and the type that holds them.
UNSIGNED = {"tinyint": (8, "smallint"), "smallint": (16, "int"), "mediumint": (24, "bigint"), "int": (32, "bigint"), "bigint": (64, "decimal(20,0)")}


def unsigned(value: Column, kind: str) -> Column:
    """The value that a negative number stands for in an unsigned column."""
    bits, to = UNSIGNED[kind]
    wide = value.cast("decimal(20,0)")
    return F.when(value < 0, wide + F.lit(str(2**bits)).cast("decimal(20,0)")).otherwise(wide).cast(to)


def enum_label(index: Column, labels: list[str]) -> Column:
    """The label of an index from 1; '' for 0, null beyond."""
    return F.when(index == 0, F.lit("")).when(index > 0, F.get(F.array(*map(F.lit, labels)), (index - 1).cast("int")))


def set_text(mask: Column, labels: list[str]) -> Column:
    """The labels of a mask's bits, in declaration order, comma-joined."""
    each = (F.when(F.shiftright(mask, i).bitwiseAND(F.lit(1)) == 1, F.lit(x)) for i, x in enumerate(labels))
    return F.when(mask.isNotNull(), F.concat_ws(",", *each))


def set_array(text: Column) -> Column:
    """A comma list as an array; '' is an array of one ''."""
    return F.split(text, ",", -1)


def full_year(year: Column) -> Column:
    """Two-digit years: 0 to 69 are in 2000s, 70 to 99 in 1900s."""
    return F.when((year >= 0) & (year <= 69), year + 2000).when((year >= 70) & (year <= 99), year + 1900).otherwise(year)


TIME_TEXT = r"^([+-]?)(\d{1,3}):(\d{1,2})(?::(\d{1,2})(?:\.(\d{1,6})\d*)?)?$"


def time_micros(text: Column) -> Column:
    """Microseconds of a signed time [+-]hhh:mm[:ss[.f]]; null for other texts."""

    def part(i: int) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(text, TIME_TEXT, i), F.lit("")).cast("bigint"), F.lit(0).cast("bigint"))

    fraction = F.rpad(F.regexp_extract(text, TIME_TEXT, 5), 6, "0").cast("bigint")
    micros = (part(2) * 3600 + part(3) * 60 + part(4)) * 1_000_000 + fraction
    return F.when(text.rlike(TIME_TEXT), F.when(F.regexp_extract(text, TIME_TEXT, 1) == "-", -micros).otherwise(micros))


def time_interval(text: Column) -> Column:
    """The same as an interval of hours to seconds."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (time_micros(text) / F.lit(1_000_000)).cast("decimal(18,6)")).cast("interval hour to second")


def date_or_null(text: Column) -> Column:
    """A date; null where the year, month or day is zero, or there is no such day."""
    return F.when(~text.rlike(r"^0+-|-0+-|-0+(?:\D|$)"), F.try_to_timestamp(text).cast("date"))


def timestamp_or_null(text: Column) -> Column:
    """A local date and time; null where its date part holds a zero, or it doesn't exist."""
    return F.when(~text.rlike(r"^0+-|-0+-|-0+(?:\D|$)"), F.try_to_timestamp(text).cast("timestamp_ntz"))


def decoded(data: Column, charset: str | None) -> Column:
    """Bytes as text, by the column's charset; UTF-8 where it is unknown."""
    known = {"latin1": "ISO-8859-1", "ascii": "US-ASCII", "utf16": "UTF-16", "ucs2": "UTF-16BE", "binary": "ISO-8859-1"}
    return F.decode(data, known.get((charset or "utf8").lower(), "UTF-8"))


def json_text(data: Column, nullable: bool = True) -> Column:
    """JSON bytes as text; none at all are null, or an empty object in a column that can't be."""
    text = F.nullif(data.cast("string"), F.lit(""))
    return text if nullable else F.coalesce(text, F.lit("{}"))


def rounded_default(text: Column) -> Column:
    """An integer default given with a fraction: to the nearest, halves upwards."""
    return F.floor(text.cast("decimal(38,10)") + F.lit(Decimal("0.5"))).cast("bigint")


def float_type(length: int | None, scale: int | None) -> T.DataType:
    """FLOAT(p) is single precision up to 24 bits and without a scale."""
    return T.FloatType() if scale is None and (length is None or length <= 24) else T.DoubleType()


def padded(data: Column, length: int) -> Column:
    """A fixed-length binary value, filled up with zero bytes on the right."""
    return F.when(F.octet_length(data) < length, F.rpad(data, length, F.unhex(F.lit("00")))).otherwise(data)


def bit_bytes(text: Column, length: int) -> Column:
    """The bytes of a string of 0 and 1: groups of eight bits from the right, first byte first."""
    width = -(-length // 8) * 8
    return F.unhex(F.lpad(F.conv(text, 2, 16), width // 4, "0"))


def bit_flag(text: Column) -> Column:
    return text.cast("string") == "1"


def little_endian(data: Column) -> Column:
    """An unsigned little-endian number of up to 8 bytes."""
    return F.conv(_reversed_hex(data), 16, 10).cast("decimal(20,0)")


def _reversed_hex(data: Column) -> Column:
    """The hex digits of bytes, last byte first."""
    return F.array_join(F.reverse(F.filter(F.split(F.hex(data), "(?<=\\G..)"), lambda x: x != "")), "")


def tso_millis(tso: Column) -> Column:
    """The physical part of a timestamp of the oracle: milliseconds, without its 18 logical bits."""
    return F.shiftright(tso, 18)


def formatted(ts: Column, pattern: str, zone: str | None = None) -> Column:
    """A timestamp as text by a pattern, moved from UTC to a zone where one is given; null stays null."""
    return F.date_format(F.from_utc_timestamp(ts, zone) if zone else ts, pattern)


def clamped_time(micros: Column) -> Column:
    """A time of day HH:mm:ss; one beyond a day, or negative, by its absolute value within the last second of the day."""
    seconds = F.least(F.floor(F.abs(micros) / 1_000_000), F.lit(86_399))
    return F.concat_ws(":", *(F.lpad(F.floor(x).cast("string"), 2, "0") for x in (seconds / 3600, (seconds % 3600) / 60, seconds % 60)))


def quoted(name: str) -> str:
    """An identifier in back-ticks."""
    return "`" + name.strip("`").replace("`", "``") + "`"


# --- geometry ---

SHAPES = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}


def parse_wkb(data: bytes, at: int = 0) -> tuple[dict, int]:
    """A well-known-binary geometry as a GeoJSON-like dict, and where it ends."""
    import struct

    order = "<" if data[at] else ">"
    shape = struct.unpack_from(order + "I", data, at + 1)[0]
    at += 5

    def number() -> int:
        nonlocal at
        at += 4
        return struct.unpack_from(order + "I", data, at - 4)[0]

    def point() -> list[float]:
        nonlocal at
        at += 16
        return list(struct.unpack_from(order + "dd", data, at - 16))

    kind = SHAPES[shape]
    if kind == "Point":
        return {"type": kind, "coordinates": point()}, at
    if kind == "LineString":
        return {"type": kind, "coordinates": [point() for _ in range(number())]}, at
    if kind == "Polygon":
        return {"type": kind, "coordinates": [[point() for _ in range(number())] for _ in range(number())]}, at
    parts = []
    for _ in range(number()):
        part, at = parse_wkb(data, at)
        parts.append(part)
    return ({"type": kind, "geometries": parts} if kind == "GeometryCollection" else {"type": kind, "coordinates": [p["coordinates"] for p in parts]}), at


def geometry_json(data: Column) -> Column:
    """A stored geometry (four bytes of SRID, then well-known binary) as JSON with its srid; null for null and for broken bytes."""
    @F.pandas_udf("string")
    def convert(values: pd.Series) -> pd.Series:
        import json
        import struct

        def one(v):
            if v is None or len(v) < 9:
                return None
            try:
                shape, _ = parse_wkb(bytes(v), 4)
            except (KeyError, IndexError, struct.error):
                return None
            return json.dumps(shape | {"srid": int.from_bytes(v[:4], "little")})

        return values.map(one)

    return convert(data)


def wkb_struct(data: Column) -> Column:
    """A stored geometry as a struct of its well-known binary and its srid (null for 0); null for null and for less than a geometry."""
    srid = F.conv(_reversed_hex(F.substring(data, 1, 4)), 16, 10).cast("int")
    return F.when(F.octet_length(data) >= 9, F.struct(F.substring(data, 5, 2**31 - 1).alias("wkb"), F.when(srid != 0, srid).alias("srid")))


# --- boundaries of chunks, kept in control documents ---


def boundary_text(value) -> str | None:
    """A chunk's boundary as text that keeps its type; None for an open end. boundary_value() gives it back."""
    kinds = {bool: "bool", int: "int", float: "float", str: "str", Decimal: "decimal", bytes: "bytes", date: "date", datetime: "datetime"}
    if value is None:
        return None
    if type(value) not in kinds:
        raise TypeError(f"no boundary of type {type(value).__name__}")
    text = value.hex() if isinstance(value, (bytes, float)) else value.isoformat() if isinstance(value, date) else str(value)
    return f"{kinds[type(value)]}:{text}"


def boundary_value(text: str | None):
    if text is None:
        return None
    kind, _, body = text.partition(":")
    read = {"bool": lambda x: x == "True", "int": int, "float": float.fromhex, "str": str, "decimal": Decimal, "bytes": bytes.fromhex, "date": date.fromisoformat, "datetime": datetime.fromisoformat}
    return read[kind](body)


# --- defaults of columns, as the catalog gives them ---


def clean_timestamp(text: str) -> str:
    """A timestamp default with any separators as yyyy-MM-dd HH:mm:ss[.f]."""
    numbers = re.findall(r"\d+", text)
    if len(numbers) == 1 and len(numbers[0]) in (8, 14):
        n = numbers[0]
        numbers = [n[:4], n[4:6], n[6:8], *([n[8:10], n[10:12], n[12:14]] if len(n) == 14 else [])]
    numbers += ["0"] * (6 - len(numbers))
    y, mo, d, h, mi, s = numbers[:6]
    return f"{int(y):04d}-{int(mo):02d}-{int(d):02d} {int(h):02d}:{int(mi):02d}:{int(s):02d}" + (f".{numbers[6]}" if len(numbers) > 6 else "")


def default_value(text: str | None, source_type: str, nullable: bool = True):
    """A column's default as a Python value of its Spark type. Zero dates are null where they may be, else the epoch; a current timestamp is the epoch."""
    from tideline.functions.types import parse_type, spark_type

    if text is None:
        return None
    kind, (name, args) = spark_type(source_type), parse_type(source_type)
    text = re.sub(r"^_[a-z0-9]+\s*(?='.*'$)", "", text, flags=re.I | re.S)
    if re.fullmatch(r"'.*'", text, re.S):
        text = text[1:-1].replace("''", "'")
    if isinstance(kind, T.StringType):
        return text
    text = text.strip()
    if name.startswith("BIT") or isinstance(kind, T.BooleanType):
        bits = re.sub(r"^b'?([01]+)'?$", r"\1", {"true": "1", "false": "0"}.get(text.lower(), text))
        if isinstance(kind, T.BooleanType):
            return int(bits, 2 if set(bits) <= {"0", "1"} else 10) != 0
        return int(bits, 2).to_bytes(-(-int(args[0]) // 8), "big")
    text = {"true": "1", "false": "0"}.get(text.lower(), text)
    if isinstance(kind, T.IntegralType):
        return int((Decimal(text) + Decimal("0.5")).to_integral_value("ROUND_FLOOR"))
    if isinstance(kind, T.DecimalType):
        return Decimal(text).quantize(Decimal(1).scaleb(-kind.scale), rounding=ROUND_HALF_UP)
    if isinstance(kind, T.FractionalType):
        return float(text)
    if isinstance(kind, T.DayTimeIntervalType):
        m = re.fullmatch(r"(-?)(\d+):(\d+)(?::(\d+)(?:\.(\d+))?)?", text)
        whole = timedelta(hours=int(m[2]), minutes=int(m[3]), seconds=int(m[4] or 0), microseconds=int((m[5] or "0").ljust(6, "0")[:6]))
        return -whole if m[1] else whole
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        is_date = isinstance(kind, T.DateType)
        epoch = date(1970, 1, 1) if is_date else datetime(1970, 1, 1)
        if re.match(r"(current_timestamp|now|localtime)", text, re.I):
            return epoch
        clean = clean_timestamp(text)
        if re.match(r"0000-|\d+-00-|\d+-\d+-00", clean):
            return None if nullable else epoch
        return date.fromisoformat(clean[:10]) if is_date else datetime.fromisoformat(clean)
    return text.encode()


# --- versions ---


def version_key(text: str) -> tuple[int, int, int]:
    """major.minor.patch as numbers; what follows a dash doesn't count, missing parts are 0."""
    numbers = [int(x) for x in text.partition("-")[0].split(".")[:3]]
    return tuple([*numbers, 0, 0, 0][:3])
