"""Encoded rows of a key-value store: the compact row format with a section of column ids, and record keys."""

from __future__ import annotations

import struct
from dataclasses import dataclass
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the format: the first byte, the flag of the wide layout.
MAGIC, WIDE = 0x80, 1


@dataclass(frozen=True)
class ColumnInfo:
    """A column of a table: its id, its name and how its bytes are read (int, uint, float, double, string, bytes)."""

    id: int
    name: str
    kind: str
    default: object = None
    handle: bool = False


def split_row(data: bytes) -> dict[int, bytes | None]:
    """Each column id of a row with its bytes; None for null. Ids that are missing took their default when the row was written."""
    if not data or data[0] != MAGIC:
        raise ValueError("not a row of this format")
    wide = data[1] & WIDE
    n, nulls = struct.unpack_from("<HH", data, 2)
    id_size, end_size = (4, 4) if wide else (1, 2)
    at = 6
    ids = [int.from_bytes(data[at + i * id_size : at + (i + 1) * id_size], "little") for i in range(n + nulls)]
    at += (n + nulls) * id_size
    ends = [int.from_bytes(data[at + i * end_size : at + (i + 1) * end_size], "little") for i in range(n)]
    at += n * end_size
    out: dict[int, bytes | None] = dict.fromkeys(ids[n:])
    for i, end in enumerate(ends):
        out[ids[i]] = data[at + (ends[i - 1] if i else 0) : at + end]
    return out


def join_row(values: dict[int, bytes | None]) -> bytes:
    """The inverse of split_row()."""
    there = sorted(i for i, v in values.items() if v is not None)
    gone = sorted(i for i, v in values.items() if v is None)
    body = b"".join(values[i] for i in there)
    wide = max([0, *values]) > 255 or len(body) > 0xFFFF
    id_size, end_size = (4, 4) if wide else (1, 2)
    ends, total = [], 0
    for i in there:
        total += len(values[i])
        ends.append(total.to_bytes(end_size, "little"))
    return bytes([MAGIC, WIDE if wide else 0]) + struct.pack("<HH", len(there), len(gone)) + b"".join(i.to_bytes(id_size, "little") for i in there + gone) + b"".join(ends) + body


def read_value(data: bytes | None, kind: str):
    if data is None:
        return None
    if kind == "int":
        return int.from_bytes(data, "little", signed=True)
    if kind == "uint":
        return Decimal(int.from_bytes(data, "little"))
    if kind in ("float", "double"):
        bits = int.from_bytes(data, "big")
        bits = bits & ~(1 << 63) if bits >> 63 else ~bits & (1 << 64) - 1  # sortable order back to IEEE
        return struct.unpack(">d", bits.to_bytes(8, "big"))[0]
    return data.decode() if kind == "string" else data


def decode_row(data: bytes, handle: int | None, columns: list[ColumnInfo]) -> tuple:
    """The values of the columns, in their order."""
    found = split_row(data)
    return tuple(handle if c.handle else read_value(found[c.id], c.kind) if c.id in found else c.default for c in columns)


SPARK = {"int": "bigint", "uint": "decimal(20,0)", "float": "double", "double": "double", "string": "string", "bytes": "binary"}


def decode_rows(data: Column, handle: Column, columns: list[ColumnInfo]) -> Column:
    """A struct of the columns' values, in Arrow batches; null for bytes that are no row."""
    @F.pandas_udf(", ".join(f"`{c.name}` {SPARK[c.kind]}" for c in columns))
    def decode(rows: pd.Series, handles: pd.Series) -> pd.DataFrame:
        out = []
        for row, h in zip(rows, handles, strict=True):
            try:
                out.append(decode_row(bytes(row), h, columns))
            except (TypeError, ValueError, struct.error):
                out.append((None,) * len(columns))
        return pd.DataFrame(out, columns=[c.name for c in columns], dtype=object)

    return decode(data, handle)


def record_key(table_id: int, handle: int) -> bytes:
    """t, the table, _r, the row: signed numbers in an order that bytes keep."""
    return b"t" + (table_id + 2**63).to_bytes(8, "big") + b"_r" + (handle + 2**63).to_bytes(8, "big")


def split_key(key: bytes) -> tuple[int, int] | None:
    """(table, handle) of a record key; None for other keys."""
    if len(key) != 19 or key[:1] != b"t" or key[9:11] != b"_r":
        return None
    return int.from_bytes(key[1:9], "big") - 2**63, int.from_bytes(key[11:], "big") - 2**63
