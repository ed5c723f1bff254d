"""Column helpers shared by the operators that stay inside DataFrame expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What separates words: every ASCII character but digits and lower-case letters.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: ASCII white space.
SPACE = " \t\n\x0b\x0c\r"
#: Row keys: two columns of 64 bits each, by content, so that a recomputed task gives the same ones.
ROW = ["__row_a", "__row_b"]


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else. lower() does the same for pure ASCII and much faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """The words of the lower-cased text; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once however often body names it, in lambdas too."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hash_pair(*cols: Column) -> tuple[Column, Column]:
    """128 bits of hash as two longs, which group and join without objects."""
    return F.xxhash64(*cols), F.xxhash64(F.lit("salt"), *reversed(cols), F.lit(1))


def with_row_key(df: DataFrame, *cols: str) -> DataFrame:
    """Adds ROW, the hash of the given columns. Repeated rows share it, and so share what is found for them."""
    a, b = hash_pair(*(F.col(c) for c in cols))
    return df.withColumn(ROW[0], a).withColumn(ROW[1], b)


def replace_columns(df: DataFrame, results: dict[str, Column]) -> DataFrame:
    """Adds result columns; an input column of the same name gives way. Internal columns go."""
    keep = [F.col(f"`{c}`") for c in df.columns if not c.startswith("__") and c.lower() not in {r.lower() for r in results}]
    return df.select(*keep, *(c.alias(name) for name, c in results.items()))
