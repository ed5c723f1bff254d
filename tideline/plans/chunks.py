"""Snapshot chunks: how a keyed table is cut into half-open key ranges, and which of them a key lies in."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import ROUND_CEILING, Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.sources.shared import written

CHUNK_SIZE, LOWER, UPPER = 8096, 0.05, 1000.0
#: Key types whose distance is a number.
EVEN_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)


@dataclass(frozen=True)
class KeyStats:
    """Of a table's chunk key: smallest and largest value, rows, and rows without a key."""

    low: object
    high: object
    rows: int

    def factor(self) -> Decimal | None:
        """(max - min + 1) / rows to four digits, rounded up: how sparse the keys are; None for no rows."""
        if not self.rows or self.low is None:
            return None
        span = Decimal(self.high) - Decimal(self.low) + 1
        return (span / self.rows).quantize(Decimal("0.0001"), rounding=ROUND_CEILING)


def key_stats(df: DataFrame, key: str) -> DataFrame:
    """(low, high, n): one aggregate, which Parquet answers from footers where it can."""
    return df.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n"))


def even_step(stats: KeyStats, even: bool, chunk_size: int = CHUNK_SIZE, lower: float = LOWER, upper: float = UPPER) -> int | None:
    """The distance between boundaries of even chunks, or None where rows are to be counted instead."""
    factor = stats.factor()
    if not even or factor is None or not lower <= factor <= upper:
        return None
    return max(int(factor * chunk_size), 1)


def _exact(n) -> Column:
    """An integer of any size as a literal."""
    return F.lit(str(n)).cast("decimal(38,0)")


def _ranges(boundaries: DataFrame) -> DataFrame:
    """(chunk_no, lo, hi) between boundaries (i, b), i from 1; the first and last range are open."""
    from pyspark.sql import Window

    w = Window.orderBy("i")  # a boundary for each chunk: small, by definition of a chunk
    inner = boundaries.select(F.col("i").alias("chunk_no"), F.col("b").alias("lo"), F.lead("b").over(w).alias("hi"))
    first = boundaries.agg(F.min("b").alias("hi")).select(F.lit(0).cast("long").alias("chunk_no"), F.lit(None).cast(boundaries.schema["b"].dataType).alias("lo"), "hi")
    return first.union(inner)


def even_chunks(spark: SparkSession, stats: KeyStats, step: int, key_type: T.DataType, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """(chunk_no, lo, hi): boundaries low + i * step up to high; one range where the rows fit in a chunk. Beyond the type's range boundaries end."""
    whole = stats.rows <= chunk_size or stats.low is None or stats.low == stats.high
    n = 0 if whole else int((Decimal(stats.high) - Decimal(stats.low)) // step)
    if n < 1:
        return whole_table(spark, key_type)
    value = _exact(stats.low) + F.col("id").cast("decimal(38,0)") * _exact(step)
    boundaries = spark.range(1, n + 1).select(F.col("id").alias("i"), value.cast(key_type).alias("b"))
    return _ranges(boundaries)


def whole_table(spark: SparkSession, key_type: T.DataType) -> DataFrame:
    """The one open range."""
    none = F.lit(None).cast(key_type)
    return spark.range(1).select(F.col("id").alias("chunk_no"), none.alias("lo"), none.alias("hi"))


def uneven_chunks(df: DataFrame, key: str, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """(chunk_no, lo, hi) by counted rows, for keys of any ordered type without duplicates.

    One after another, a chunk's end is the chunk_size-th key from its start, which begins the next chunk: the keys of
    rank i * (chunk_size - 1), i from 1. Ranks are found in parallel: rows are counted by ranges of keys, and ranked
    within them. The last boundary must lie below the largest key.
    """
    if chunk_size < 2:
        raise ValueError("a chunk holds two rows at least")
    ranked = dense_rank_by_range(df.where(F.col(key).isNotNull()).select(F.col(key).alias("k")), "k")
    at = ranked.where((F.col("rank") > 0) & (F.col("rank") % (chunk_size - 1) == 0) & (F.col("rank") < F.col("total") - 1))
    boundaries = at.select((F.col("rank") / (chunk_size - 1)).cast("long").alias("i"), F.col("k").alias("b"))
    found = _ranges(boundaries)
    return found.where("chunk_no > 0 OR hi IS NOT NULL").unionByName(whole_table(df.sparkSession, df.schema[key].dataType).join(boundaries.limit(1), how="left_anti"))


#: Rows of a range of keys, which one task numbers.
RANGE_ROWS = 1_000_000


def dense_rank_by_range(keys: DataFrame, key: str, rows: int = RANGE_ROWS) -> DataFrame:
    """Adds rank, from 0 in key order, and total, without putting all rows in one task.

    Keys of any ordered type are dealt by ranges of about so many rows, sorted within them, and written with the number
    of their range and their place in it; counts of the ranges, added up, are where each begins. Only a row for each
    range stands in one task.
    """
    from pyspark.sql import Window

    n = max(8, -(-keys.count() // rows))
    placed = written(keys.repartitionByRange(n, key).sortWithinPartitions(key).withColumn("__id", F.monotonically_increasing_id()))
    placed = placed.withColumn("__range", F.shiftright("__id", 33)).withColumn("__at", F.col("__id").bitwiseAND(2**33 - 1))
    sizes = placed.groupBy("__range").agg(F.count("*").alias("n"))
    w = Window.orderBy("__range")
    starts = sizes.select("__range", (F.sum("n").over(w) - F.col("n")).alias("start"), F.sum("n").over(Window.partitionBy()).alias("total"))
    return placed.join(starts, "__range").withColumn("rank", F.col("start") + F.col("__at")).drop("__range", "__at", "__id", "start")


#: Bytes of chunks that are broadcast at once; of more, some at a time.
BROADCAST_BYTES = 64 << 20


def located(rows: DataFrame, chunks: DataFrame, key: str, columns: list[str], table: str | None = None, most: int = BROADCAST_BYTES) -> DataFrame:
    """The rows with the chosen columns of the chunk that their key lies in; rows in none are left out.

    chunks has lo and hi and, with table, that column; they are disjoint. Each table's chunks are one sorted array,
    which is broadcast, and a row's is found by halves: a few comparisons a row, no range join. Their size is taken
    first. Chunks of more than `most` bytes are cut by their bounds into parts, and rows looked up part by part.
    """
    by = [table] if table else []
    width = F.coalesce(F.octet_length(F.col("lo").cast("string")), F.lit(0)) * 2 + 48
    n, size = chunks.select(width.alias("w")).agg(F.count("*"), F.sum("w")).first()
    parts = -(-(size or 0) // most)
    if parts <= 1:
        return _searched(rows, chunks, key, columns, by, n)
    ranked = dense_rank_by_range(chunks.where("lo IS NOT NULL").select("lo"), "lo")
    cut = (F.col("rank") > 0) & (F.col("rank") % F.ceil(F.col("total") / parts) == 0)
    cuts = [r["lo"] for r in ranked.where(cut).select("lo").distinct().orderBy("lo").collect()]  # one for each part
    out = None
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        here = F.col(key).isNull() | (F.col(key) < F.lit(high)) if low is None else F.col(key) >= F.lit(low)
        here = here & (F.col(key) < F.lit(high)) if low is not None and high is not None else here
        overlap = F.lit(True) if high is None else F.col("lo").isNull() | (F.col("lo") < F.lit(high))
        overlap = overlap if low is None else overlap & (F.col("hi").isNull() | (F.col("hi") > F.lit(low)))
        part = _searched(rows.where(here), chunks.where(overlap), key, columns, by, n)
        out = part if out is None else out.unionByName(part)
    return out


def _searched(rows: DataFrame, chunks: DataFrame, key: str, columns: list[str], by: list[str], n: int) -> DataFrame:
    entry = F.struct(F.col("lo").isNotNull().alias("bounded"), F.col("lo").alias("lo"), F.col("hi").alias("hi"), *(F.col(c).alias(c) for c in columns))
    listed = F.broadcast(chunks.groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("__chunks")))
    joined = rows.join(listed, by) if by else rows.withColumn("__one", F.lit(1)).join(listed.withColumn("__one", F.lit(1)), "__one").drop("__one")

    def further(at: Column, step: Column) -> Column:
        """Places by powers of two: on by the step if the chunk there doesn't begin behind the key."""
        c = F.get("__chunks", at + step - 1)
        return F.when(c["bounded"].isNotNull() & (~c["bounded"] | F.coalesce(c["lo"] <= F.col(key), F.lit(False))), at + step).otherwise(at)

    powers = F.array(*(F.lit(1 << i) for i in reversed(range(max(1, int(n).bit_length())))))
    found = joined.withColumn("__c", F.get("__chunks", F.aggregate(powers, F.lit(0), further) - 1)).drop("__chunks")
    inside = F.col("__c.bounded").isNotNull() & key_in(F.col(key), F.col("__c.lo"), F.col("__c.hi"))
    return found.where(inside).select(*(f"`{c}`" for c in rows.columns), *(F.col(f"__c.{c}").alias(c) for c in columns))


def next_boundary(df: DataFrame, key: str, start, chunk_size: int) -> DataFrame:
    """(next_max): the largest of the next chunk_size keys from start: a top-n, then one aggregate."""
    return df.where(F.col(key) >= F.lit(start)).select(key).orderBy(key).limit(chunk_size).agg(F.max(key).alias("next_max"))


def min_above(df: DataFrame, key: str, bound) -> DataFrame:
    """(next_min): the smallest key above bound."""
    return df.where(F.col(key) > F.lit(bound)).agg(F.min(key).alias("next_min"))


def iterate_uneven(df: DataFrame, key: str, chunk_size: int, start=None, number: int = 0):
    """Uneven chunks one at a time, for keys with duplicates: yields (chunk_no, lo, hi), and can go on from any of them."""
    high = df.agg(F.max(key)).first()[0]
    low = start if start is not None else df.agg(F.min(key)).first()[0]
    lo = start
    while True:
        if low is None:
            yield number, lo, None
            return
        end = next_boundary(df, key, low, chunk_size).first()[0]
        if end == low:
            end = min_above(df, key, end).first()[0]
        if end is None or end >= high:
            yield number, lo, None
            return
        yield number, lo, end
        number, lo, low = number + 1, end, end


def key_in(key: Column, lo: Column, hi: Column) -> Column:
    """Whether a key lies in [lo, hi), null ends being open; a null key lies in the range that is open below."""
    return F.when(key.isNull(), lo.isNull()).otherwise((lo.isNull() | (key >= lo)) & (hi.isNull() | (key < hi)))


def comparable(key: Column, kind: T.DataType, other: T.DataType) -> tuple[Column, str]:
    """A key cast so that it compares with values of another type, and the type that both take: the same stays, numbers meet as exact decimals (or doubles where one is), all else as text."""
    if kind == other:
        return key, kind.simpleString()
    if isinstance(kind, T.NumericType) and isinstance(other, T.NumericType):
        both = "double" if any(isinstance(x, (T.FloatType, T.DoubleType)) for x in (kind, other)) else "decimal(38,10)"
        return key.cast(both), both
    return key.cast("string"), "string"


def scan_predicates(key: str, ranges: list[tuple]) -> list[str]:
    """A predicate for each range, as spark.read.jdbc takes them, one partition each."""

    def literal(v) -> str:
        return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v)

    name, out = f"`{key.replace('`', '``')}`", []
    for lo, hi in ranges:
        parts = ([f"{name} >= {literal(lo)}"] if lo is not None else []) + ([f"{name} < {literal(hi)}"] if hi is not None else [])
        text = " AND ".join(parts) or "1 = 1"
        out.append(f"({text}) OR {name} IS NULL" if lo is None and hi is not None else text)
    return out


def handle_ranges(spark: SparkSession, n: int) -> DataFrame:
    """(chunk_no, lo, hi): the signed 64-bit handle space in n equal parts, [lo, hi), the last one to its end. Exact decimals."""
    low, span = -(2**63), 2**64
    step = span // n
    at = F.col("id").cast("decimal(38,0)") * _exact(step) + _exact(low)
    end = F.when(F.col("id") == n - 1, _exact(low + span)).otherwise(at + _exact(step))
    return spark.range(n).select(F.col("id").alias("chunk_no"), at.cast("decimal(20,0)").alias("lo"), end.cast("decimal(20,0)").alias("hi"))


def is_record_key(key: Column) -> Column:
    """Whether an encoded key is a row's: `_r` after the table prefix."""
    return F.substring(key, 10, 2) == F.unhex(F.lit("5F72"))


def overlap(lo: Column, hi: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """The intersection of two closed-open ranges; empty where its start isn't below its end."""
    return F.greatest(lo, start), F.least(hi, end)
