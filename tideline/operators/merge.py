"""Snapshot and log to current state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_state(log: DataFrame, keys: list[str], pos: str = "pos", op: str = "op") -> DataFrame:
    """The last record of each key with all its columns, deleted keys left out.

    One aggregate, which combines on the map side, so that hot keys cost a row for each task. Positions
    don't repeat within a key but for repeated records.
    """
    rest = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), pos).alias("__last"))
    return last.where(F.col(f"__last.{op}") != "d").select(*(F.col(c) if c in keys else F.col(f"__last.{c}").alias(c) for c in log.columns))


def latest_values(log: DataFrame, keys: list[str], values: list[str], pos: str = "pos", op: str = "op") -> DataFrame:
    """The same of chosen columns only."""
    last = log.groupBy(*keys).agg(F.max_by(F.struct(op, *values), pos).alias("__last"))
    return last.where(F.col(f"__last.{op}") != "d").select(*keys, *(F.col(f"__last.{v}").alias(v) for v in values))


def upsert_chunk(snapshot: DataFrame, log: DataFrame, keys: list[str], in_chunk: Column, pos: str = "pos") -> DataFrame:
    """Snapshot rows of a chunk with the changes made while it was read: one row a key, as read records.

    Only changes whose chunk key lies in the chunk count: that before the change for u and d, that after for c. An
    update that moves a key out of the chunk is merged all the same, and the other chunk has it as well; the merge by
    key downstream makes that once.
    """
    merged = latest_state(snapshot.unionByName(log.where(in_chunk), allowMissingColumns=True), keys, pos)
    return merged.withColumn("op", F.lit("r"))


def multiset_state(log: DataFrame, columns: list[str], op: str = "op", before: str = "before", after: str = "after") -> DataFrame:
    """The rows of a table without a key: +1 for each new image, -1 for each old one, and as many rows as the sum says.

    The full row is the key, so only equal rows meet. An image that is taken away more often than it was there leaves
    nothing behind.
    """
    gone = F.when(F.col(op).isin("u", "d"), F.struct(F.lit(-1).alias("w"), F.col(before).alias("row")))
    here = F.when(F.col(op).isin("c", "r", "u"), F.struct(F.lit(1).alias("w"), F.col(after).alias("row")))
    weights = log.select(F.inline(F.array_compact(F.array(gone, here)))).where("row IS NOT NULL").select("w", *(F.col(f"row.{c}").alias(c) for c in columns))
    counted = weights.groupBy(*columns).agg(F.sum("w").alias("n")).where("n > 0")
    return counted.select(*columns, F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("__i")).drop("__i")


def moved_out(env: DataFrame, before_in: Column, after_in: Column) -> DataFrame:
    """Updates whose key was in the chunk before and isn't after."""
    return env.where((F.col("op") == "u") & before_in & ~after_in)


def log_bounds(chunks: DataFrame, high: str = "high_wm") -> DataFrame:
    """(start, stop): the log starts at the smallest high watermark of all chunks, and a bounded read stops at the largest."""
    return chunks.agg(F.min(high).alias("start"), F.max(high).alias("stop"))


def table_bounds(chunks: DataFrame, table: str = "table_id", high: str = "high_wm") -> DataFrame:
    """(table, max_wm): beyond it a table's changes pass without a look at its chunks."""
    return chunks.groupBy(table).agg(F.max(high).alias("max_wm"))


def meta_groups(chunks: DataFrame, size: int, order: str = "split_id") -> DataFrame:
    """Adds group_id: finished chunks in groups of size, in order."""
    return chunks.withColumn("group_id", F.floor((F.row_number().over(Window.orderBy(order)) - 1) / size))
