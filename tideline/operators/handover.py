"""The hand-over from snapshot to log: which changes are new to a chunk that was read at its own time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.merge import table_bounds
from tideline.plans.chunks import located


def handover(log: DataFrame, chunks: DataFrame, key: str, pos: str = "pos", table: str | None = None) -> DataFrame:
    """Changes to emit: past their table's largest high watermark, or in a chunk and past that chunk's.

    chunks has lo, hi, high_wm and, with table, that column; high_wm is the last position that the chunk has merged.
    Chunks are disjoint and cover all keys, so each change has one, which is looked up by binary search.
    """
    return chunk_of(log, chunks, key, table).where(F.col(pos) > F.col("__high_wm")).drop("__high_wm")


def chunk_of(log: DataFrame, chunks: DataFrame, key: str, table: str | None = None, name: str = "__high_wm") -> DataFrame:
    """The log with its chunk's high watermark."""
    return located(log, chunks.withColumn(name, F.col("high_wm")), key, [name], table)


def pure_phase(log: DataFrame, chunks: DataFrame, table: str = "table_id", pos: str = "pos", unseen: bool = False) -> DataFrame:
    """Changes past their table's largest high watermark: an equi-join with a row a table. With unseen, those of tables without chunks too."""
    bounds = table_bounds(chunks, table)  # a row a table, which adaptive execution broadcasts when it has seen its size
    joined = log.join(bounds, table, "left" if unseen else "inner")
    past = F.col(pos) > F.col("max_wm")
    return joined.where(past | F.col("max_wm").isNull() if unseen else past).drop("max_wm").select(*log.columns)


# --- chunks over the life of a job ---


def suspend(chunks: DataFrame, current: Column) -> DataFrame:
    """When the log reader stops for new tables: chunks that stream already are at the current position at least."""
    return chunks.withColumn("high_wm", F.greatest("high_wm", current))


def append_chunks(chunks: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all chunks, (start)): new tables' chunks join, and the log is read again from the smallest watermark."""
    every = chunks.unionByName(more)
    return every, every.agg(F.min("high_wm").alias("start"))


def drop_removed(chunks: DataFrame, captured: DataFrame, table: str = "table_id") -> DataFrame:
    """Chunks of tables that are still captured."""
    return chunks.join(captured.select(table).distinct(), table, "left_semi")


def new_tables(captured: DataFrame, known: DataFrame, table: str = "table_id") -> DataFrame:
    return captured.select(table).distinct().join(known.select(table), table, "left_anti")


def removed_tables(captured: DataFrame, known: DataFrame, table: str = "table_id") -> DataFrame:
    return new_tables(known, captured, table)
