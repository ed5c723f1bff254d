"""Lock-free snapshots: chunks read at their own times, each with the changes made meanwhile."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.merge import latest_state
from tideline.plans.chunks import located


def scan_chunks(table: DataFrame, chunks: DataFrame, key: str) -> DataFrame:
    """The table's rows with chunk_no, which is looked up by binary search."""
    return located(table, chunks, key, ["chunk_no"])


def chunk_rows(table: DataFrame, key: str, lo, hi) -> DataFrame:
    """One chunk: its range reaches the scan as a filter."""
    k, rows = F.col(key), table
    if lo is not None:
        rows = rows.where(k >= F.lit(lo))
    if hi is not None:
        rows = rows.where(k < F.lit(hi)) if lo is not None else rows.where((k < F.lit(hi)) | k.isNull())
    return rows


def at_watermark(log: DataFrame, keys: list[str], chunks: DataFrame, key: str, mark: str, pos: str = "pos") -> DataFrame:
    """What a snapshot of each chunk would read when the log stood at the chunk's mark (low_wm or high_wm)."""
    seen = located(log, chunks.withColumn("__wm", F.col(mark)), key, ["__wm"]).where(F.col(pos) <= F.col("__wm")).drop("__wm")
    return latest_state(seen, keys, pos)


def backfilled(log: DataFrame, keys: list[str], chunks: DataFrame, key: str, skip: bool = False, pos: str = "pos") -> DataFrame:
    """Each chunk as of its high watermark: the rows read at the low one, and the changes (low, high] merged in.

    With skip nothing is merged: the chunk stays as read, and the log, from the low watermark on, may say again what
    is in it; the merge by key downstream takes both.
    """
    read = at_watermark(log, keys, chunks, key, "low_wm", pos).withColumn("op", F.lit("r"))
    if skip:
        return read
    placed = located(log, chunks.select("lo", "hi", F.col("low_wm").alias("__low"), F.col("high_wm").alias("__high")), key, ["__low", "__high"])
    changes = placed.where((F.col(pos) > F.col("__low")) & (F.col(pos) <= F.col("__high"))).drop("__low", "__high")
    return latest_state(read.unionByName(changes), keys, pos).withColumn("op", F.lit("r"))


PHASES = ("before_low", "after_low", "before_high", "after_high")


@dataclass
class SnapshotDriver:
    """Reads a table chunk by chunk, taking the log's position before and after; for sources that have one.

    position() tells where the log stands, read(lo, hi) gives a chunk's rows. Hooks by PHASES run between the steps,
    which is how tests write into a table while it is read.
    """

    position: Callable[[], int]
    read: Callable[[object, object], DataFrame]
    hooks: dict[str, Callable[[int], None]] = field(default_factory=dict)
    skip_backfill: bool = False

    def _at(self, phase: str, chunk: int) -> None:
        if phase in self.hooks:
            self.hooks[phase](chunk)

    def chunk(self, number: int, lo, hi, store: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, dict]:
        """(rows, control record): store makes the rows permanent between the two positions."""
        self._at("before_low", number)
        low = self.position()
        self._at("after_low", number)
        rows = store(self.read(lo, hi))
        self._at("before_high", number)
        high = low if self.skip_backfill else self.position()
        self._at("after_high", number)
        return rows, {"chunk_no": number, "lo": lo, "hi": hi, "low_wm": low, "high_wm": high}


def progress(rows: DataFrame, name: str = "snapshot") -> DataFrame:
    """Observes the rows that pass, as a metric of the query: no second pass."""
    return rows.observe(name, F.count(F.lit(1)).alias("rows"))


def lag(fetched: Column, source: Column) -> Column:
    """How far behind its source a record was read; never negative."""
    return F.greatest(fetched - source, F.lit(0))
