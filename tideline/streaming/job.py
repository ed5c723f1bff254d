"""A job from its first snapshot on: chunks, then the log, tables added later while the log is suspended, and restarts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.convert import boundary_text, boundary_value
from tideline.operators.handover import handover
from tideline.operators.snapshot import SnapshotDriver
from tideline.plans.fsm import Control, Event, Status, log_may_run, reads_snapshot, step
from tideline.sources.shared import written
from tideline.streaming.state import UpsertSink, Versions

#: Batches of the sink are numbered by epochs: snapshots of an epoch first, then what the log gave in it.
EPOCH, LOG = 10**12, 10**9


class CaptureJob:
    """Keeps a sink at the state of captured tables.

    drivers has for each table a SnapshotDriver and its chunks' bounds [(lo, hi), ...]; log gives the stream of changes
    (table, key, op, values, pos), between(table, low, high) those of a span as a batch. One control document, written
    after every chunk and phase, says what is done, so a job that is made anew goes on where it stopped: chunks that are
    read aren't read again, and the log goes on from its checkpoint.

    run() reads the chunks that are left, each with the changes made while it was read, then takes what the log has
    now, each change once, by its chunk's high watermark. add() takes tables in while the log stands still: chunks that
    stream already are forwarded to where its reader stands, the new tables' are read by the next run(), and the log goes on.
    """

    def __init__(self, spark: SparkSession, folder: str, drivers: dict[str, tuple[SnapshotDriver, list[tuple]]], log: Callable[[], DataFrame], between: Callable[[str, int, int], DataFrame], sink: UpsertSink, key: str, parallelism: int = 1):
        self.spark, self.folder, self.drivers, self.log, self.between = spark, folder, drivers, log, between
        self.sink, self.key, self.parallelism, self.versions = sink, key, parallelism, Versions(spark, f"{folder}/control")
        held = self.versions.before()
        self.number = int(held.get("number", 0))
        self.epoch = int(held.get("epoch", 0))
        self.control = Control.from_json(held["control"]) if held else Control()
        if not held:
            self._take(list(drivers))

    @property
    def status(self) -> Status:
        return Status[self.control.status]

    def _save(self) -> None:
        self.number += 1
        self.versions.write(self.number, {"control": self.control.to_json(), "number": str(self.number), "epoch": str(self.epoch)})

    def _step(self, event: Event) -> None:
        self.control.status = step(self.status, event).name
        self._save()

    def _take(self, tables: list[str]) -> None:
        self.control.tables += tables
        for t in tables:
            self.control.chunks += [{"table_id": t, "chunk_no": n, "lo": boundary_text(lo), "hi": boundary_text(hi), "low_wm": None, "high_wm": None} for n, (lo, hi) in enumerate(self.drivers[t][1])]
        self._save()

    def add(self, tables: list[str]) -> None:
        """Begins to capture more tables; their drivers are known already. Called while no run() is under way: the log is suspended then."""
        position = (self.control.offset or {}).get("pos", 0)
        for c in self.control.chunks:
            c["high_wm"] = max(c["high_wm"], position)
        self.epoch += 1
        self.control.status = step(self.status, Event.TABLES_ADDED).name
        self._take(tables)

    def _snapshot(self) -> None:
        for at, c in enumerate(self.control.chunks):
            if c["high_wm"] is not None:
                continue
            driver, lo, hi = self.drivers[c["table_id"]][0], boundary_value(c["lo"]), boundary_value(c["hi"])
            rows, marks = driver.chunk(c["chunk_no"], lo, hi, written)
            key, columns = F.col(self.key), [self.sink.table, *self.sink.options.key_columns, *self.sink.values]
            read = rows.withColumn(self.sink.table, F.lit(c["table_id"])).select(*dict.fromkeys(columns), F.lit("r").alias("op"), F.lit(marks["low_wm"]).cast("long").alias(self.sink.pos))
            inside = (F.lit(True) if lo is None else key >= F.lit(lo)) & (F.lit(True) if hi is None else key < F.lit(hi))
            meanwhile = self.between(c["table_id"], marks["low_wm"], marks["high_wm"]).where(inside).select(*read.columns)
            self.sink(read.unionByName(meanwhile), self.epoch * EPOCH + at)
            c["low_wm"], c["high_wm"] = marks["low_wm"], marks["high_wm"]
            self._save()

    def _chunks(self) -> DataFrame:
        """The finished chunks, their bounds as the key's type."""
        kind = self.log().schema[self.key].dataType.simpleString()
        rows = [(c["table_id"], None if c["lo"] is None else str(boundary_value(c["lo"])), None if c["hi"] is None else str(boundary_value(c["hi"])), c["high_wm"]) for c in self.control.chunks]
        table = self.sink.table
        return self.spark.createDataFrame(rows, f"`{table}` string, lo string, hi string, high_wm long").select(table, F.col("lo").cast(kind).alias("lo"), F.col("hi").cast(kind).alias("hi"), "high_wm")

    def run(self) -> None:
        if reads_snapshot(self.status):
            self._snapshot()
            self.control.committed = True  # the sink has written every chunk
            self._step(Event.SNAPSHOT_FINISHED)
        if self.status is Status.NEWLY_ADDED_SNAPSHOT_FINISHED:
            self._step(Event.LOG_UPDATED)
        if not log_may_run(self.status, self.parallelism, self.control.committed):
            raise RuntimeError(f"the log can't be read in {self.status.name}")
        chunks, first = self._chunks(), self.epoch * EPOCH + LOG

        def take(batch: DataFrame, batch_id: int) -> None:
            self.sink(handover(batch, chunks, self.key, self.sink.pos, self.sink.table), first + batch_id)
            stands = batch.agg(F.max(self.sink.pos)).first()[0]
            if stands is not None:
                self.control.offset = {"pos": max(stands, (self.control.offset or {}).get("pos", 0))}
                self._save()

        query = self.log().writeStream.foreachBatch(take).option("checkpointLocation", f"{self.folder}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
