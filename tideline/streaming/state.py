"""Streams to tables: an upserting sink of current state, a sink of two-phase commits, lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.operators.twophase import KEY, TYPES, committed, resolved_over, unmatched
from tideline.options import OptionError, PipelineOptions, SinkOptions


class Versions:
    """Names of folders, kept as small text files by batch: the newest one counts, and a batch that comes again replaces its own."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _at(self, name: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def exists(self, name: str = "") -> bool:
        fs, where = self._at(name)
        return fs.exists(where)

    def before(self, batch_id: int | None = None) -> dict[str, str]:
        """What the newest version names; with batch_id, the newest that is older than the batch."""
        fs, where = self._at("_versions")
        names = [int(s.getPath().getName()) for s in fs.listStatus(where)] if fs.exists(where) else []
        names = [n for n in names if batch_id is None or n < batch_id]
        if not names:
            return {}
        rows = self.spark.read.schema("value string").text(f"{self.path}/_versions/{max(names)}").collect()
        return dict(r.value.split("\t", 1) for r in rows)

    def write(self, batch_id: int, named: dict[str, str]) -> None:
        rows = self.spark.createDataFrame([(f"{k}\t{v}",) for k, v in named.items()], "value string")
        rows.coalesce(1).write.mode("overwrite").text(f"{self.path}/_versions/{batch_id}")


class UpsertSink:
    """A foreachBatch writer of current state as Parquet.

    State holds each key's last record by position, deletes too: records may come in any order, over batches as well,
    and one from earlier in the log never brings a deleted key back. read() leaves deleted keys out. With low, a
    function that tells up to which position nothing will come any more, deletes up to there are forgotten.

    State is partitioned by a hash of its key into sink.parallelism buckets; only buckets with changes are written
    anew. A version names each bucket's folder and is written last, so a batch is whole or not there, and a batch that
    comes again starts from the version before it: state is exactly once however often batches are repeated.

    Options: without sink.operator.delete.allowed deletes are ignored; so are those of tables (column `table`) in
    sink.operator.delete.excluded-tables; without sink.create.schema.allowed the folder must be there already.
    """

    def __init__(self, options: SinkOptions, value_columns: list[str], pos: str = "pos", table: str = "table_id", low=None):
        self.options, self.values, self.pos, self.table, self.low = options, value_columns, pos, table, low

    def _wanted(self, batch: DataFrame) -> DataFrame:
        if not self.options.delete_allowed:
            return batch.where("op <> 'd'")
        if self.options.excluded_tables:
            return batch.where((F.col("op") != "d") | ~F.col(self.table).isin(self.options.excluded_tables))
        return batch

    def read(self, spark: SparkSession) -> DataFrame | None:
        folders = [v for k, v in Versions(spark, self.options.path).before().items() if k != "buckets"]
        return spark.read.parquet(*sorted(folders)).where("__op <> 'd'").drop("__op", "__pos", "__bucket") if folders else None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, keys, n = batch.sparkSession, self.options.key_columns, self.options.parallelism
        versions = Versions(spark, self.options.path)
        if not self.options.create_schema and not versions.exists():
            raise OptionError(f"{self.options.path} isn't there and sink.create.schema.allowed is false")
        before = versions.before(batch_id)
        if int(before.get("buckets", n)) != n:
            raise OptionError(f"the state was written in {before['buckets']} buckets, sink.parallelism is {n}")
        record = F.struct(*self.values, F.col("op").alias("__op"), F.col(self.pos).alias("__pos"))
        rows = self._wanted(batch).groupBy(*keys).agg(F.max_by(record, self.pos).alias("r")).select(*keys, "r.*")
        changes = rows.withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")).persist()
        try:
            touched = [str(r[0]) for r in changes.select("__bucket").distinct().collect()]
            if not touched:
                return
            old = [before[b] for b in touched if b in before]
            state = spark.read.parquet(*old).unionByName(changes) if old else changes
            merged = state.groupBy("__bucket", *keys).agg(F.max_by(F.struct(*self.values, "__op", "__pos"), "__pos").alias("r")).select("__bucket", *keys, "r.*")
            if self.low is not None:
                merged = merged.where((F.col("__op") != "d") | (F.col("__pos") > self.low()))
            folder = f"{self.options.path}/batch={batch_id}"
            merged.withColumn("__part", F.col("__bucket")).write.mode("overwrite").partitionBy("__part").parquet(folder)
            named = {b: f"{folder}/__part={b}" for b in touched if versions.exists(f"batch={batch_id}/__part={b}")}
            versions.write(batch_id, {k: v for k, v in before.items() if k not in touched} | named | {"buckets": str(n)})
        finally:
            changes.unpersist()


def upsert_stream(log: DataFrame, sink: UpsertSink, checkpoint: str, pipeline: PipelineOptions | None = None, **trigger) -> StreamingQuery:
    """Runs a stream into a sink: by trigger, else by the pipeline's checkpoint interval, else what is there now. sink.options.trigger is that of the flush interval."""
    writer = log.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if pipeline is None:
        return writer.trigger(**(trigger or {"availableNow": True})).start()
    conf, name = log.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(name)
    conf.set(name, str(pipeline.parallelism))  # a query keeps what was set when it began
    try:
        return writer.queryName(pipeline.name).trigger(**(trigger or {"processingTime": f"{pipeline.checkpoint_interval:g} seconds"})).start()
    finally:
        conf.set(name, before)


class CommitSink:
    """A foreachBatch writer of the committed rows of a two-phase feed, as Parquet, once each.

    A batch has (region, table_id, handle, start_ts, log_type, commit_ts, values, resolved_ts), where rows of log_type
    RESOLVED say that a region is complete up to resolved_ts. It is put beside what earlier batches left open, whatever
    its key: each region's largest resolved time is remembered, the smallest of them is the feed's, and every row that
    is committed up to it is appended. A region that hasn't told a resolved time holds all back.

    What stays open: prewrites without a commit, commits beyond the resolved time with their prewrites, rollbacks until
    the resolved time is past their start. Commits at or below the resolved time of earlier batches are redelivered, and
    commits without a prewrite up to the resolved time are unmatched: they give no rows, and unmatched ones are kept
    under unmatched/. Open records, rows and times are folders of the batch, named last, so batches can be repeated.
    """

    def __init__(self, path: str, values: list[str]):
        self.path, self.values = path, values
        self.columns = [*KEY, "log_type", "commit_ts", *values]

    def _table(self, spark: SparkSession, name: str, versions: Versions) -> DataFrame | None:
        named = versions.before()
        folders = [f"{self.path}/{x}/{name}" for x in named.get("batches", "").split(",") if x]
        return spark.read.parquet(*folders) if folders else None

    def read(self, spark: SparkSession) -> DataFrame | None:
        """All committed rows so far: KEY, commit_ts and the values."""
        return self._table(spark, "rows", Versions(spark, self.path))

    def unmatched(self, spark: SparkSession) -> DataFrame | None:
        return self._table(spark, "unmatched", Versions(spark, self.path))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        versions = Versions(spark, self.path)
        before, folder = versions.before(batch_id), f"{self.path}/{batch_id}"
        done = int(before.get("resolved", -1))
        batch.groupBy("region").agg(F.max("resolved_ts").alias("resolved_ts")).write.mode("overwrite").parquet(f"{folder}/seen")
        seen = spark.read.parquet(f"{folder}/seen")
        if "open" in before:
            seen = seen.unionByName(spark.read.parquet(f"{before['open']}/regions"))
        regions = seen.groupBy("region").agg(F.max("resolved_ts").alias("resolved_ts"))
        regions.write.mode("overwrite").parquet(f"{folder}/regions")
        least = resolved_over(spark.read.parquet(f"{folder}/regions").withColumn("resolved_ts", F.coalesce("resolved_ts", F.lit(-1)))).first()[0]
        resolved = max(done, -1 if least is None else least)
        fresh = batch.where(F.col("log_type").isin(*TYPES)).select(*self.columns).where(F.col("commit_ts").isNull() | (F.col("commit_ts") > done))
        every = fresh.unionByName(spark.read.parquet(f"{before['open']}/open")) if "open" in before else fresh
        every.write.mode("overwrite").parquet(f"{folder}/every")
        every = spark.read.parquet(f"{folder}/every")
        committed(every, resolved).write.mode("overwrite").parquet(f"{folder}/rows")
        rows = spark.read.parquet(f"{folder}/rows")
        unmatched(every).where(F.col("commit_ts") <= resolved).write.mode("overwrite").parquet(f"{folder}/unmatched")
        undone = every.where("log_type = 'ROLLBACK'").select(*KEY).distinct()
        past = (F.col("commit_ts") <= resolved) | ((F.col("log_type") == "ROLLBACK") & (F.col("start_ts") <= resolved))
        left = every.where(~F.coalesce(past, F.lit(False)))
        left = left.join(rows.select(*KEY).distinct(), KEY, "left_anti")
        left.where("log_type = 'ROLLBACK'").unionByName(left.where("log_type <> 'ROLLBACK'").join(undone, KEY, "left_anti")).write.mode("overwrite").parquet(f"{folder}/open")
        versions.write(batch_id, {"resolved": str(resolved), "open": folder, "batches": ",".join([*filter(None, before.get("batches", "").split(",")), str(batch_id)])})


def two_phase_stream(feed: DataFrame, sink: CommitSink, checkpoint: str, **trigger) -> StreamingQuery:
    """Runs a feed, as the kvfeed source gives it, into a sink of committed rows."""
    return feed.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def lag_metrics(df: DataFrame, fetched: Column, source: Column, name: str = "lag") -> DataFrame:
    """Observes fetch lag (largest and mean milliseconds) and rows of a stream or batch; StreamingQueryProgress has them."""
    behind = F.greatest(fetched - source, F.lit(0))
    return df.observe(name, F.max(behind).alias("max_ms"), F.avg(behind).alias("mean_ms"), F.count(F.lit(1)).alias("rows"))
