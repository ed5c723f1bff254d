"""Change logs as DataFrames: envelopes, positions, kinds of records and rows, filters, metadata columns.

A log has pos (a total order), op (c, r, u or d) and the key and value columns of its table. An envelope has key,
before, after and source structs, op and ts_ms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPS = ("c", "r", "u", "d")
#: Kinds of log records that are no data: the in-band marks of snapshots, heartbeats, schema changes, transactions.
KINDS = ("data", "schema", "heartbeat", "low", "high", "end", "begin", "commit")


def with_positions(df: DataFrame, *order: str, bucket: Column) -> DataFrame:
    """Adds pos, 1, 2, 3, ... in the given order.

    bucket is a coarse, monotone function of the order (an hour, say): the rows of each bucket are counted, the counts
    added up over the few buckets, and rows numbered within theirs. No task sees more than a bucket, and equal inputs
    get equal positions however they are partitioned.
    """
    placed = df.withColumn("__bucket", bucket)
    sizes = placed.groupBy("__bucket").agg(F.count("*").alias("n"))
    starts = sizes.select("__bucket", (F.sum("n").over(Window.orderBy("__bucket")) - F.col("n")).alias("__start"))
    number = F.row_number().over(Window.partitionBy("__bucket").orderBy(*order))
    return placed.join(starts, "__bucket").withColumn("pos", F.col("__start") + number).drop("__bucket", "__start")


def envelope(log: DataFrame, key: list[str], value: list[str], source: dict[str, Column], pos: str = "pos") -> DataFrame:
    """The log with key, before, after and source structs. before is the image that the key had last, null for the first and after a delete."""
    w = Window.partitionBy(*key).orderBy(pos)
    image = F.struct(*key, *value)
    before = F.when(F.lag("op").over(w) != "d", F.lag(image).over(w))
    return log.select("*", F.struct(*key).alias("key"), before.alias("before"), F.when(F.col("op") != "d", image).alias("after"), F.struct(*(c.alias(k) for k, c in source.items())).alias("source"))


def from_json_lines(lines: DataFrame, schema, column: str = "value") -> DataFrame:
    """Envelopes of JSON texts; unknown fields are left out, and a text that can't be read is null in every field."""
    return lines.select(F.from_json(F.col(column), schema, {"mode": "PERMISSIVE"}).alias("e")).select("e.*")


def to_json_lines(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def read_rows(rows: DataFrame, pos: Column) -> DataFrame:
    """Snapshot rows as log records: op r, at a position."""
    return rows.withColumn("op", F.lit("r")).withColumn("pos", pos)


def as_read(env: DataFrame) -> DataFrame:
    """Snapshot records rebuilt of changes: op r, no before, the source's time 0; when they were read stays in ts_ms."""
    return env.where("after IS NOT NULL").withColumn("op", F.lit("r")).withColumn("before", F.lit(None).cast(env.schema["before"].dataType)).withColumn("source", F.col("source").withField("ts_ms", F.lit(0).cast("long")))


# --- filters ---


def table_filter(include: str | None, exclude: str | None = None, system: tuple[str, ...] = ("mysql", "sys", "information_schema", "performance_schema"), column: str = "table_id") -> Column:
    """Tables `db.table` that a comma list of patterns matches whole; those of system databases never."""

    def matches(patterns: str) -> Column:
        return F.col(column).rlike("(?i)^(?:" + "|".join(p.strip() for p in patterns.split(",")) + ")$")

    keep = ~F.lower(F.substring_index(column, ".", 1)).isin(*system)
    keep = keep & matches(include) if include else keep
    return keep & ~matches(exclude) if exclude else keep


def skip_operations(skipped: str, column: str = "op") -> Column:
    """All but the given operations, a comma list of c, u, d or create, update, delete, truncate."""
    short = [s.strip()[:1] for s in skipped.split(",") if s.strip()]
    return ~F.col(column).isin(*short) if short else F.lit(True)


def record_kind(record: DataFrame) -> Column:
    """The kind of a raw log record by what it holds: a watermark, a heartbeat, a schema change, a transaction mark, else data."""
    has = {f.name for f in record.schema.fields}

    def there(c: str) -> Column:
        return F.col(c).isNotNull() if c in has else F.lit(False)

    return F.when(there("watermark"), F.col("watermark") if "watermark" in has else None).when(there("heartbeat"), F.lit("heartbeat")).when(there("ddl"), F.lit("schema")).when(there("txn"), F.col("txn") if "txn" in has else None).otherwise(F.lit("data"))


def schema_changes(record: DataFrame, included: Column) -> DataFrame:
    """Schema changes that name an included table."""
    return record.where(F.col("ddl").isNotNull() & included)


#: Statements that a log holds as text without being schema changes.
NOT_DDL = r"(?is)^\s*(begin|commit|rollback|savepoint|xa\b|insert|update|delete|replace|/\*|#|flush|grant|revoke|set\b)"


def is_ddl(statement: Column) -> Column:
    return F.length(F.trim(statement)).cast("boolean") & ~statement.rlike(NOT_DDL)


def after_restart(pos: Column, event: Column, row: Column, start: tuple[int, int, int]) -> Column:
    """What is left after a restart within a transaction: events after the skipped ones, and of the next its rows after those skipped.

    event counts a transaction's events from 1 and row an event's rows from 0; the start has as many to skip."""
    p, e, r = start
    return (pos > p) | ((pos == p) & ((event > e + 1) | ((event == e + 1) & (row >= r))))


def from_sources(uuid: Column, include: list[str] | None = None, exclude: list[str] | None = None) -> Column:
    """Changes whose transaction comes of a wanted server; changes without a transaction id pass."""
    keep = F.lit(True)
    if include:
        keep = uuid.rlike("(?i)^(?:" + "|".join(include) + ")$")
    elif exclude:
        keep = ~uuid.rlike("(?i)^(?:" + "|".join(exclude) + ")$")
    return uuid.isNull() | keep


def from_timestamp(ts: Column, kind: Column, millis: int) -> Column:
    """Data changes from a time on, in whole seconds; all other records pass."""
    return (kind != "data") | (F.unix_micros(ts.cast("timestamp")) >= millis // 1000 * 1_000_000)


def latch_from(log: DataFrame, ts: Column, since, pos: str = "pos") -> DataFrame:
    """Everything from the first record at or after a time, later records with earlier times too."""
    first = log.where(ts >= since).agg(F.min(pos).alias("__first"))
    return log.join(F.broadcast(first), F.col(pos) >= F.col("__first")).drop("__first")


# --- rows of a changelog ---


def row_kinds(env: DataFrame) -> DataFrame:
    """(row_kind, row) with the other columns: c and r insert, d deletes, u takes back the old row and gives the new."""
    insert, delete = F.struct(F.lit("+I").alias("row_kind"), F.col("after").alias("row")), F.struct(F.lit("-D").alias("row_kind"), F.col("before").alias("row"))
    update = F.array(F.struct(F.lit("-U").alias("row_kind"), F.col("before").alias("row")), F.struct(F.lit("+U").alias("row_kind"), F.col("after").alias("row")))
    rows = F.when(F.col("op").isin("c", "r"), F.array(insert)).when(F.col("op") == "d", F.array(delete)).when(F.col("op") == "u", update)
    return env.select("*", F.inline(rows))


def metadata(env: DataFrame) -> DataFrame:
    """Adds table_name, database_name, op_ts (the epoch for snapshot rows) and row_kind of the record's new side. For a stream's event time see event_time()."""
    kind = F.when(F.col("op") == "d", "-D").when(F.col("op") == "u", "+U").otherwise("+I")
    at = F.timestamp_millis(F.when(F.col("op") == "r", F.lit(0)).otherwise(F.col("source.ts_ms")))
    return env.select("*", F.col("source.table").alias("table_name"), F.col("source.db").alias("database_name"), at.alias("op_ts"), kind.alias("row_kind"))


def event_time(env: DataFrame) -> Column:
    """The time to put a watermark on: that of the source, null where it has none (0 or less), as for snapshot rows."""
    at = F.when(F.col("op") != "r", F.col("source.ts_ms"))
    return F.when(at > 0, F.timestamp_millis(at))


def transactions(log: DataFrame, txn: str = "gtid", pos: str = "pos", table: str = "table_id") -> DataFrame:
    """(txn, first, last, events, tables): what the begin and end of each transaction say, and the events of each of its tables."""
    each = log.where(F.col(txn).isNotNull()).groupBy(txn, table).agg(F.min(pos).alias("first"), F.max(pos).alias("last"), F.count("*").alias("n"))
    counts = F.array_sort(F.collect_list(F.struct(F.col(table).alias("table_id"), F.col("n").alias("events"))))
    return each.groupBy(F.col(txn).alias("txn")).agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("events"), counts.alias("tables"))
