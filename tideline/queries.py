"""The engine's own queries over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import convert as V
from tideline.operators import changelog as L
from tideline.operators import extend as X
from tideline.operators import handover as H
from tideline.operators import merge as M
from tideline.operators import mvcc as B
from tideline.operators import snapshot as S
from tideline.operators import twophase as P
from tideline.plans import chunks as K
from tideline.plans import offsets as O
from tideline.sources import catalog as C
from tideline.sources import jsonlog as J
from tideline.sources.shared import new_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- the log that the queries read: events as changes of users ---

LOG_SQL = """log AS (
  SELECT row_number() OVER (ORDER BY ts, event_id) AS pos, user_id AS pk, event_id, event_type, ts, value,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op
  FROM events)"""
#: The last state by the log alone.
STATE_SQL = f"""WITH {LOG_SQL}
SELECT pk, event_id, value, pos FROM (SELECT *, row_number() OVER (PARTITION BY pk ORDER BY pos DESC) AS rn FROM log) WHERE rn = 1 AND op <> 'd'"""
STATE = ["pk", "event_id", "value", "pos"]


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    placed = L.with_positions(table(spark, sf_dir, "events"), "ts", "event_id", bucket=F.date_trunc("hour", "ts"))
    return placed.select(F.col("pos").cast("long").alias("pos"), F.col("user_id").alias("pk"), "event_id", "event_type", "ts", "value", op.alias("op"))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = {
        "db": F.lit("demo"), "table": F.lit("users"), "ts_ms": F.unix_millis(F.col("ts").cast("timestamp")), "file": F.concat(F.lit("log."), F.date_format("ts", "yyyyMMdd")),
        "pos": F.col("pos"), "event": F.lit(1), "row": F.lit(0), "server_id": F.lit(1),
    }
    return L.envelope(change_log(spark, sf_dir), ["pk"], ["event_id", "value"], source)


#: Three chunks of users, read at different times.
CHUNKS = [(0, None, 50, 1500, 3000), (1, 50, 100, 900, 2000), (2, 100, None, 4000, 5000)]
CHUNKS_SQL = "chunks(chunk_no, lo, hi, low_wm, high_wm) AS (VALUES (0, NULL, 50, 1500, 3000), (1, 50, 100, 900, 2000), (2, 100, NULL, 4000, 5000))"
IN_CHUNK_SQL = "(lo IS NULL OR pk >= lo) AND (hi IS NULL OR pk < hi)"


def user_chunks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CHUNKS, "chunk_no long, lo long, hi long, low_wm long, high_wm long")


# --- merge ---


@query(STATE_SQL)
def merge_latest_state(spark, sf_dir):
    return M.latest_state(change_log(spark, sf_dir), ["pk"]).select(*STATE)


@query(f"WITH {LOG_SQL} SELECT pk, arg_max(event_id, pos) AS event_id, arg_max(value, pos) AS value, max(pos) AS pos FROM log GROUP BY pk HAVING arg_max(op, pos) <> 'd'")
def merge_max_by(spark, sf_dir):
    return M.latest_values(change_log(spark, sf_dir), ["pk"], ["event_id", "value", "pos"]).select(*STATE)


@query("""
WITH w AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, 1 AS w FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag, -1 FROM lineitem WHERE l_partkey % 3 = 0
  UNION ALL SELECT l_orderkey, l_linenumber, 'X', 1 FROM lineitem WHERE l_partkey % 6 = 0)
SELECT l_orderkey, l_linenumber, l_returnflag, count(*) AS copies
FROM (SELECT l_orderkey, l_linenumber, l_returnflag, unnest(range(sum(w)::BIGINT)) FROM w GROUP BY 1, 2, 3 HAVING sum(w) > 0) GROUP BY 1, 2, 3""")
def merge_no_pk_multiset(spark, sf_dir):
    """lineitem has no key: every row read once, then a third deleted, half of them being updates."""
    row = F.struct("l_orderkey", "l_linenumber", "l_returnflag")
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", row.alias("row"))
    none = F.lit(None).cast(rows.schema["row"].dataType)
    read = rows.select(F.lit("r").alias("op"), none.alias("before"), F.col("row").alias("after"))
    update = F.col("l_partkey") % 6 == 0
    after = F.when(update, F.col("row").withField("l_returnflag", F.lit("X")))
    changes = rows.where("l_partkey % 3 = 0").select(F.when(update, "u").otherwise("d").alias("op"), F.col("row").alias("before"), after.alias("after"))
    columns = ["l_orderkey", "l_linenumber", "l_returnflag"]
    return M.multiset_state(read.union(changes), columns).groupBy(*columns).agg(F.count("*").alias("copies"))


@query(f"""WITH {LOG_SQL}, e AS (SELECT *, lag(event_id) OVER (PARTITION BY pk ORDER BY pos) AS old, lag(op) OVER (PARTITION BY pk ORDER BY pos) AS old_op FROM log)
SELECT count(*) AS moved FROM e WHERE op = 'u' AND old_op <> 'd' AND old < 5000 AND event_id >= 5000""")
def update_out_of_range_count(spark, sf_dir):
    before, after = F.col("before.event_id") < 5000, F.col("after.event_id") < 5000
    return M.moved_out(envelopes(spark, sf_dir), before, after).agg(F.count("*").alias("moved"))


# --- chunks ---


def _key_stats(spark, sf_dir, name, key) -> K.KeyStats:
    return K.KeyStats(*K.key_stats(table(spark, sf_dir, name), key).first())


def _factor_sql(name: str, key: str) -> str:
    return f"SELECT '{name}' AS table_name, min({key}) AS low, max({key}) AS high, count(*) AS n, ceil((max({key}) - min({key}) + 1)::DECIMAL(38, 10) * 10000 / count(*))::BIGINT AS factor_e4 FROM {name}"


@query(" UNION ALL ".join(_factor_sql(*x) for x in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("customer", "c_custkey"))))
def chunk_stats(spark, sf_dir):
    parts = []
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("customer", "c_custkey")):
        d = "decimal(38,0)"
        factor = F.ceil((F.col("high") - F.col("low") + 1).cast(d) * F.lit(10000).cast("decimal(10,0)") / F.col("n").cast("decimal(20,0)")).cast("long")
        parts.append(K.key_stats(table(spark, sf_dir, name), key).select(F.lit(name).alias("table_name"), "low", "high", "n", factor.alias("factor_e4")))
    return parts[0].union(parts[1]).union(parts[2])


def _even(spark, sf_dir, name, key):
    stats = _key_stats(spark, sf_dir, name, key)
    kind = table(spark, sf_dir, name).schema[key].dataType
    return K.even_chunks(spark, stats, K.even_step(stats, isinstance(kind, K.EVEN_TYPES)), kind)


def _even_sql(name: str, key: str) -> str:
    return f"""
WITH s AS (SELECT min({key}) AS low, max({key}) AS high, count(*) AS n FROM {name}),
f AS (SELECT *, greatest(ceil((high - low + 1) * 10000 / n)::BIGINT * 8096 // 10000, 1) AS step FROM s),
b AS (SELECT unnest(generate_series(1, CASE WHEN n <= 8096 THEN 0 ELSE (high - low) // step END)) AS i, low, step FROM f),
c AS (SELECT i, low + i * step AS lo FROM b UNION ALL SELECT 0, NULL)
SELECT i::BIGINT AS chunk_no, lo::BIGINT AS lo, lead(lo) OVER (ORDER BY i)::BIGINT AS hi FROM c"""


@query(_even_sql("orders", "o_orderkey"))
def chunk_even_orders(spark, sf_dir):
    return _even(spark, sf_dir, "orders", "o_orderkey")


@query(_even_sql("lineitem", "l_orderkey"))
def chunk_even_lineitem(spark, sf_dir):
    return _even(spark, sf_dir, "lineitem", "l_orderkey")


@query("SELECT 0::BIGINT AS chunk_no, NULL::INTEGER AS lo, NULL::INTEGER AS hi")
def chunk_trivial_region(spark, sf_dir):
    return _even(spark, sf_dir, "region", "r_regionkey")


@query("""
WITH k AS (SELECT c_name AS k, row_number() OVER (ORDER BY c_name) - 1 AS rank, count(*) OVER () AS total FROM customer),
c AS (SELECT rank // 99 AS i, k AS lo FROM k WHERE rank > 0 AND rank % 99 = 0 AND rank < total - 1 UNION ALL SELECT 0, NULL)
SELECT i::BIGINT AS chunk_no, lo, lead(lo) OVER (ORDER BY i) AS hi FROM c""")
def chunk_uneven_customer_name(spark, sf_dir):
    return K.uneven_chunks(table(spark, sf_dir, "customer"), "c_name", 100)


@query("SELECT max(k) AS next_max FROM (SELECT l_orderkey AS k FROM lineitem WHERE l_orderkey >= 100 ORDER BY 1 LIMIT 500)")
def next_chunk_max(spark, sf_dir):
    return K.next_boundary(table(spark, sf_dir, "lineitem"), "l_orderkey", 100, 500)


@query("SELECT min(l_orderkey) AS next_min FROM lineitem WHERE l_orderkey > 1000")
def min_above(spark, sf_dir):
    return K.min_above(table(spark, sf_dir, "lineitem"), "l_orderkey", 1000)


@query(f"WITH c AS ({_even_sql('lineitem', 'l_orderkey')}) SELECT chunk_no, count(*) AS n FROM lineitem JOIN c ON (lo IS NULL OR l_orderkey >= lo) AND (hi IS NULL OR l_orderkey < hi) GROUP BY chunk_no")
def chunk_coverage(spark, sf_dir):
    rows = S.scan_chunks(table(spark, sf_dir, "lineitem").select("l_orderkey"), chunk_even_lineitem(spark, sf_dir), "l_orderkey")
    return rows.groupBy("chunk_no").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n FROM orders WHERE o_orderkey >= 500 AND o_orderkey < 900")
def chunk_scan(spark, sf_dir):
    return S.chunk_rows(table(spark, sf_dir, "orders"), "o_orderkey", 500, 900).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n FROM orders WHERE o_orderkey BETWEEN 100 AND 7000")
def count_between(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(F.col("o_orderkey").between(100, 7000)).agg(F.count("*").alias("n"))


@query("""SELECT i::BIGINT AS chunk_no, (-9223372036854775808::HUGEINT + i * (18446744073709551616::HUGEINT // 7))::DECIMAL(20, 0) AS lo,
CASE WHEN i = 6 THEN 9223372036854775808::HUGEINT ELSE -9223372036854775808::HUGEINT + (i + 1) * (18446744073709551616::HUGEINT // 7) END::DECIMAL(20, 0) AS hi FROM range(7) t(i)""")
def tso_key_ranges(spark, sf_dir):
    return K.handle_ranges(spark, 7)


# --- hand-over ---


@query(f"WITH {LOG_SQL}, {CHUNKS_SQL} SELECT pos, pk, op, event_id FROM log WHERE EXISTS (SELECT 1 FROM chunks WHERE {IN_CHUNK_SQL} AND pos > high_wm)")
def handover_filter(spark, sf_dir):
    return H.handover(change_log(spark, sf_dir), user_chunks(spark), "pk").select("pos", "pk", "op", "event_id")


@query(f"WITH {LOG_SQL}, {CHUNKS_SQL} SELECT pos, pk, high_wm::BIGINT AS high_wm FROM log JOIN chunks ON {IN_CHUNK_SQL}")
def chunk_lookup(spark, sf_dir):
    """The chunk of each change, by binary search."""
    return H.chunk_of(change_log(spark, sf_dir), user_chunks(spark), "pk", name="high_wm").select("pos", "pk", "high_wm")


@query(f"""WITH {LOG_SQL}, b(table_id, max_wm) AS (VALUES ('demo.click', 3000), ('demo.view', 7000))
SELECT pos, 'demo.' || event_type AS table_id FROM log JOIN b ON table_id = 'demo.' || event_type WHERE pos > max_wm""")
def pure_phase_filter(spark, sf_dir):
    log = change_log(spark, sf_dir).withColumn("table_id", F.concat(F.lit("demo."), "event_type"))
    chunks = spark.createDataFrame([("demo.click", 1000), ("demo.click", 3000), ("demo.view", 7000)], "table_id string, high_wm long")
    return H.pure_phase(log, chunks).select("pos", "table_id")


@query(STATE_SQL)
def backfill_then_stream_state(spark, sf_dir):
    """Chunks read at their own times, changes merged in, then the log from each chunk's watermark: the state of the log alone."""
    log, chunks = change_log(spark, sf_dir), user_chunks(spark)
    snapshot = S.backfilled(log, ["pk"], chunks, "pk")
    return M.latest_state(snapshot.unionByName(H.handover(log, chunks, "pk")), ["pk"]).select(*STATE)


@query(STATE_SQL)
def skip_backfill_state(spark, sf_dir):
    """Without merging: changes since the low watermark come again, and the merge by key takes them."""
    log = change_log(spark, sf_dir)
    chunks = user_chunks(spark).withColumn("high_wm", F.col("low_wm"))
    snapshot = S.backfilled(log, ["pk"], chunks, "pk", skip=True)
    return M.latest_state(snapshot.unionByName(H.handover(log, chunks, "pk")), ["pk"]).select(*STATE)


# --- two-phase commits ---

FEED_SQL = """feed AS (
  SELECT 'PREWRITE' AS log_type, user_id AS table_id, event_id AS handle, event_id AS start_ts, NULL::BIGINT AS commit_ts, value FROM events WHERE event_type IN ('view', 'click')
  UNION ALL SELECT 'COMMIT', user_id, event_id, event_id, event_id + 3, NULL FROM events WHERE event_type IN ('view', 'purchase')
  UNION ALL SELECT 'ROLLBACK', user_id, event_id, event_id, NULL, NULL FROM events WHERE event_id % 7 = 0)"""


def feed(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")

    def part(kind, rows, commit, value):
        return rows.select(F.lit(kind).alias("log_type"), F.col("user_id").alias("table_id"), F.col("event_id").alias("handle"), F.col("event_id").alias("start_ts"), commit.cast("long").alias("commit_ts"), value.cast("double").alias("value"))

    none = F.lit(None)
    pre = part("PREWRITE", e.where("event_type IN ('view', 'click')"), none, F.col("value"))
    commit = part("COMMIT", e.where("event_type IN ('view', 'purchase')"), F.col("event_id") + 3, none)
    return pre.union(commit).union(part("ROLLBACK", e.where("event_id % 7 = 0"), none, none))


@query(f"""WITH {FEED_SQL}
SELECT p.table_id, p.handle, c.commit_ts, p.value FROM feed p JOIN feed c USING (table_id, handle, start_ts)
WHERE p.log_type = 'PREWRITE' AND c.log_type = 'COMMIT' AND c.commit_ts <= 5000
  AND NOT EXISTS (SELECT 1 FROM feed r WHERE r.log_type = 'ROLLBACK' AND r.table_id = p.table_id AND r.handle = p.handle AND r.start_ts = p.start_ts)""")
def two_phase_commit(spark, sf_dir):
    return P.committed(feed(spark, sf_dir), 5000).select("table_id", "handle", "commit_ts", "value")


@query("SELECT event_id AS handle, event_id + 3 AS commit_ts FROM events WHERE event_type = 'purchase'")
def two_phase_unmatched(spark, sf_dir):
    return P.unmatched(feed(spark, sf_dir)).select("handle", "commit_ts")


@query("SELECT min(r) AS resolved FROM (SELECT user_id % 4 AS region, max(event_id) AS r FROM events GROUP BY 1)")
def resolved_over_regions(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return P.resolved_over(e.select((F.col("user_id") % 4).alias("region"), F.col("event_id").alias("resolved_ts")))


@query("""
WITH v AS (
  SELECT event_id % 700 AS key, event_id AS commit_ts, CASE event_type WHEN 'error' THEN 'delete' ELSE 'put' END AS op, event_type AS value FROM events
  UNION ALL SELECT event_id % 700, event_id * 2 + 1, 'put', 'locked' FROM events WHERE event_id % 11 = 0 AND event_id % 3 <> 0 AND event_id <= 6000 AND event_id * 2 + 1 <= 6000)
SELECT key, arg_max(value, commit_ts) AS value FROM v WHERE commit_ts <= 6000 GROUP BY key HAVING arg_max(op, commit_ts) = 'put'""")
def mvcc_snapshot(spark, sf_dir):
    """Users' last writes at a version, with the writes behind locks that were committed by then."""
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    versions = e.select((i % 700).alias("key"), i.alias("commit_ts"), F.when(F.col("event_type") == "error", "delete").otherwise("put").alias("op"), F.col("event_type").alias("value"))
    locks = e.where("event_id % 11 = 0").select((i % 700).alias("key"), i.alias("start_ts"), i.alias("primary"), F.lit("put").alias("op"), F.lit("locked").alias("value"))
    commits = e.where("event_id % 11 = 0").select(i.alias("primary"), i.alias("start_ts"), F.when(i % 3 != 0, i * 2 + 1).alias("commit_ts"))
    return B.at_version(B.resolve_locks(versions, locks, commits, 6000), 6000)


@query(f"WITH {LOG_SQL} SELECT event_type AS table_id, count(*) AS n FROM log WHERE event_type IN ('view', 'click') GROUP BY 1")
def unknown_tables_skipped(spark, sf_dir):
    known = spark.createDataFrame([("view",), ("click",)], "table_id string")
    log = change_log(spark, sf_dir).withColumn("table_id", F.col("event_type"))
    return X.of_known_tables(log, known, "skip").groupBy("table_id").agg(F.count("*").alias("n"))


@query("SELECT event_id, 'k' AS name, CAST(json_extract(props, '$.k') AS BIGINT) AS n FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_id, 'id', event_id FROM events WHERE event_id % 4 = 0")
def custom_deserializer(spark, sf_dir):
    """A user's function that makes none, one or two rows of a record."""
    import json

    def rows(r):
        if r["event_id"] % 2 == 0:
            yield {"event_id": r["event_id"], "name": "k", "n": json.loads(r["props"])["k"]}
        if r["event_id"] % 4 == 0:
            yield {"event_id": r["event_id"], "name": "id", "n": r["event_id"]}

    return X.deserialize(table(spark, sf_dir, "events").select("event_id", "props"), rows, "event_id long, name string, n long")


# --- the log as files, read by the source ---


def _publish(lines: DataFrame, folder: str, name: str) -> None:
    """Lines as JSON-lines files, which get the names of a log's next files once they are whole."""
    spark, draft = lines.sparkSession, f"{folder}-{name}"
    lines.write.text(draft)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    files = sorted(f.getPath().toString() for f in fs.listStatus(path(draft)) if f.getPath().getName().startswith("part-"))
    for k, file in enumerate(files):
        fs.rename(path(file), path(f"{folder}/{name}.{k:06d}.jsonl"))
    fs.delete(path(draft), True)


def _lines(log: DataFrame) -> DataFrame:
    """The change log as envelopes in JSON."""
    image = F.struct("pk", "event_id", "value", F.col("pos").alias("number"))
    source = F.struct(F.lit("demo").alias("db"), F.lit("users").alias("table"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), F.concat(F.lit("server:"), F.floor((F.col("pos") + 1) / 2)).alias("gtid"), (F.pmod(F.col("pos") - 1, F.lit(2)) + 1).alias("event"))
    return log.select("pos", F.to_json(F.struct("op", F.struct("pk").alias("key"), F.when(F.col("op") != "d", image).alias("after"), F.when(F.col("op") == "d", image).alias("before"), source.alias("source"))).alias("value"))


def write_log(spark, sf_dir, files: int = 3) -> str:
    """The change log as JSON lines in files one after another; the folder."""
    folder = f"{new_folder(spark)}/log"
    _publish(_lines(change_log(spark, sf_dir)).repartitionByRange(files, "pos").sortWithinPartitions("pos").select("value"), folder, "log")
    return folder


def read_log(spark, folder, **options) -> DataFrame:
    J.register(spark)
    return parsed(spark.read.format("jsonlog").options(**options).load(folder))


def parsed(rows: DataFrame) -> DataFrame:
    """(file, at, op, ts_ms, gtid, pk, event_id, value, number) of what the source gives: at is the position in the file, number the record's in the log."""
    image = F.from_json(F.coalesce("after", "before"), "pk long, event_id long, value double, number long")
    return rows.where("kind = 'data'").select("file", F.col("pos").alias("at"), "op", "ts_ms", "gtid", image.alias("i")).select("file", "at", "op", "ts_ms", "gtid", "i.*")


def _place(spark, folder, event_id) -> tuple[str, int]:
    """Where in the files the record of an event ends."""
    r = read_log(spark, folder).where(F.col("event_id") == event_id).select("file", "at").first()
    return r.file, r["at"]


def _event_at(spark, sf_dir, pos: int) -> int:
    return change_log(spark, sf_dir).where(F.col("pos") == pos).first().event_id


def _specific(place, **more) -> dict:
    return {"scan.startup.mode": "specific-offset", "scan.startup.specific-offset.file": place[0], "scan.startup.specific-offset.pos": str(place[1])} | {f"scan.startup.specific-offset.{k.replace('_', '-')}": str(v) for k, v in more.items()}


@query(f"WITH {LOG_SQL} SELECT pk, event_id, op FROM log WHERE pos > 400 AND pos <= 700")
def bounded_log_read(spark, sf_dir):
    """What a backfill reads, by the source: behind the low position up to the high one."""
    folder = write_log(spark, sf_dir)
    low, high = (_place(spark, folder, _event_at(spark, sf_dir, p)) for p in (400, 700))
    return read_log(spark, folder, **_specific(low), **{"end-file": high[0], "end-pos": str(high[1])}).select("pk", "event_id", "op")


@query(f"WITH {LOG_SQL} SELECT pk, event_id, op FROM log")
def startup_earliest(spark, sf_dir):
    return read_log(spark, write_log(spark, sf_dir)).select("pk", "event_id", "op")


@query(f"WITH {LOG_SQL} SELECT count(*) - count(*) AS n FROM log")
def startup_latest(spark, sf_dir):
    return read_log(spark, write_log(spark, sf_dir), **{"scan.startup.mode": "latest-offset"}).agg(F.count("*").alias("n"))


@query(f"WITH {LOG_SQL} SELECT pk, event_id, op FROM log WHERE pos > 504")
def startup_specific(spark, sf_dir):
    """From behind record 500 on, less two transactions of two events: of the first, which goes on there, two events, and then what is known by id."""
    folder = write_log(spark, sf_dir)
    place = _place(spark, folder, _event_at(spark, sf_dir, 500))
    rows = read_log(spark, folder, **_specific(place, skip_events=2))
    return rows.where("gtid <> 'server:252'").select("pk", "event_id", "op")


@query(f"WITH {LOG_SQL} SELECT pk, event_id, op FROM log WHERE pos > 600")
def startup_gtids(spark, sf_dir):
    return read_log(spark, write_log(spark, sf_dir), **{"scan.startup.mode": "specific-offset", "scan.startup.specific-offset.gtid-set": "server:1-300"}).select("pk", "event_id", "op")


@query(f"WITH {LOG_SQL}, t AS (SELECT floor(epoch(ts)) AS s FROM log WHERE pos = 100) SELECT pk, event_id, op FROM log, t WHERE epoch(ts) >= s")
def timestamp_start(spark, sf_dir):
    """From the second of record 100 on, by the source."""
    millis = change_log(spark, sf_dir).where("pos = 100").select(F.unix_millis(F.col("ts").cast("timestamp"))).first()[0]
    return read_log(spark, write_log(spark, sf_dir), **{"scan.startup.mode": "timestamp", "scan.startup.timestamp-millis": str(millis)}).select("pk", "event_id", "op")


def write_snapshot(spark, sf_dir, log_folder: str, pos: int) -> dict[str, str]:
    """The table as the log had it at a position, and the options that have a source read it first."""
    folder = new_folder(spark)
    log = change_log(spark, sf_dir).where(F.col("pos") <= pos)
    M.latest_values(log, ["pk"], ["event_id", "value"]).write.parquet(folder)
    place = _place(spark, log_folder, _event_at(spark, sf_dir, pos))
    return {"snapshot.path": folder, "snapshot.key": "pk", "snapshot.table": "demo.users", "snapshot.file": place[0], "snapshot.pos": str(place[1])}


@query(f"WITH {LOG_SQL} SELECT pk, event_id, 'r' AS op FROM (SELECT *, row_number() OVER (PARTITION BY pk ORDER BY pos DESC) AS rn FROM log WHERE pos <= 600) WHERE rn = 1 AND op <> 'd'")
def startup_snapshot(spark, sf_dir):
    folder = write_log(spark, sf_dir)
    return read_log(spark, folder, **{"scan.startup.mode": "snapshot"}, **write_snapshot(spark, sf_dir, folder, 600)).select("pk", "event_id", "op")


STATE_BY_EVENT_SQL = f"WITH {LOG_SQL} SELECT pk, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY pk ORDER BY pos DESC) AS rn FROM log) WHERE rn = 1 AND op <> 'd'"


@query(STATE_BY_EVENT_SQL)
def startup_initial(spark, sf_dir):
    """Snapshot and then log behind one source, merged by key: the state of the log alone."""
    folder = write_log(spark, sf_dir)
    rows = read_log(spark, folder, **{"scan.startup.mode": "initial"}, **write_snapshot(spark, sf_dir, folder, 600))
    return M.latest_values(rows.withColumn("order", F.struct("file", "at", F.col("op") != "r")), ["pk"], ["event_id", "value"], pos="order")


@query(f"""WITH {LOG_SQL}, s AS (SELECT *, event_id * 37 % 10007 AS t FROM log), f AS (SELECT min(pos) AS first FROM s WHERE t >= 9000)
SELECT pos, t FROM s, f WHERE pos >= first""")
def seek_latch(spark, sf_dir):
    """A source time that goes up and down: once reached, everything passes."""
    log = change_log(spark, sf_dir).withColumn("t", F.col("event_id") * 37 % 10007)
    return L.latch_from(log, F.col("t"), 9000).select("pos", "t")


@query(f"""WITH {LOG_SQL}, m AS (SELECT 'log.' || strftime(ts, '%Y%m%d') AS file, min(epoch(ts)::BIGINT) AS first_ts FROM log GROUP BY 1),
t AS (SELECT epoch(ts)::BIGINT AS s FROM log WHERE pos = 200)
SELECT coalesce((SELECT arg_max(file, first_ts) FROM m, t WHERE first_ts <= s), (SELECT arg_min(file, first_ts) FROM m)) AS file, 0::BIGINT AS pos""")
def binlog_file_for_ts(spark, sf_dir):
    log = change_log(spark, sf_dir)
    at = F.round(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("long")
    manifest = log.groupBy(F.concat(F.lit("log."), F.date_format("ts", "yyyyMMdd")).alias("file")).agg(F.min(at).alias("first_ts"))
    seconds = log.where("pos = 200").select(at).first()[0]
    return O.file_for_timestamp(manifest, F.lit(seconds))


OFFSET_SQL = "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'bin.000002' WHEN 1 THEN 'BIN.000002' ELSE 'bin.000010' END AS file, event_id * 31 % 50 AS pos, event_id % 4 AS event, event_id * 7 % 3 AS row FROM events"


@query(f"SELECT event_id, row_number() OVER (ORDER BY lower(file), pos, event, \"row\", event_id) AS rank FROM ({OFFSET_SQL})")
def offset_order(spark, sf_dir):
    """Every event's rank. Buckets are whole offsets with ranges of ids, so no task ranks more than a few thousand rows of one offset."""
    i = F.col("event_id")
    file = F.when(i % 3 == 0, "bin.000002").when(i % 3 == 1, "BIN.000002").otherwise("bin.000010")
    e = table(spark, sf_dir, "events").select("event_id", O.order_key(file, i * 31 % 50, i % 4, i * 7 % 3).alias("offset"))
    return L.with_positions(e, "offset", "event_id", bucket=F.struct("offset", F.floor(i / 2**20).alias("ids"))).select("event_id", F.col("pos").cast("long").alias("rank"))


@query("SELECT event_id FROM (SELECT event_id, event_id // 20 AS pos, event_id % 20 // 4 + 1 AS event, event_id % 4 AS \"row\" FROM events) WHERE pos > 10 OR (pos = 10 AND (event > 3 OR (event = 3 AND \"row\" >= 1)))")
def skip_events_rows(spark, sf_dir):
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    return e.where(L.after_restart(F.floor(i / 20), F.floor(i % 20 / 4) + 1, i % 4, (10, 2, 1))).select("event_id")


# --- filters and columns ---


@query(f"WITH {LOG_SQL} SELECT op, count(*) AS n FROM log WHERE op NOT IN ('u', 'd') GROUP BY op")
def skipped_ops(spark, sf_dir):
    return change_log(spark, sf_dir).where(L.skip_operations("update, delete")).groupBy("op").agg(F.count("*").alias("n"))


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KEYS = {"region": ["r_regionkey"], "orders": ["o_orderkey"], "customer": ["c_custkey"], "conversations": ["conv_id", "turn"]}


@query("SELECT 'demo.' || t AS table_id FROM (SELECT unnest(['orders', 'part', 'lineitem', 'conversations', 'region', 'nation', 'customer', 'supplier', 'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels']) AS t) WHERE t IN ('orders', 'part', 'pages')")
def table_filter(spark, sf_dir):
    return C.captured(C.columns_of(spark, sf_dir, TABLES, KEYS), r"demo\.(orders|pa.*)", r"demo\.partsupp")


@query(f"""WITH {LOG_SQL} SELECT CASE WHEN pos % 10 = 0 THEN 'heartbeat' WHEN pos % 10 = 1 THEN 'schema' WHEN pos % 10 = 2 THEN 'low' WHEN pos % 10 = 3 THEN 'commit' ELSE 'data' END AS kind, count(*) AS n FROM log GROUP BY 1""")
def record_kinds(spark, sf_dir):
    p = F.col("pos") % 10
    raw = change_log(spark, sf_dir).select("*", F.when(p == 0, 1).alias("heartbeat"), F.when(p == 1, "ALTER TABLE t").alias("ddl"), F.when(p == 2, "low").alias("watermark"), F.when(p == 3, "commit").alias("txn"))
    return raw.groupBy(L.record_kind(raw).alias("kind")).agg(F.count("*").alias("n"))


@query(f"WITH {LOG_SQL} SELECT pos, 'users' AS table_name, 'demo' AS database_name, CASE WHEN op = 'c' THEN 0 ELSE epoch_us(ts) // 1000 END AS op_ms, CASE op WHEN 'd' THEN '-D' WHEN 'u' THEN '+U' ELSE '+I' END AS row_kind FROM log")
def metadata_columns(spark, sf_dir):
    """Signups count as rows of a snapshot here, whose time is the epoch."""
    env = envelopes(spark, sf_dir).withColumn("op", F.when(F.col("op") == "c", "r").otherwise(F.col("op")))
    return L.metadata(env).select("pos", "table_name", "database_name", F.unix_millis("op_ts").alias("op_ms"), "row_kind")


@query(f"""WITH {LOG_SQL} SELECT pk, event_id, 0::BIGINT AS ts_ms, 'r' AS op FROM log WHERE op <> 'd'""")
def read_envelopes(spark, sf_dir):
    out = L.as_read(envelopes(spark, sf_dir).select("op", "before", "after", "source"))
    return out.select("after.pk", "after.event_id", "source.ts_ms", "op")


@query(f"""WITH {LOG_SQL}, e AS (SELECT *, lag(event_id) OVER w AS old, lag(op) OVER w AS old_op FROM log WINDOW w AS (PARTITION BY pk ORDER BY pos)),
k AS (SELECT pos, unnest(CASE op WHEN 'u' THEN ['-U', '+U'] WHEN 'd' THEN ['-D'] ELSE ['+I'] END) AS row_kind, event_id, CASE WHEN old_op <> 'd' THEN old END AS old FROM e)
SELECT pos, row_kind, CASE WHEN row_kind IN ('-U', '-D') THEN old ELSE event_id END AS event_id FROM k""")
def row_kinds(spark, sf_dir):
    return L.row_kinds(envelopes(spark, sf_dir)).select("pos", "row_kind", "row.event_id")


@query(f"WITH {LOG_SQL} SELECT pos, op, pk, CASE WHEN op = 'd' THEN -1 ELSE event_id END AS event_id FROM log")
def jsonl_roundtrip(spark, sf_dir):
    """Envelopes to JSON lines and back; a delete has no after."""
    env = envelopes(spark, sf_dir).select("pos", "op", "key", "before", "after", "source")
    back = L.from_json_lines(L.to_json_lines(env), env.schema)
    return back.select("pos", "op", "key.pk", F.coalesce("after.event_id", F.lit(-1)).alias("event_id"))


# --- converters ---


@query("""SELECT o_orderkey AS k, (o_orderkey % 256)::SMALLINT AS tiny, (o_orderkey * 5 % 65536)::INTEGER AS small, (o_orderkey * 999 % 16777216)::BIGINT AS medium,
(o_orderkey * 286331 % 4294967296)::BIGINT AS int, (18446744073709551616::HUGEINT - 1 - o_orderkey)::DECIMAL(20, 0) AS big FROM orders""")
def conv_unsigned(spark, sf_dir):
    """Unsigned values as their signed images, and back."""
    k = F.col("o_orderkey")

    def signed(x, bits):
        return F.when(x >= 2 ** (bits - 1), x - 2**bits).otherwise(x)

    return table(spark, sf_dir, "orders").select(
        k.alias("k"), V.unsigned(signed(k % 256, 8).cast("tinyint"), "tinyint").alias("tiny"), V.unsigned(signed(k * 5 % 65536, 16).cast("smallint"), "smallint").alias("small"),
        V.unsigned(signed(k * 999 % 2**24, 24).cast("int"), "mediumint").alias("medium"), V.unsigned(signed(k * 286331 % 2**32, 32).cast("int"), "int").alias("int"), V.unsigned(-1 - k, "bigint").alias("big"),
    )


@query("SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'a' WHEN 2 THEN 'b' WHEN 3 THEN 'c' END AS label FROM orders")
def conv_enum(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), V.enum_label(F.col("o_orderkey") % 5, ["a", "b", "c"]).alias("label"))


SET_SQL = "concat_ws(',', CASE WHEN o_orderkey & 1 <> 0 THEN 'a' END, CASE WHEN o_orderkey & 2 <> 0 THEN 'b' END, CASE WHEN o_orderkey & 4 <> 0 THEN 'c' END)"


@query(f"SELECT o_orderkey AS k, {SET_SQL} AS labels FROM orders")
def conv_set(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), V.set_text(F.col("o_orderkey"), ["a", "b", "c"]).alias("labels"))


@query(f"SELECT o_orderkey AS k, len(string_split({SET_SQL}, ','))::BIGINT AS n, string_split({SET_SQL}, ',')[-1] AS last FROM orders")
def conv_set_array(spark, sf_dir):
    labels = V.set_array(V.set_text(F.col("o_orderkey"), ["a", "b", "c"]))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.size(labels).cast("long").alias("n"), F.element_at(labels, -1).alias("last"))


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 120 < 70 THEN 2000 + o_orderkey % 120 WHEN o_orderkey % 120 < 100 THEN 1900 + o_orderkey % 120 ELSE o_orderkey % 120 END AS year FROM orders")
def conv_year(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), V.full_year(F.col("o_orderkey") % 120).alias("year"))


@query("""SELECT o_orderkey AS k, (CASE WHEN o_orderkey % 2 = 1 THEN -1 ELSE 1 END) * ((o_orderkey % 839) * 3600 + (o_orderkey % 60) * 60 + o_orderkey * 7 % 60) * 1000000
+ (CASE WHEN o_orderkey % 2 = 1 THEN -1 ELSE 1 END) * (o_orderkey % 10) * 100000 AS micros FROM orders""")
def conv_time(spark, sf_dir):
    k = F.col("o_orderkey")
    text = F.concat(F.when(k % 2 == 1, "-").otherwise(""), (k % 839).cast("string"), F.lit(":"), F.lpad((k % 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((k * 7 % 60).cast("string"), 2, "0"), F.lit("."), (k % 10).cast("string"))
    return table(spark, sf_dir, "orders").select(k.alias("k"), V.time_micros(text).alias("micros"))


@query("""WITH d AS (SELECT o_orderkey AS k, 2000 + o_orderkey % 30 AS y, o_orderkey % 13 AS m, o_orderkey % 29 AS d FROM orders)
SELECT k, CASE WHEN m = 0 OR d = 0 THEN NULL ELSE make_date(y, m, CASE WHEN m = 2 THEN least(d, 28) ELSE d END) END AS day FROM d""")
def conv_zero_date(spark, sf_dir):
    k = F.col("o_orderkey")
    y, m, d = 2000 + k % 30, k % 13, k % 29
    text = F.format_string("%04d-%02d-%02d", y, m, F.when(m == 2, F.least(d, F.lit(28))).otherwise(d))
    return table(spark, sf_dir, "orders").select(k.alias("k"), V.date_or_null(text).alias("day"))


@query("""WITH d AS (SELECT o_orderkey AS k, o_orderkey % 13 AS m, o_orderkey % 29 AS d, o_orderkey % 24 AS h FROM orders)
SELECT k, CASE WHEN m = 0 OR d = 0 THEN NULL ELSE epoch(make_timestamp(2001, m, CASE WHEN m = 2 THEN least(d, 28) ELSE d END, h, 2, 3))::BIGINT END AS seconds FROM d""")
def conv_zero_datetime(spark, sf_dir):
    k = F.col("o_orderkey")
    m, d = k % 13, k % 29
    text = F.format_string("2001-%02d-%02d %02d:02:03", m, F.when(m == 2, F.least(d, F.lit(28))).otherwise(d), k % 24)
    return table(spark, sf_dir, "orders").select(k.alias("k"), F.unix_seconds(V.timestamp_or_null(text).cast("timestamp")).alias("seconds"))


@query("SELECT o_orderkey AS k, upper(lpad(format('{:x}', o_orderkey % 65536), 4, '0')) AS bytes FROM orders")
def conv_bit(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(k.alias("k"), F.hex(V.bit_bytes(F.lpad(F.bin(k % 65536), 16, "0"), 16)).alias("bytes"))


@query("SELECT o_orderkey AS k, rpad(upper(lpad(format('{:x}', o_orderkey % 256), 2, '0')), 8, '0') AS bytes FROM orders")
def conv_binary_pad(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(k.alias("k"), F.hex(V.padded(F.unhex(F.lpad(F.hex(k % 256), 2, "0")), 4)).alias("bytes"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE props END AS props, CASE WHEN event_id % 3 = 0 THEN '{}' ELSE props END AS never_null FROM events")
def conv_json(spark, sf_dir):
    data = F.when(F.col("event_id") % 3 == 0, F.lit(b"")).otherwise(F.col("props").cast("binary"))
    return table(spark, sf_dir, "events").select("event_id", V.json_text(data).alias("props"), V.json_text(data, nullable=False).alias("never_null"))


@query("SELECT o_orderkey AS k, floor((o_orderkey - 5000)::DECIMAL(20, 1) / 2 + 0.5)::BIGINT AS n FROM orders")
def conv_round_default(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(k.alias("k"), V.rounded_default(((k - 5000) / F.lit(2)).cast("string")).alias("n"))


@query("SELECT event_id, event_id * 262144 // 262144 + 1730474993263 AS millis FROM events")
def conv_tso(spark, sf_dir):
    tso = F.shiftleft(F.col("event_id") + F.lit(1730474993263), 18) + F.col("event_id") % 262144
    return table(spark, sf_dir, "events").select("event_id", V.tso_millis(tso).alias("millis"))


@query("SELECT o_orderkey AS k, (CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey * 4294967 % 4294967296 ELSE 18446744073709551615::HUGEINT - o_orderkey END)::DECIMAL(20, 0) AS n FROM orders")
def conv_le_unsigned(spark, sf_dir):
    k = F.col("o_orderkey")
    digits = F.when(k % 2 == 0, F.lpad(F.hex(k * 4294967 % 2**32), 8, "0")).otherwise(F.lpad(F.hex(-1 - k), 16, "0"))
    little = F.unhex(F.array_join(F.reverse(F.filter(F.split(digits, "(?<=\\G..)"), lambda x: x != "")), ""))
    return table(spark, sf_dir, "orders").select(k.alias("k"), V.little_endian(little).alias("n"))


@query("SELECT event_id, decode(encode('é' || event_id)) AS text FROM events")
def conv_charset(spark, sf_dir):
    latin = F.encode(F.concat(F.lit("é"), F.col("event_id").cast("string")), "ISO-8859-1")
    return table(spark, sf_dir, "events").select("event_id", V.decoded(latin, "latin1").alias("text"))


@query("SELECT event_id, strftime(ts, '%d/%m/%Y %H:%M:%S') AS text, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M') AS tokyo FROM events")
def datetime_format(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select("event_id", V.formatted(ts, "dd/MM/yyyy HH:mm:ss").alias("text"), V.formatted(ts, "yyyy-MM-dd HH:mm", "Asia/Tokyo").alias("tokyo"))


@query("""SELECT event_id, lpad((least(abs(event_id * 97 - 300000), 86399) // 3600)::VARCHAR, 2, '0') || ':' || lpad((least(abs(event_id * 97 - 300000), 86399) % 3600 // 60)::VARCHAR, 2, '0') || ':' || lpad((least(abs(event_id * 97 - 300000), 86399) % 60)::VARCHAR, 2, '0') AS text FROM events""")
def time_format(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", V.clamped_time((F.col("event_id") * 97 - 300_000) * 1_000_000).alias("text"))


@query("""SELECT event_id, '{"type": "Point", "coordinates": [' || printf('%.1f', event_id / 2.0) || ', ' || printf('%.1f', user_id * 1.0) || '], "srid": 4326}' AS shape FROM events""")
def conv_geometry(spark, sf_dir):
    def double(x):
        """The big-endian bytes of a half-integer double, in hex: from its binary exponent."""
        e = F.floor(F.log2(x)).cast("int")
        mantissa = ((x / F.pow(F.lit(2.0), e) - 1) * F.lit(2.0**52)).cast("long")
        return F.when(x == 0, F.lit("0" * 16)).otherwise(F.lpad(F.hex(F.shiftleft((e + 1023).cast("long"), 52) + mantissa), 16, "0"))

    x, y = F.col("event_id") / F.lit(2.0), F.col("user_id").cast("double")
    wkb = F.unhex(F.concat(F.lit("E6100000" + "00" + "00000001"), double(x), double(y)))
    return table(spark, sf_dir, "events").select("event_id", V.geometry_json(wkb).alias("shape"))


# --- catalog, metrics, streams ---


@query("SELECT 'orders' AS table_name, column_name, ordinal_position, column_key FROM (VALUES ('o_orderkey', 1, 'PRI'), ('o_custkey', 2, ''), ('o_orderstatus', 3, ''), ('o_totalprice', 4, ''), ('o_orderdate', 5, ''), ('o_orderpriority', 6, '')) t(column_name, ordinal_position, column_key)")
def catalog_columns(spark, sf_dir):
    return C.ordered_columns(C.columns_of(spark, sf_dir, TABLES, KEYS), "orders").select("table_name", "column_name", "ordinal_position", "column_key")


@query("SELECT * FROM (VALUES ('conversations', 'PRIMARY', 'PRIMARY', 'conv_id,turn'), ('orders', 'PRIMARY', 'PRIMARY', 'o_orderkey'), ('orders', 'by_cust', 'INDEX', 'o_custkey,o_orderdate')) t(table_name, constraint_name, kind, columns)")
def constraint_groups(spark, sf_dir):
    columns = C.columns_of(spark, sf_dir, TABLES, KEYS)
    usage = columns.where("column_key = 'PRI' AND table_name IN ('orders', 'conversations')").select("table_name", F.lit("PRIMARY").alias("constraint_name"), "column_name", "ordinal_position")
    index = spark.createDataFrame([("orders", "by_cust", "o_orderdate", 2), ("orders", "by_cust", "o_custkey", 1), ("orders", "by_cust", "gone", 3)], "table_name string, constraint_name string, column_name string, ordinal_position int")
    kinds = spark.createDataFrame([("orders", "PRIMARY", "INDEX"), ("orders", "PRIMARY", "PRIMARY"), ("conversations", "PRIMARY", "PRIMARY"), ("orders", "by_cust", "INDEX")], "table_name string, constraint_name string, kind string")
    return C.constraints(columns, usage.unionByName(index), kinds).withColumn("columns", F.array_join("columns", ","))


@query(f"WITH {LOG_SQL} SELECT max(greatest(5000 - pos, 0)) AS worst, sum(greatest(5000 - pos, 0))::BIGINT AS total FROM log")
def lag_metrics(spark, sf_dir):
    behind = S.lag(F.lit(5000), F.col("pos"))
    return change_log(spark, sf_dir).agg(F.max(behind).alias("worst"), F.sum(behind).alias("total"))


@query(STATE_SQL)
def stream_state_available_now(spark, sf_dir):
    """The log as a stream through the upserting sink, then its state.

    A third of the records arrives with each of three runs, every run with records from all over the log, so that most
    keys' records come out of order.
    """
    from tideline.options import SinkOptions
    from tideline.streaming.state import UpsertSink, upsert_stream

    folder, log = new_folder(spark), _lines(change_log(spark, sf_dir))
    sink = UpsertSink(SinkOptions.read({"sink.data.save.directory": f"{folder}/state", "primary-key": "pk", "sink.create.schema.allowed": "true", "sink.parallelism": "8"}), ["event_id", "value", "number"], pos="number")
    J.register(spark)
    for run, third in enumerate((2, 0, 1)):
        _publish(log.where(F.pmod("pos", F.lit(3)) == third).select("value"), f"{folder}/log", f"log.{run}")
        stream = parsed(spark.readStream.format("jsonlog").load(f"{folder}/log"))
        upsert_stream(stream, sink, f"{folder}/checkpoint").awaitTermination()
    return sink.read(spark).withColumnRenamed("number", "pos").select(*STATE)


def write_feed(spark, sf_dir, folder: str, low: int, high: int | None) -> None:
    """The feed's records of a span of times, as lines of four regions, and the regions' word that it is complete."""
    f = feed(spark, sf_dir).withColumn("t", F.coalesce("commit_ts", "start_ts"))
    f = f.where((F.col("t") >= low) & (F.lit(True) if high is None else F.col("t") < high))
    region = F.concat(F.lit("r"), F.pmod("handle", F.lit(4)))
    rows = f.select(F.to_json(F.struct(F.lit("ROW").alias("kind"), region.alias("region"), "log_type", "table_id", "handle", "start_ts", "commit_ts", F.col("value").cast("string").alias("value"))).alias("value"))
    done = 5000 if high is None else high - 1
    marks = spark.range(4).select(F.to_json(F.struct(F.lit("RESOLVED").alias("kind"), F.concat(F.lit("r"), "id").alias("region"), (F.lit(done) + F.col("id")).alias("resolved_ts"))).alias("value"))
    _publish(rows.union(marks), folder, f"feed.{low:09d}")


TWO_PHASE_SQL = ORACLE_SQL["two_phase_commit"]


@query(TWO_PHASE_SQL)
def two_phase_stream_available_now(spark, sf_dir):
    """The feed as a stream of four regions over three runs, its commits flushed by the regions' resolved times."""
    from tideline.sources.kvfeed import KvFeed
    from tideline.streaming.state import CommitSink, two_phase_stream

    spark.dataSource.register(KvFeed)
    folder = new_folder(spark)
    sink = CommitSink(f"{folder}/state", ["value"])
    for low, high in ((0, 2000), (2000, 4000), (4000, None)):
        write_feed(spark, sf_dir, f"{folder}/feed", low, high)
        stream = spark.readStream.format("kvfeed").load(f"{folder}/feed").drop("op")
        two_phase_stream(stream, sink, f"{folder}/checkpoint").awaitTermination()
    return sink.read(spark).select("table_id", "handle", "commit_ts", F.col("value").cast("double").alias("value"))


@query(f"""WITH {FEED_SQL} SELECT 'r' || handle % 4 AS region, log_type, count(*) AS n FROM feed
WHERE table_id IN (3, 5, 8) AND (handle BETWEEN 100 AND 6000 OR handle BETWEEN 7000 AND 7500) GROUP BY 1, 2""")
def region_feed(spark, sf_dir):
    """What the feed's source gives of some tables and handle ranges, by region."""
    from tideline.sources.kvfeed import KvFeed

    spark.dataSource.register(KvFeed)
    folder = f"{new_folder(spark)}/feed"
    write_feed(spark, sf_dir, folder, 0, None)
    rows = spark.read.format("kvfeed").options(tables="3,5,8", ranges="100-6000,7000-7500").load(folder)
    return rows.where("handle IS NOT NULL").groupBy("region", "log_type").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey AS handle, o_custkey AS cust, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 2 = 0 THEN 7 ELSE -o_orderkey END AS n FROM orders")
def row_codec(spark, sf_dir):
    """Rows in the compact format, nulls, defaults of missing columns and the handle among them, decoded by their schema."""
    from tideline.sources import rowcodec as R

    def number(x, size):
        """Little-endian bytes, in hex."""
        digits = F.lpad(F.hex(x.cast("long")), 16, "0")
        return F.concat(*(F.substring(digits, 15 - 2 * i, 2) for i in range(size)))

    k, c = F.col("o_orderkey"), F.col("o_custkey")
    null, short = k % 5 == 0, k % 2 == 0
    ids = F.concat(F.lit("02"), F.when(null, "").otherwise("03"), F.when(short, "").otherwise("04"), F.when(null, "03").otherwise(""))
    status = F.when(null, "").otherwise(F.hex(F.encode("o_orderstatus", "UTF-8")))
    n = F.when(short, "").otherwise(number(-k, 8))
    sizes = [F.lit(8), F.when(null, 0).otherwise(F.octet_length("o_orderstatus")), F.when(short, 0).otherwise(8)]
    ends = F.concat(number(sizes[0], 2), F.when(null, "").otherwise(number(sizes[0] + sizes[1], 2)), F.when(short, "").otherwise(number(sizes[0] + sizes[1] + sizes[2], 2)))
    count = F.lit(1) + F.when(null, 0).otherwise(1) + F.when(short, 0).otherwise(1)
    data = F.unhex(F.concat(F.lit("8000"), number(count, 2), number(F.when(null, 1).otherwise(0), 2), ids, ends, number(c, 8), status, n))
    columns = [R.ColumnInfo(1, "handle", "int", handle=True), R.ColumnInfo(2, "cust", "int"), R.ColumnInfo(3, "status", "string"), R.ColumnInfo(4, "n", "int", 7)]
    return table(spark, sf_dir, "orders").select(R.decode_rows(data, k, columns).alias("r")).select("r.*")


@query("SELECT event_type, count(*) FILTER (WHERE event_id % 3 = 0) AS records, count(*) AS n FROM events GROUP BY event_type")
def record_keys(spark, sf_dir):
    """Encoded keys, of rows and of an index; only rows' count."""
    i = F.col("event_id")
    key = F.unhex(F.concat(F.lit("74"), F.lpad(F.hex(F.col("user_id")), 16, "0"), F.when(i % 3 == 0, "5F72").otherwise("5F69"), F.lpad(F.hex(i), 16, "0")))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_if(K.is_record_key(key)).alias("records"), F.count("*").alias("n"))


@query(f"WITH c AS ({_even_sql('lineitem', 'l_orderkey')}) SELECT chunk_no, greatest(coalesce(lo, 0), 1000)::BIGINT AS start, least(coalesce(hi, 1000000), 9000)::BIGINT AS stop FROM c WHERE greatest(coalesce(lo, 0), 1000) < least(coalesce(hi, 1000000), 9000)")
def range_overlap(spark, sf_dir):
    lo, hi = (F.coalesce(F.col(c).cast("long"), F.lit(v)) for c, v in (("lo", 0), ("hi", 1_000_000)))
    start, stop = K.overlap(lo, hi, F.lit(1000).cast("long"), F.lit(9000).cast("long"))
    return chunk_even_lineitem(spark, sf_dir).select("chunk_no", start.alias("start"), stop.alias("stop")).where("start < stop")


DDL = ["ALTER TABLE demo.orders ADD c INT", "insert into demo.orders values (1)", "CREATE TABLE demo.part (a INT)", "  BEGIN", "/* hint */ SELECT 1", "DROP TABLE x.y", ""]


@query(f"""WITH {LOG_SQL}, s AS (SELECT pos, ['{"', '".join(DDL)}'][pos % {len(DDL)} + 1] AS ddl FROM log)
SELECT ddl, count(*) AS n FROM s WHERE pos % {len(DDL)} IN (0, 2) GROUP BY ddl""")
def schema_changes(spark, sf_dir):
    """Statements of the log that are schema changes, of tables that are included."""
    ddl = F.get(F.array(*map(F.lit, DDL)), F.pmod("pos", F.lit(len(DDL))).cast("int"))
    log = change_log(spark, sf_dir).select("pos", ddl.alias("ddl"))
    return L.schema_changes(log.where(L.is_ddl(F.col("ddl"))), F.col("ddl").contains("demo.")).groupBy("ddl").agg(F.count("*").alias("n"))


@query(f"WITH {LOG_SQL} SELECT CASE pos % 4 WHEN 3 THEN NULL ELSE 'server-' || pos % 4 END AS uuid, count(*) AS n FROM log WHERE pos % 4 IN (1, 2, 3) GROUP BY 1")
def changes_of_servers(spark, sf_dir):
    uuid_ = F.when(F.col("pos") % 4 != 3, F.concat(F.lit("server-"), (F.col("pos") % 4).cast("string")))
    log = change_log(spark, sf_dir).select("pos", uuid_.alias("uuid"))
    return log.where(L.from_sources(F.col("uuid"), include=["server-[12]"])).groupBy("uuid").agg(F.count("*").alias("n"))


@query(f"""WITH {LOG_SQL}, {CHUNKS_SQL},
s AS (SELECT chunk_no, pk, arg_max(op, pos) AS op FROM log JOIN chunks ON {IN_CHUNK_SQL} AND pos <= low_wm GROUP BY 1, 2)
SELECT chunk_no::BIGINT AS chunk_no, low_wm::BIGINT AS low_wm, (SELECT count(*) FROM s WHERE s.chunk_no = chunks.chunk_no AND op <> 'd') AS n, high_wm::BIGINT AS high_wm FROM chunks""")
def chunk_output(spark, sf_dir):
    """What each chunk gives: its low watermark, rows, and high watermark."""
    chunks, log = user_chunks(spark), change_log(spark, sf_dir)
    rows = S.scan_chunks(S.at_watermark(log, ["pk"], chunks, "pk", "low_wm"), chunks, "pk").groupBy("chunk_no").agg(F.count("*").alias("n"))
    return chunks.join(rows, "chunk_no", "left").select("chunk_no", "low_wm", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "high_wm")


def _planned(spark, sf_dir) -> DataFrame:
    """Chunks of two tables, each with the watermark at which it was read."""
    parts = []
    for name, key, wm in (("orders", "o_orderkey", 100), ("lineitem", "l_orderkey", 40)):
        parts.append(_even(spark, sf_dir, name, key).select(F.lit(f"demo.{name}").alias("table_id"), "chunk_no", "lo", "hi", (F.col("chunk_no") * 7 + wm).alias("high_wm")))
    return parts[0].unionByName(parts[1])


_PLANNED_SQL = " UNION ALL ".join(f"SELECT 'demo.{n}' AS table_id, chunk_no, chunk_no * 7 + {wm} AS high_wm FROM ({_even_sql(n, k)})" for n, k, wm in (("orders", "o_orderkey", 100), ("lineitem", "l_orderkey", 40)))


@query(f"SELECT min(high_wm)::BIGINT AS start, max(high_wm)::BIGINT AS stop FROM ({_PLANNED_SQL})")
def start_stop_offsets(spark, sf_dir):
    """Where the log begins behind the chunks of two planned tables, and where a bounded read of it ends."""
    return M.log_bounds(_planned(spark, sf_dir)).select(F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"))


@query(f"SELECT table_id || ':' || chunk_no AS split_id, floor((row_number() OVER (ORDER BY table_id || ':' || chunk_no) - 1) / 3)::BIGINT AS group_id FROM ({_PLANNED_SQL})")
def meta_groups(spark, sf_dir):
    """Planned chunks in groups of three, in the order of their names."""
    splits = _planned(spark, sf_dir).select(F.concat("table_id", F.lit(":"), "chunk_no").alias("split_id"))
    return M.meta_groups(splits, 3).select("split_id", F.col("group_id").cast("long").alias("group_id"))


@query(f"SELECT table_id, chunk_no::BIGINT AS chunk_no, greatest(high_wm, 110)::BIGINT AS high_wm FROM ({_PLANNED_SQL})")
def suspend_forwards_watermarks(spark, sf_dir):
    return H.suspend(_planned(spark, sf_dir), F.lit(110).cast("long")).select("table_id", "chunk_no", F.col("high_wm").cast("long").alias("high_wm"))


@query(f"SELECT count(*) AS chunks, min(high_wm)::BIGINT AS start FROM ({_PLANNED_SQL})")
def append_chunks(spark, sf_dir):
    """Chunks of a table that is new join those that stream already; the log begins at the smallest watermark."""
    planned = _planned(spark, sf_dir)
    every, start = H.append_chunks(planned.where("table_id = 'demo.orders'"), planned.where("table_id = 'demo.lineitem'"))
    return every.agg(F.count("*").alias("chunks")).crossJoin(F.broadcast(start.select(F.col("start").cast("long").alias("start"))))


@query(f"SELECT table_id, count(*) AS n FROM ({_PLANNED_SQL}) WHERE table_id IN (SELECT 'demo.' || event_type FROM events UNION ALL SELECT 'demo.orders') GROUP BY table_id")
def drop_removed(spark, sf_dir):
    """Chunks of tables that are still captured."""
    names = table(spark, sf_dir, "events").select(F.concat(F.lit("demo."), "event_type").alias("table_id")).distinct().union(spark.range(1).select(F.lit("demo.orders")))
    return H.drop_removed(_planned(spark, sf_dir), names).groupBy("table_id").agg(F.count("*").alias("n"))


_CAPTURED_SQL = "c AS (SELECT DISTINCT 'demo.' || event_type AS table_id FROM events), k AS (SELECT DISTINCT 'demo.' || event_type AS table_id FROM events WHERE event_type IN ('click', 'view') UNION SELECT 'demo.' || c_mktsegment FROM customer)"


def _tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(captured, known) names of tables, drawn from the data."""
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("demo."), "event_type").alias("table_id")).distinct()
    segments = table(spark, sf_dir, "customer").select(F.concat(F.lit("demo."), "c_mktsegment").alias("table_id")).distinct()
    return e, e.where("table_id IN ('demo.click', 'demo.view')").union(segments)


@query(f"WITH {_CAPTURED_SQL} SELECT table_id FROM c EXCEPT SELECT table_id FROM k")
def new_tables(spark, sf_dir):
    return H.new_tables(*_tables(spark, sf_dir))


@query(f"WITH {_CAPTURED_SQL} SELECT table_id FROM k EXCEPT SELECT table_id FROM c")
def removed_tables(spark, sf_dir):
    return H.removed_tables(*_tables(spark, sf_dir))


@query("""WITH f AS (SELECT 'log.' || strftime(ts, '%Y%m%d') AS file, min(epoch_us(ts) // 1000000) AS first_ts, count(*) AS stop FROM events GROUP BY 1),
o AS (SELECT arg_min(file, file) AS first_file, max(file) AS last_file, arg_max(stop, file) AS last_stop FROM f), t AS (SELECT min(first_ts) + 86400 AS s FROM f)
SELECT 'EARLIEST' AS kind, first_file AS file, 0::BIGINT AS pos FROM o UNION ALL SELECT 'LATEST', last_file, last_stop FROM o
UNION ALL SELECT 'TIMESTAMP', coalesce((SELECT max(file) FROM f, t WHERE first_ts <= s), (SELECT first_file FROM o)), 0 UNION ALL SELECT 'SPECIFIC', 'log.x', 7""")
def offset_resolution(spark, sf_dir):
    """Where each kind of start begins, by the log's files: a row a day."""
    e = table(spark, sf_dir, "events")
    at = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    days = e.groupBy(F.concat(F.lit("log."), F.date_format("ts", "yyyyMMdd")).alias("file")).agg(F.min(at).alias("first_ts"), F.count("*").alias("end")).orderBy("file").collect()
    manifest = [r.asDict() for r in days]
    starts = [O.EARLIEST, O.LATEST, O.at_timestamp((manifest[0]["first_ts"] + 86_400) * 1000), O.Offset(file="log.x", pos=7)]
    return spark.createDataFrame([(o.kind, (r := O.resolve(o, manifest)).file, r.pos) for o in starts], "kind string, file string, pos long")


@query("""SELECT event_type, count(*) = count(*) FILTER (WHERE event_id % 2 = 0) AS available FROM events GROUP BY event_type""")
def offset_availability(spark, sf_dir):
    """Whether a start by transaction ids can be had: each type of events is a server whose log has its even ids only."""
    ids = table(spark, sf_dir, "events").groupBy("event_type").agg(F.min("event_id").alias("low"), F.max("event_id").alias("high"), F.count("*").alias("n"), F.count_if(F.col("event_id") % 2 == 0).alias("even"))
    out = []
    for r in ids.collect():  # a row for each server
        try:
            O.check_available(O.Offset(gtids=f"{r.event_type}:1-{r.n}"), [], available=f"{r.event_type}:1-{r.even}" if r.even else "")
            out.append((r.event_type, True))
        except O.LogPurged:
            out.append((r.event_type, False))
    return spark.createDataFrame(out, "event_type string, available boolean")


@query("SELECT user_id, sum(event_id)::BIGINT AS total, count(*) AS n FROM events WHERE event_id % 3 <> 0 OR event_id % 7 = 0 GROUP BY user_id")
def gtid_sets(spark, sf_dir):
    """Sets of transaction ids by user: all less every third, and every seventh again; their intervals' sums and sizes."""
    i = F.col("event_id")
    ids = table(spark, sf_dir, "events").groupBy("user_id").agg(*(F.array_sort(F.collect_list(F.when(c, i))).alias(n) for n, c in (("all", F.lit(True)), ("third", i % 3 == 0), ("seventh", i % 7 == 0))))

    def sums(frames):
        for f in frames:
            def of(values):
                return O.GtidSet({"u": [(int(v), int(v)) for v in values]})

            left = [of(a).minus(of(b)).plus(of(c).minus(O.GtidSet())) for a, b, c in zip(f["all"], f["third"], f["seventh"], strict=True)]
            spans = [g.of.get("u", []) for g in left]
            f["total"] = [sum((a + b) * (b - a + 1) // 2 for a, b in s) for s in spans]
            f["n"] = [sum(b - a + 1 for a, b in s) for s in spans]
            yield f[["user_id", "total", "n"]]

    return ids.mapInPandas(sums, "user_id long, total long, n long")


@query("SELECT * FROM (VALUES ('INITIAL_ASSIGNING', 'snapshot finished', 'INITIAL_FINISHED'), ('INITIAL_FINISHED', 'tables added', 'NEWLY_ADDED_ASSIGNING'), ('NEWLY_ADDED_ASSIGNING', 'snapshot finished', 'NEWLY_ADDED_SNAPSHOT_FINISHED'), ('NEWLY_ADDED_SNAPSHOT_FINISHED', 'log updated', 'NEWLY_ADDED_FINISHED'), ('NEWLY_ADDED_FINISHED', 'tables added', 'NEWLY_ADDED_ASSIGNING')) t(status, event, next)")
def job_states(spark, sf_dir):
    """Every step that a job's state may take."""
    from tideline.plans import fsm

    rows = []
    for status in fsm.Status:
        for event in fsm.Event:
            try:
                rows.append((status.name, event.value, fsm.step(status, event).name))
            except ValueError:
                continue
    return spark.createDataFrame(rows, "status string, event string, next string")


@query("SELECT event_id // 700 AS page, count(*) AS n, max(event_id) AS last FROM events WHERE event_id >= 0 AND event_id < 5000 GROUP BY 1")
def paged_scan(spark, sf_dir):
    """A scan of keys in pages of 700, each from behind the last key of the one before."""
    keys = table(spark, sf_dir, "events").select(F.lpad(F.hex("event_id"), 8, "0").alias("k"), "event_id")

    def scan(start: bytes, n: int):
        text = start.decode().rstrip("\0")
        rows = keys.where(F.col("k") > text if start.endswith(b"\0") else F.col("k") >= text).orderBy("k").limit(n).collect()
        return [(r.k.encode(), r.event_id) for r in rows]

    out = [(i, len(page), page[-1][1]) for i, page in enumerate(B.pages(scan, b"0" * 8, f"{5000:08X}".encode(), 700))]
    return spark.createDataFrame(out, "page long, n long, last long")


DEFAULTS = [
    ("int", "2.5", "3"), ("int", "-2.5", "-2"), ("tinyint(1)", "true", "True"), ("decimal(10,2)", "1.005", "1.01"), ("varchar(9)", "_utf8'it''s'", "it's"), ("date", "0000-00-00", None),
    ("datetime", "2020.1.2 3-4-5", "2020-01-02 03:04:05"), ("timestamp", "CURRENT_TIMESTAMP", "1970-01-01 00:00:00"), ("double", "1e3", "1000.0"), ("bit(16)", "b'0000000111111111'", "b'\\x01\\xff'"), ("time", "-01:02:03", "-1 day, 22:57:57"),
]


@query("SELECT * FROM (VALUES " + ", ".join("('{}', '{}', {})".format(a, b.replace("'", "''"), "NULL" if c is None else "'" + c.replace("'", "''") + "'") for a, b, c in DEFAULTS) + ") t(source_type, written, value)")
def column_defaults(spark, sf_dir):
    """Defaults of columns as a catalog writes them, as values of their types."""
    rows = [(kind, text, None if (v := V.default_value(text, kind)) is None else str(v)) for kind, text, _ in DEFAULTS]
    return spark.createDataFrame(rows, "source_type string, written string, value string")


@query("SELECT event_id, (event_id % 3 > 1 OR event_id % 3 = 1 AND event_id % 12 >= 5) AS new_enough FROM events")
def version_compare(spark, sf_dir):
    """Whether made-up versions are 1.5 or newer, numbers compared as numbers."""
    i = F.col("event_id")
    version = F.concat((i % 3).cast("string"), F.lit("."), (i % 12).cast("string"), F.lit("."), (i % 5).cast("string"), F.lit("-log"))

    @F.pandas_udf("boolean")
    def newer(versions: pd.Series) -> pd.Series:
        return versions.map(lambda v: V.version_key(v) >= (1, 5, 0))

    return table(spark, sf_dir, "events").select("event_id", newer(version).alias("new_enough"))


@query("SELECT event_id, epoch_us(ts) // 1000 AS millis, strftime(ts, '%Y-%m-%d %H:%M:%S') AS local FROM events")
def conv_timestamp(spark, sf_dir):
    """Timestamps as local date-times."""
    local = V.timestamp_or_null(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return table(spark, sf_dir, "events").select("event_id", F.unix_millis(local.cast("timestamp")).alias("millis"), F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("local"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END::INTEGER AS srid, lpad(format('{:X}', event_id), 16, '0') AS wkb FROM events")
def conv_geometry_wkb(spark, sf_dir):
    """Stored geometries as well-known binary and srid, byte for byte."""
    i = F.col("event_id")
    digits = F.lpad(F.hex(F.when(i % 3 == 0, 0).otherwise(i)), 8, "0")
    little = F.concat(*(F.substring(digits, 7 - 2 * k, 2) for k in range(4)))
    shape = V.wkb_struct(F.unhex(F.concat(little, F.lpad(F.hex(i), 16, "0"))))
    return table(spark, sf_dir, "events").select("event_id", shape["srid"].alias("srid"), F.hex(shape["wkb"]).alias("wkb"))


@query(f"WITH {LOG_SQL} SELECT 'server:' || (pos + 1) // 2 AS txn, min(pos) AS first, max(pos) AS last, count(*) AS events, 1::BIGINT AS tables FROM log GROUP BY 1")
def transaction_events(spark, sf_dir):
    """The log's transactions: where each begins and ends, and its events."""
    log = change_log(spark, sf_dir).select("pos", F.concat(F.lit("server:"), F.floor((F.col("pos") + 1) / 2)).alias("gtid"), F.lit("demo.users").alias("table_id"))
    return L.transactions(log).withColumn("tables", F.size("tables").cast("long"))


@query(f"WITH {LOG_SQL} SELECT pos, CASE WHEN op <> 'c' AND epoch_us(ts) > 0 THEN epoch_us(ts) // 1000 END AS millis FROM log")
def event_times(spark, sf_dir):
    """Times for watermarks; signups count as rows of a snapshot here, which have none."""
    env = envelopes(spark, sf_dir).withColumn("op", F.when(F.col("op") == "c", "r").otherwise(F.col("op")))
    return env.select("pos", F.unix_millis(L.event_time(env)).alias("millis"))


@query(f"WITH {LOG_SQL} SELECT op, count(*) AS n FROM log GROUP BY op")
def log_by_sql(spark, sf_dir):
    """The log as a view in SQL over the source, its options given there."""
    J.register(spark)
    folder = write_log(spark, sf_dir)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW tideline_log USING jsonlog OPTIONS (path '{folder}', `scan.startup.mode` 'earliest-offset')")
    return spark.sql("SELECT op, count(*) AS n FROM tideline_log WHERE kind = 'data' GROUP BY op")


@query("SELECT 'orders' AS table_name, o_orderkey < 5000 AS low, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'customer', c_custkey::VARCHAR < '5000', count(*) FROM customer GROUP BY 2")
def typed_compare(spark, sf_dir):
    """Keys against a boundary of another type: numbers as numbers, numbers and text as text."""
    out = []
    for name, key, bound, kind in (("orders", "o_orderkey", "5000", T.DecimalType(10, 0)), ("customer", "c_custkey", "5000", T.StringType())):
        rows = table(spark, sf_dir, name)
        value, both = K.comparable(F.col(key), rows.schema[key].dataType, kind)
        out.append(rows.groupBy((value < F.lit(bound).cast(both)).alias("low")).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "low", "n"))
    return out[0].union(out[1])


@query("""
WITH v AS (SELECT user_id % 4 AS table_id, event_id % 700 AS key, event_id AS commit_ts, CASE event_type WHEN 'error' THEN 'delete' ELSE 'put' END AS op, event_type AS value FROM events)
SELECT table_id, key, arg_max(value, commit_ts) AS value FROM v WHERE table_id IN (1, 2) AND commit_ts <= 8000 GROUP BY table_id, key HAVING arg_max(op, commit_ts) = 'put'""")
def kv_snapshot_and_feed(spark, sf_dir):
    """Tables of a key-value store at a version, then the feed of what was committed after it: their state at the resolved time."""
    from tideline.options import KeyValueOptions

    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    row = [(F.col("user_id") % 4).alias("table_id"), (i % 700).alias("key"), i.alias("commit_ts"), F.when(F.col("event_type") == "error", "delete").otherwise("put").alias("op"), F.col("event_type").alias("value")]
    versions = e.where(i <= 3000).select(*row).where("NOT (commit_ts > 2900 AND commit_ts % 5 = 0)")
    locked = e.where((i > 2900) & (i <= 3000) & (i % 5 == 0))  # written, and committed, but still under their locks
    locks = locked.select(*row[:2], (i - 1).alias("start_ts"), i.alias("primary"), *row[3:])
    commits = locked.select(i.alias("primary"), (i - 1).alias("start_ts"), i.alias("commit_ts"))
    later = e.where(i > 3000)
    mark = [row[0], (i % 700).alias("handle"), (i - 1).alias("start_ts")]
    pre = later.select(*mark, F.lit("PREWRITE").alias("log_type"), F.lit(None).cast("long").alias("commit_ts"), *row[3:])
    commit = later.select(*mark, F.lit("COMMIT").alias("log_type"), row[2], F.lit(None).cast("string").alias("op"), F.lit(None).cast("string").alias("value"))
    options = KeyValueOptions.read({"pd-addresses": "-", "table-list": "1,2,3", "table-list.excluded": "3"})
    changes = B.snapshot_and_feed(versions, locks, commits, pre.union(commit), options, 3000, 8000)
    state = changes.withColumn("op", F.when(F.col("op") == "delete", "d").otherwise("u"))
    return M.latest_values(state, ["table_id", "key"], ["value"], pos="commit_ts")


FLAGSHIP = backfill_then_stream_state
