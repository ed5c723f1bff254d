"""The log source in batch and stream, the sink, stateful two-phase commits: streams must equal batches, restarts too."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from tideline.operators import snapshot as X_
from tideline.operators import twophase as P
from tideline.options import OptionError, SinkOptions
from tideline.plans import chunks as K
from tideline.plans import fsm
from tideline.plans.offsets import LogPurged
from tideline.sources import catalog as C
from tideline.sources import folders as F_
from tideline.sources import jsonlog as J
from tideline.streaming import state as X
from tideline.streaming.job import CaptureJob


def line(i, op="u", k=None, **more):
    return {"op": op, "key": {"pk": k if k is not None else i % 5}, "before": None, "after": None if op == "d" else {"v": i}, "source": {"db": "d", "table": "t", "ts_ms": i * 1000}} | more


@pytest.fixture
def log(tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()

    def add(file, *lines, end="\n"):
        with open(folder / file, "a") as f:
            f.write("\n".join(json.dumps(x) for x in lines) + end)

    add("l.000001.jsonl", *(line(i) for i in range(1, 8)), {"kind": "heartbeat"})
    add("l.000002.jsonl", *(line(i) for i in range(8, 14)), {"ddl": "ALTER TABLE t ADD c INT", "table_id": "d.t"})
    add("l.000003.jsonl", line(14, "d", 4), line(14, "d", 4), line(15))
    add("l.000003.jsonl", line(99), end="")  # being written
    return folder, add


def values(df):
    return [json.loads(r.after)["v"] if r.after else -1 for r in df.orderBy("file", "pos").collect() if r.kind == "data"]


def at(folder, file, lines):
    """The position behind so many lines of a file."""
    return sum(len(x) + 1 for x in (folder / file).read_bytes().split(b"\n")[:lines])


def test_batches_and_startup(spark, log):
    folder, _ = log
    J.register(spark)

    def read(**options):
        return values(spark.read.format("jsonlog").options(**options).load(str(folder)))

    specific = {"scan.startup.mode": "specific-offset", "scan.startup.specific-offset.file": "l.000002.jsonl"}
    assert read() == [*range(1, 14), -1, -1, 15]
    assert read(**{"scan.startup.mode": "latest-offset"}) == []
    assert read(**specific, **{"scan.startup.specific-offset.pos": str(at(folder, "l.000002.jsonl", 3))}) == [11, 12, 13, -1, -1, 15]
    assert read(**{"end-file": "l.000002.jsonl", "end-pos": str(at(folder, "l.000002.jsonl", 2))}) == list(range(1, 10))
    rows = spark.read.format("jsonlog").load(str(folder))
    assert rows.where("op = 'd' AND table_id = 'd.t'").count() == 2
    assert rows.where("kind = 'schema'").first().ddl.startswith("ALTER")
    assert rows.where("file = 'l.000002.jsonl'").orderBy("pos").first().pos == at(folder, "l.000002.jsonl", 1)
    with pytest.raises(LogPurged):
        J.JsonLogSource({"path": str(folder), "scan.startup.mode": "specific-offset", "scan.startup.specific-offset.file": "l.0", "scan.startup.specific-offset.pos": "0"}).start()


def test_start_by_timestamp_is_exact_to_the_second(spark, log):
    folder, _ = log
    J.register(spark)
    for millis, first in ((8500, 8), (1, 1), (8000, 8), (10_999, 10), (0, 1)):
        rows = spark.read.format("jsonlog").options(**{"scan.startup.mode": "timestamp", "scan.startup.timestamp-millis": str(millis)}).load(str(folder))
        assert values(rows)[0] == first and rows.where("kind = 'schema'").count() == 1


def test_start_by_transactions_and_within_one(spark, tmp_path):
    J.register(spark)
    lines = [line(i) for i in range(12)]
    for i, x in enumerate(lines):
        x["source"] |= {"gtid": f"u:{i // 6 + 1}", "event": i % 6 // 2 + 1, "row": i % 2}
    (tmp_path / "a.jsonl").write_text("".join(json.dumps(x) + "\n" for x in lines))

    def read(**options):
        return values(spark.read.format("jsonlog").options(**{f"scan.startup.{k}": v for k, v in options.items()}, **{"scan.startup.mode": "specific-offset"}).load(str(tmp_path)))

    gtids = "specific-offset.gtid-set"
    assert read(**{gtids: "u:1"}) == list(range(6, 12)) and read(**{gtids: "u:1-2"}) == [] and read(**{gtids: "v:1"}) == list(range(12))
    place = {"specific-offset.file": "a.jsonl", "specific-offset.pos": "0"}
    assert read(**place) == list(range(12))
    assert read(**place, **{"specific-offset.skip-events": "1"}) == list(range(2, 12))
    assert read(**place, **{"specific-offset.skip-events": "1", "specific-offset.skip-rows": "1"}) == list(range(3, 12))
    with pytest.raises(LogPurged):
        J.JsonLogSource({"path": str(tmp_path), "scan.startup.mode": "specific-offset", f"scan.startup.{gtids}": "u:1", "log.purged-gtids": "w:1-5"}).start()


def test_a_snapshot_and_then_the_log(spark, log, tmp_path):
    folder, add = log
    J.register(spark)
    spark.createDataFrame([(1, 6), (2, 7), (3, 3), (0, 5), (4, 4)], "pk long, v long").repartition(2).write.parquet(str(tmp_path / "snap"))
    snapshot = {"snapshot.path": str(tmp_path / "snap"), "snapshot.key": "pk", "snapshot.table": "d.t", "snapshot.file": "l.000001.jsonl", "snapshot.pos": str(at(folder, "l.000001.jsonl", 7))}

    def options(mode):
        return {"scan.startup.mode": mode} | snapshot

    whole = spark.read.format("jsonlog").options(**options("initial")).load(str(folder)).where("kind = 'data'")
    assert sorted(json.loads(r.after)["v"] for r in whole.where("op = 'r'").collect()) == [3, 4, 5, 6, 7]
    assert whole.where("op <> 'r'").count() == 9 and whole.where("op = 'r'").first().table_id == "d.t"
    assert spark.read.format("jsonlog").options(**options("snapshot")).load(str(folder)).count() == 5
    for mode, rows in (("snapshot", 5), ("initial", 14)):
        raw = spark.readStream.format("jsonlog").options(**options(mode)).load(str(folder)).where("kind = 'data'")
        q = raw.writeStream.format("parquet").option("path", str(tmp_path / mode)).option("checkpointLocation", str(tmp_path / f"cp-{mode}")).trigger(availableNow=True)
        q.start().awaitTermination()
        assert spark.read.parquet(str(tmp_path / mode)).count() == rows
        if mode == "initial":
            add("l.000004.jsonl", line(16))
            q.start().awaitTermination()  # goes on with the log, without the snapshot
            assert spark.read.parquet(str(tmp_path / mode)).count() == rows + 1
    with pytest.raises(OptionError, match="snapshot.path"):
        J.JsonLogSource({"path": str(folder), "scan.startup.mode": "initial"}).start()


def test_a_table_by_sql(spark, log):
    folder, _ = log
    J.register(spark)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW changes USING jsonlog OPTIONS (path '{folder}', `scan.startup.mode` 'earliest-offset')")
    assert spark.sql("SELECT count(*) FROM changes WHERE op = 'u'").first()[0] == 14
    spark.catalog.dropTempView("changes")


def test_files_are_read_in_pieces(tmp_path):
    folder = F_.Folder(str(tmp_path))
    text = [("x" * (i * 37 % 50)).encode() for i in range(200)]
    (tmp_path / "a.jsonl").write_bytes(b"\n".join(text) + b"\n" + b"open")
    end = folder.whole("a.jsonl", folder.sizes()["a.jsonl"])
    for size in (1, 7, 100, 10_000):
        got = [x for p in F_.pieces({}, {"a.jsonl": end}, size) for _, x in folder.lines(p.file, p.start, p.end)]
        assert got == text
    assert [x for p in F_.pieces({"a.jsonl": end}, {"a.jsonl": end}) for x in folder.lines(p.file, p.start, p.end)] == []


def sink_to(path, **more):
    return SinkOptions.read({"sink.data.save.directory": str(path), "primary-key": "pk", "sink.create.schema.allowed": "true", "sink.parallelism": "3"} | more)


def test_stream_to_state_with_restart_and_repeated_batch(spark, log, tmp_path):
    folder, add = log
    J.register(spark)

    def changes():
        raw = spark.readStream.format("jsonlog").load(str(folder)).where("kind = 'data'")
        pos = F.regexp_extract("file", r"(\d+)", 1).cast("long") * 100_000 + F.col("pos")
        return raw.select(F.get_json_object("key", "$.pk").cast("long").alias("pk"), "op", F.get_json_object("after", "$.v").cast("long").alias("v"), pos.alias("pos"))

    sink = X.UpsertSink(sink_to(tmp_path / "state"), ["v"])
    X.upsert_stream(changes(), sink, str(tmp_path / "cp")).awaitTermination()

    def now():
        return {r.pk: r.v for r in sink.read(spark).collect()}

    assert now() == {0: 15, 1: 11, 2: 12, 3: 13}
    add("l.000003.jsonl")  # ends the line that was being written
    add("l.000004.jsonl", line(16), line(17, "d", 0))
    X.upsert_stream(changes(), sink, str(tmp_path / "cp")).awaitTermination()
    once = now()
    assert once[1] == 16 and once[4] == 99 and 0 not in once
    batch = spark.createDataFrame([(1, "u", 16, 400_001), (0, "d", None, 400_200)], "pk long, op string, v long, pos long")
    sink(batch, 1)
    assert now()[1] == 16 and 0 not in now()
    with pytest.raises(OptionError, match="parallelism"):
        X.UpsertSink(sink_to(tmp_path / "state", **{"sink.parallelism": "4"}), ["v"])(batch, 2)


RECORDS = [(1, "c", 1, 5, "t"), (1, "d", None, 10, "t"), (2, "c", 2, 7, "t"), (2, "u", 3, 9, "u"), (3, "d", None, 4, "t"), (3, "c", 6, 2, "t"), (1, "u", 9, 8, "t")]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[:6])
def test_batches_in_any_order_give_the_same_state(spark, tmp_path, order):
    sink = X.UpsertSink(sink_to(tmp_path / "s"), ["v", "pos"])
    df = spark.createDataFrame(RECORDS, "pk long, op string, v long, pos long, table_id string").coalesce(1)
    for n, part in enumerate(order):
        sink(df.where(F.col("pos") % 3 == part), n)
        sink(df.where(F.col("pos") % 3 == part), n)
    assert {tuple(r) for r in sink.read(spark).collect()} == {(2, 3, 9)}


def test_sink_options(spark, tmp_path):
    df = spark.createDataFrame(RECORDS, "pk long, op string, v long, pos long, table_id string").coalesce(1)

    def state(name, low=None, **more):
        sink = X.UpsertSink(sink_to(tmp_path / name, **more), ["v"], low=low)
        sink(df, 0)
        return {r.pk: r.v for r in sink.read(spark).collect()}, sink

    assert state("a", **{"sink.operator.delete.allowed": "false"})[0] == {1: 9, 2: 3, 3: 6}
    assert state("b", **{"sink.operator.delete.excluded-tables": "x,t"})[0] == {1: 9, 2: 3, 3: 6}
    assert state("c", **{"sink.operator.delete.excluded-tables": "u"})[0] == {2: 3}
    got, sink = state("d", low=lambda: 100)
    assert got == {2: 3} and spark.read.parquet(str(tmp_path / "d" / "batch=0")).count() == 1
    with pytest.raises(OptionError, match="isn't there"):
        state("e", **{"sink.create.schema.allowed": "false"})
    assert sink_to(tmp_path, **{"sink.snapshot.flush.interval.seconds": "7"}).trigger == {"processingTime": "7 seconds"}


FEED = "region string, table_id long, handle long, start_ts long, log_type string, commit_ts long, op string, value string, resolved_ts long"


def record(h, kind, commit=None, region="a"):
    return region, 1, h, h, kind, commit, "u" if kind == "PREWRITE" else None, f"v{h}" if kind == "PREWRITE" else None, None


def resolved(ts, region="a"):
    return region, None, None, None, "RESOLVED", None, None, None, ts


def test_commits_flush_by_resolved_time_of_other_keys(spark, tmp_path):
    sink = X.CommitSink(str(tmp_path / "s"), ["op", "value"])

    def step(n, *rows):
        sink(spark.createDataFrame(rows, FEED), n)
        return sorted((r.handle, r.commit_ts) for r in sink.read(spark).collect())

    assert step(0, record(1, "PREWRITE"), record(1, "COMMIT", 20), resolved(5)) == []
    assert step(1, record(2, "PREWRITE"), resolved(100)) == [(1, 20)]
    assert step(2, record(1, "COMMIT", 20), record(2, "COMMIT", 150), resolved(200, "b")) == [(1, 20)]  # region a is at 100
    assert step(3, resolved(160)) == [(1, 20), (2, 150)]
    assert step(3, resolved(160)) == [(1, 20), (2, 150)]  # the same batch again
    assert step(4, record(300, "ROLLBACK"), record(300, "PREWRITE"), record(9, "COMMIT", 290), resolved(300), resolved(300, "b")) == [(1, 20), (2, 150)]
    assert [r.handle for r in sink.unmatched(spark).collect()] == [9]
    assert spark.read.parquet(str(tmp_path / "s/4/open")).count() == 0


def test_two_phase_stream_is_the_batch(spark, tmp_path):
    rows = [record(h, "PREWRITE") for h in range(20)] + [record(h, "ROLLBACK") for h in range(0, 20, 7)]
    rows += [record(h, "COMMIT", h + 3) for h in range(0, 25, 2)]
    sink = X.CommitSink(str(tmp_path / "out"), ["op", "value"])
    for i, part in enumerate((rows[:12], rows[12:], [resolved(15)])):
        spark.createDataFrame(part, FEED).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema(FEED).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    X.two_phase_stream(stream, sink, str(tmp_path / "cp")).awaitTermination()
    out = [(r.handle, r.commit_ts, r.value) for r in sink.read(spark).collect()]
    feed = spark.createDataFrame(rows, FEED).drop("region", "resolved_ts")
    assert sorted(out) == sorted((r.handle, r.commit_ts, r.value) for r in P.committed(feed, 15).collect()) != []


def test_manifest_checks():
    good = {"version": "8.0.33", "format": "ROW", "row_image": "full", "value_options": "", "offset_minutes": 30}
    J.check_manifest(good)
    for bad in ({"version": "5.5.9"}, {"format": "STATEMENT"}, {"row_image": "MINIMAL"}, {"value_options": "PARTIAL_JSON"}, {"offset_minutes": 60}):
        with pytest.raises(OptionError):
            J.check_manifest(good | bad)


def test_catalog(spark):
    schema = C.schema_of([{"column_name": "b", "column_type": "int unsigned", "is_nullable": "YES", "ordinal_position": 2}, {"column_name": "a", "column_type": "bigint", "is_nullable": "NO", "ordinal_position": 1, "column_key": "PRI"}])
    assert schema.simpleString() == "struct<a:bigint,b:bigint>" and not schema["a"].nullable and schema["a"].metadata["key"] == "PRI"
    rows = spark.createDataFrame([("t", 5, []), ("p", 6, [(8, "hash"), (7, "hash")])], "table_name string, table_id long, partitions array<struct<id:long,kind:string>>")
    assert [(r.table_name, r.partition_id) for r in C.partitions_of(rows).collect()] == [("t", 5), ("p", 7), ("p", 8)]


def test_catalog_and_chunks_by_jdbc(spark):
    """Against a database in this process: the catalog's views, tables by discovery, and a table read chunk by chunk."""
    url = "jdbc:derby:memory:tideline;create=true"
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    run = connection.createStatement().execute
    run("CREATE SCHEMA INFORMATION_SCHEMA")
    for view, columns in (("SCHEMATA", "SCHEMA_NAME"), ("TABLES", "TABLE_SCHEMA TABLE_NAME"), ("COLUMNS", "TABLE_SCHEMA TABLE_NAME COLUMN_NAME COLUMN_TYPE IS_NULLABLE COLUMN_KEY"), ("KEY_COLUMN_USAGE", "TABLE_SCHEMA TABLE_NAME"), ("STATISTICS", "TABLE_SCHEMA TABLE_NAME"), ("COLLATIONS", "COLLATION_NAME")):
        run(f"CREATE TABLE INFORMATION_SCHEMA.{view} ({', '.join(f'{c} VARCHAR(64)' for c in columns.split())})")
    run("INSERT INTO INFORMATION_SCHEMA.SCHEMATA VALUES 'demo', 'it''s'")
    run("INSERT INTO INFORMATION_SCHEMA.COLUMNS VALUES ('demo', 't', 'k', 'bigint', 'NO', 'PRI'), ('demo', 't', 'v', 'int unsigned', 'YES', ''), ('other', 'u', 'k', 'int', 'NO', 'PRI')")
    run("CREATE TABLE T (K BIGINT, V INT)")
    run("INSERT INTO T VALUES " + ", ".join(f"({i}, {i * 2})" for i in range(20)) + ", (NULL, 7)")
    views = C.jdbc_catalog(spark, url, "demo")
    columns = views["columns"].toDF(*(c.lower() for c in views["columns"].columns))
    assert views["schemata"].count() == 1 and {(r.column_name, r.column_key) for r in columns.collect()} == {("k", "PRI"), ("v", "")}
    assert C.jdbc_catalog(spark, url, "it's")["schemata"].count() == 1
    assert [r.table_id for r in C.captured(columns, r"demo\..*").collect()] == ["demo.t"]
    ranges = [(None, 8), (8, 15), (15, None)]
    parts = C.read_chunks_jdbc(spark, url, "T", [p.replace("`", "") for p in K.scan_predicates("K", ranges)])
    assert parts.rdd.getNumPartitions() == 3 and parts.rdd.glom().map(len).collect() == [9, 7, 5]


def test_a_job_with_tables_added_and_a_restart(spark, tmp_path):
    """Tables of a changing store, whose log is written as they change: the sink must hold each table's state, whatever is read when."""
    J.register(spark)
    rng, store, number = random.Random(6), {"d.a": {}, "d.b": {}}, [0]
    folder = tmp_path / "log"
    folder.mkdir()

    def change(n):
        with open(folder / f"l.{number[0]:06d}.jsonl", "a") as f:
            for _ in range(n):
                number[0] += 1
                t, k = rng.choice(["d.a", "d.b"]), rng.randrange(20)
                op = "d" if k in store[t] and rng.random() < 0.3 else "u" if k in store[t] else "c"
                store[t].pop(k, None) if op == "d" else store[t].update({k: number[0]})
                f.write(json.dumps({"op": op, "key": {"pk": k}, "after": None if op == "d" else {"v": number[0]}, "source": {"db": "d", "table": t[2:], "ts_ms": number[0]}}) + "\n")

    def shaped(raw):
        return raw.where("kind = 'data'").select("table_id", F.get_json_object("key", "$.pk").cast("long").alias("pk"), "op", F.get_json_object("after", "$.v").cast("long").alias("v"), F.col("ts_ms").alias("pos"))

    def log():
        return shaped(spark.readStream.format("jsonlog").load(str(folder)))

    def between(table, low, high):
        return shaped(spark.read.format("jsonlog").load(str(folder))).where((F.col("table_id") == table) & (F.col("pos") > low) & (F.col("pos") <= high))

    def driver(table):
        def read(lo, hi):
            rows = [(k, v) for k, v in store[table].items() if (lo is None or k >= lo) and (hi is None or k < hi)]
            return spark.createDataFrame(rows, "pk long, v long")

        hooks = {"after_low": lambda _: change(3), "before_high": lambda _: change(3)}
        return X_.SnapshotDriver(lambda: number[0], read, hooks)

    drivers = {t: (driver(t), [(None, 7), (7, 15), (15, None)]) for t in store}
    sink = X.UpsertSink(SinkOptions.read({"sink.data.save.directory": str(tmp_path / "state"), "primary-key": "table_id,pk", "sink.create.schema.allowed": "true", "sink.parallelism": "2"}), ["v"])

    def job(tables):
        return CaptureJob(spark, str(tmp_path / "job"), tables, log, between, sink, "pk")

    def held(table):
        return {r.pk: r.v for r in sink.read(spark).where(F.col("table_id") == table).collect()}

    change(40)
    one = job({"d.a": drivers["d.a"]})
    one.run()
    assert held("d.a") == store["d.a"] and held("d.b") == {} and one.status is fsm.Status.INITIAL_FINISHED
    change(30)
    one = job({"d.a": drivers["d.a"]})  # a restart
    one.run()
    assert held("d.a") == store["d.a"] and one.status is fsm.Status.INITIAL_FINISHED
    change(10)
    one = job(drivers)
    one.run()
    change(10)  # not read yet when the table is added
    one.add(["d.b"])
    assert one.status is fsm.Status.NEWLY_ADDED_ASSIGNING
    change(10)
    one = job(drivers)  # a restart before the new table is read
    one.run()
    assert held("d.a") == store["d.a"] and held("d.b") == store["d.b"] and one.status is fsm.Status.NEWLY_ADDED_FINISHED
    change(25)
    one.run()
    assert held("d.a") == store["d.a"] and held("d.b") == store["d.b"]
    assert {c["table_id"] for c in one.control.chunks} == {"d.a", "d.b"} and one.control.finished()
