"""The key-value side: versions, locks, pages, the regions' feed; user extensions and errors."""

import json

import pytest
from pyspark.sql import functions as F

from tideline import errors
from tideline.operators import extend as X
from tideline.operators import mvcc as B
from tideline.operators import twophase as P
from tideline.sources.kvfeed import KvFeed
from tideline.sources.rowcodec import record_key


def test_versions_and_locks(spark):
    v = spark.createDataFrame([("a", 1, "put", "a1"), ("a", 5, "put", "a5"), ("b", 2, "put", "b"), ("b", 4, "delete", None), ("c", 9, "put", "late")], "key string, commit_ts long, op string, value string")
    assert {tuple(r) for r in B.at_version(v, 6).collect()} == {("a", "a5")}
    assert {tuple(r) for r in B.at_version(v, 3).collect()} == {("a", "a1"), ("b", "b")}
    locks = spark.createDataFrame([("d", 2, "p", "put", "d"), ("e", 2, "q", "put", "e"), ("f", 8, "p", "put", "f")], "key string, start_ts long, primary string, op string, value string")
    commits = spark.createDataFrame([("p", 2, 5), ("q", 2, None), ("p", 8, 10)], "primary string, start_ts long, commit_ts long")
    assert {r.key for r in B.at_version(B.resolve_locks(v, locks, commits, 6), 6).collect()} == {"a", "d"}
    keys = spark.createDataFrame([(record_key(1, 5), 1, "put", "x"), (b"t" + b"\x80" * 8 + b"_i123", 1, "put", "y")], "key binary, commit_ts long, op string, value string")
    assert [r.value for r in B.at_version(keys, 2, rows_only=True).collect()] == ["x"]


def test_pages_cover_a_range_once():
    data = [(bytes([i]), i) for i in range(50)]
    got = list(B.pages(lambda at, n: [x for x in data if x[0] >= at][:n], bytes([3]), bytes([33]), 7))
    assert [v for page in got for _, v in page] == list(range(3, 33)) and all(len(p) <= 7 for p in got)
    assert list(B.pages(lambda at, n: [], b"", b"z", 5)) == []


def test_region_feed(spark, tmp_path):
    spark.dataSource.register(KvFeed)

    def row(kind, h, commit=None, table=1):
        return {"kind": "ROW", "log_type": kind, "table_id": table, "handle": h, "start_ts": h, "commit_ts": commit, "op": "u" if kind == "PREWRITE" else None, "value": f"v{h}" if kind == "PREWRITE" else None}

    def write(region, *events):
        with open(tmp_path / f"{region}.jsonl", "a") as f:
            f.writelines(json.dumps(e) + "\n" for e in events)

    write("r1", row("PREWRITE", 1), row("COMMIT", 1, 5), row("PREWRITE", 9, table=2), {"kind": "RESOLVED", "resolved_ts": 20}, row("NOISE", 3))
    write("r2", row("PREWRITE", 2), row("COMMIT", 2, 12), {"kind": "RESOLVED", "resolved_ts": 10})
    feed = spark.read.format("kvfeed").option("tables", "1").load(str(tmp_path))
    rows = feed.where("log_type <> 'RESOLVED'").collect()
    resolved = P.resolved_over(feed).first()[0]
    assert resolved == 10 and {r.region for r in rows} == {"r1", "r2"} and {r.table_id for r in rows} == {1}
    assert [r.handle for r in P.committed(feed.drop("region", "resolved_ts"), resolved).collect()] == [1]
    q = spark.readStream.format("kvfeed").load(str(tmp_path)).where("log_type <> 'RESOLVED'").writeStream.format("parquet").option("path", str(tmp_path / "_out")).option("checkpointLocation", str(tmp_path / "_cp")).trigger(availableNow=True)
    q.start().awaitTermination()
    write("r2", row("PREWRITE", 4), {"kind": "RESOLVED", "resolved_ts": 30})
    q.start().awaitTermination()
    assert sorted(r.handle for r in spark.read.parquet(str(tmp_path / "_out")).collect()) == [1, 1, 2, 2, 4, 9]
    assert sorted(r.handle for r in spark.read.format("kvfeed").option("ranges", "2-3,9-9").load(str(tmp_path)).where("handle IS NOT NULL").collect()) == [2, 2, 9]
    write("r1", {"kind": "ERROR", "message": "epoch changed", "resolved_ts": 20}, row("PREWRITE", 5))
    with pytest.raises(Exception, match="epoch changed"):
        spark.read.format("kvfeed").option("errors", "fail").load(str(tmp_path)).count()
    again = spark.read.format("kvfeed").load(str(tmp_path))
    assert again.where("log_type = 'ERROR' AND resolved_ts = 20").count() == 1 and again.where("handle = 5").count() == 1
    assert spark.read.format("kvfeed").option("errors", "skip").load(str(tmp_path)).where("log_type = 'ERROR'").count() == 0


def test_unknown_tables(spark):
    log = spark.createDataFrame([("a", 1), ("b", 2)], "table_id string, pos long")
    known = log.where("table_id = 'a'")
    for mode in ("warn", "skip"):
        assert [r.pos for r in X.of_known_tables(log, known, mode).collect()] == [1]
    assert X.of_known_tables(known, known).count() == 1
    with pytest.raises(Exception, match="unknown table b"):
        X.of_known_tables(log, known).collect()


def test_converters(spark):
    from pyspark.sql import types as T

    from tideline.functions.types import field

    schema = T.StructType([field("a", "datetime(3)"), field("b", "varchar(3)"), field("c", "int")])
    import datetime as dt

    df = spark.createDataFrame([(dt.datetime(2020, 1, 2), "x", 1)], schema)
    out = X.convert_columns(df, {"type:datetime": lambda c: F.date_format(c, "yyyy/MM/dd"), "b": F.upper}).first()
    assert tuple(out) == ("2020/01/02", "X", 1)


def test_errors():
    assert isinstance(errors.classify("the schema of t isn't known"), errors.SchemaOutOfSync)
    assert "start with a new snapshot" in str(errors.classify(ValueError("the log has no file x any more")))
    e = ValueError("else")
    assert errors.classify(e) is e
