"""Change logs, merge, hand-over and two-phase commits: invariants over random histories, against plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tideline.operators import changelog as L
from tideline.operators import handover as H
from tideline.operators import merge as M
from tideline.operators import snapshot as S
from tideline.operators import twophase as P
from tideline.plans import chunks as K

LOG = "pos long, pk long, op string, v string"


def history(seed, n=300, keys=25):
    rng, live, rows = random.Random(seed), set(), []
    for pos in range(1, n + 1):
        k = rng.randrange(keys)
        op = "c" if k not in live else rng.choice(["u", "u", "d"])
        (live.discard if op == "d" else live.add)(k)
        rows.append((pos, k, op, f"v{pos}"))
    return rows


def state(rows):
    out = {}
    for pos, k, op, v in sorted(rows):
        out.pop(k, None)
        if op != "d":
            out[k] = (pos, v)
    return out


def got(df):
    return {r.pk: (r.pos, r.v) for r in df.collect()}


@pytest.mark.parametrize("seed", range(2))
def test_snapshot_and_log_give_the_state_whatever_the_watermarks(spark, seed):
    rng, rows = random.Random(seed), history(seed)
    log = spark.createDataFrame(rows, LOG).repartition(3)
    bounds = sorted(rng.sample(range(1, 25), 3))
    chunks = []
    for i, (lo, hi) in enumerate(zip([None, *bounds], [*bounds, None], strict=True)):
        low = rng.randint(0, 200)
        chunks.append((i, lo, hi, low, low + rng.randint(0, 100)))
    c = spark.createDataFrame(chunks, "chunk_no long, lo long, hi long, low_wm long, high_wm long")
    snapshot = S.backfilled(log, ["pk"], c, "pk")
    assert got(M.latest_state(snapshot.unionByName(H.handover(log, c, "pk")), ["pk"])) == state(rows)
    at_low = S.backfilled(log, ["pk"], c, "pk", skip=True)
    again = H.handover(log, c.withColumn("high_wm", F.col("low_wm")), "pk")
    assert got(M.latest_state(at_low.unionByName(again), ["pk"])) == state(rows)
    assert got(M.latest_values(log, ["pk"], ["pos", "v"])) == state(rows)


@pytest.mark.parametrize("most", [K.BROADCAST_BYTES, 60])
def test_chunks_are_looked_up_as_by_a_range_join(spark, most):
    rng = random.Random(3)
    for kind, value in (("long", lambda: rng.randint(-50, 50)), ("string", lambda: f"common prefix {rng.randint(0, 60):03d}")):
        rows = [(i, rng.choice("ab"), rng.choice([None, value(), value()])) for i in range(200)]
        chunks = []
        for t in "ab":
            bounds = sorted({value() for _ in range(rng.choice([0, 1, 9]))})
            chunks += [(t, n, lo, hi) for n, (lo, hi) in enumerate(zip([None, *bounds], [*bounds, None], strict=True))]
        log = spark.createDataFrame(rows, f"id long, t string, k {kind}").repartition(3)
        c = spark.createDataFrame(chunks, f"t string, chunk_no long, lo {kind}, hi {kind}")
        want = {(i, n) for i, t, k in rows for u, n, lo, hi in chunks if t == u and (lo is None if k is None else (lo is None or k >= lo) and (hi is None or k < hi))}
        out = K.located(log, c, "k", ["chunk_no"], "t", most)
        assert out.columns == ["id", "t", "k", "chunk_no"]
        assert {(r.id, r.chunk_no) for r in out.collect()} == want and len(want) == 200
        assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    assert K.located(log, c.limit(0), "k", ["chunk_no"], "t", most).count() == 0


def test_ranks_of_keys_with_a_common_prefix(spark):
    keys = [f"Customer#{i:09d}" for i in range(500)]
    df = spark.createDataFrame([(k,) for k in random.Random(1).sample(keys, 500)], "k string").repartition(4)
    out = K.dense_rank_by_range(df, "k", rows=40)
    assert [(r.k, r["rank"], r.total) for r in out.orderBy("k").collect()] == [(k, i, 500) for i, k in enumerate(keys)]
    assert len(out.inputFiles()) > 5  # a range is a file
    assert K.dense_rank_by_range(df.limit(0), "k").count() == 0


def test_upsert_of_a_chunk_and_keys_that_leave_it(spark):
    snapshot = spark.createDataFrame([(0, 1, "r", "a"), (0, 2, "r", "b")], LOG)
    log = spark.createDataFrame([(5, 1, "u", "a2"), (6, 2, "d", None), (7, 3, "c", "n"), (8, 99, "c", "far")], LOG)
    out = M.upsert_chunk(snapshot, log, ["pk"], F.col("pk") < 10)
    assert {(r.pk, r.v, r.op) for r in out.collect()} == {(1, "a2", "r"), (3, "n", "r")}
    env = L.envelope(log, ["pk"], ["v"], {"ts_ms": F.lit(1)})
    assert M.moved_out(env, F.lit(True), F.lit(True)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_multiset_of_a_table_without_key(spark, seed):
    rng, bag, rows = random.Random(seed), Counter(), []
    for _ in range(200):
        new = (rng.choice("xyz"), rng.randint(0, 3))
        old = rng.choice(sorted(bag.elements())) if bag and rng.random() < 0.5 else None
        op = "c" if old is None else rng.choice("ud")
        bag.subtract([old] if old else [])
        bag.update([new] if op != "d" else [])
        bag = +bag
        rows.append((op, old, new if op != "d" else None))
    df = spark.createDataFrame(rows, "op string, before struct<a:string,b:int>, after struct<a:string,b:int>").repartition(3)
    assert Counter(tuple(r) for r in M.multiset_state(df, ["a", "b"]).collect()) == bag


def test_positions_are_dense_and_don_t_depend_on_partitions(spark):
    rows = [(i, random.Random(i).random() * 100) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, t double")
    a, b = ({r.id: r.pos for r in L.with_positions(df.repartition(n), "t", "id", bucket=F.floor("t")).collect()} for n in (1, 7))
    assert a == b == {i: k for k, (i, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])), 1)}


def test_row_kinds_and_metadata(spark):
    log = spark.createDataFrame([(1, 7, "c", "a"), (2, 7, "u", "b"), (3, 7, "d", None), (4, 7, "c", "z")], LOG)
    env = L.envelope(log, ["pk"], ["v"], {"db": F.lit("d"), "table": F.lit("t"), "ts_ms": F.col("pos") * 1000})
    kinds = [(r.pos, r.row_kind, r.row and r.row.v) for r in L.row_kinds(env).orderBy("pos", "row_kind").collect()]
    assert kinds == [(1, "+I", "a"), (2, "+U", "b"), (2, "-U", "a"), (3, "-D", "b"), (4, "+I", "z")]
    meta = {r.pos: (r.table_name, r.database_name, r.op_ts.timestamp(), r.row_kind) for r in L.metadata(env).collect()}
    assert meta[2] == ("t", "d", 2.0, "+U") and meta[3][3] == "-D"
    read = L.as_read(env.select("op", "before", "after", "source"))
    assert {(r.op, r.before, r.source.ts_ms) for r in read.collect()} == {("r", None, 0)}


def test_filters(spark):
    names = spark.createDataFrame([(x,) for x in ("shop.orders", "SHOP.Order_items", "mysql.user", "shop.tmp_1")], "table_id string")
    assert {r[0] for r in names.where(L.table_filter(r"shop\..*", r"shop\.tmp_\d+")).collect()} == {"shop.orders", "SHOP.Order_items"}
    assert names.where(L.table_filter(None)).count() == 3
    ddl = spark.createDataFrame([(x,) for x in ("ALTER TABLE t ADD c INT", "begin", " insert into t values (1)", "XA END 'x'", "create table begin_t (a int)", "")], "q string")
    assert {r.q for r in ddl.where(L.is_ddl(F.col("q"))).collect()} == {"ALTER TABLE t ADD c INT", "create table begin_t (a int)"}
    uuids = spark.createDataFrame([("a1",), ("b2",), (None,)], "u string")
    assert [r.u for r in uuids.where(L.from_sources(F.col("u"), include=["a.*"])).collect()] == ["a1", None]
    assert [r.u for r in uuids.where(L.from_sources(F.col("u"), exclude=["a.*"])).collect()] == ["b2", None]
    rows = spark.createDataFrame([("2024-01-01 00:00:01.9", "data"), ("2024-01-01 00:00:00", "schema"), ("2024-01-01 00:00:00.9", "data")], "t string, k string").select(F.col("t").cast("timestamp").alias("t"), "k")
    assert rows.where(L.from_timestamp(F.col("t"), F.col("k"), 1704067201500)).count() == 2


FEED = "log_type string, table_id long, handle long, start_ts long, commit_ts long, op string, value string"


def test_two_phase_commits(spark):
    rows = [
        ("PREWRITE", 1, 1, 10, None, "u", "a"), ("COMMIT", 1, 1, 10, 15, None, None), ("COMMIT", 1, 1, 10, 15, None, None),  # redelivered
        ("PREWRITE", 1, 2, 11, None, "u", "b"), ("ROLLBACK", 1, 2, 11, None, None, None), ("COMMIT", 1, 2, 11, 16, None, None),
        ("PREWRITE", 1, 3, 12, None, "d", None), ("COMMIT", 1, 3, 12, 99, None, None),  # after the resolved time
        ("COMMIT", 1, 4, 13, 17, None, None), ("PREWRITE", 1, 5, 14, None, "u", "c"), ("COMMITTED", 2, 1, 3, 9, "c", "w"), ("OTHER", 1, 1, 1, 1, "u", "x"),
    ]
    feed = spark.createDataFrame(rows, FEED).repartition(3)
    assert sorted((r.table_id, r.handle, r.commit_ts, r.op, r.value) for r in P.committed(feed, 50).collect()) == [(1, 1, 15, "u", "a"), (2, 1, 9, "c", "w")]
    assert [r.handle for r in P.unmatched(feed).collect()] == [4]
    regions = spark.createDataFrame([(1, 5), (1, 9), (2, 7)], "region long, resolved_ts long")
    assert P.resolved_over(regions).first().resolved == 7


def test_tables_over_the_life_of_a_job(spark):
    chunks = spark.createDataFrame([("a", 0, 10), ("b", 0, 30)], "table_id string, chunk_no long, high_wm long")
    more = spark.createDataFrame([("c", 0, 5)], chunks.schema)
    every, start = H.append_chunks(H.suspend(chunks, F.lit(20).cast("long")), more)
    assert sorted((r.table_id, r.high_wm) for r in every.collect()) == [("a", 20), ("b", 30), ("c", 5)] and start.first().start == 5
    captured = spark.createDataFrame([("a",), ("c",)], "table_id string")
    assert {r.table_id for r in H.drop_removed(every, captured).collect()} == {"a", "c"}
    log = spark.createDataFrame([("a", 15), ("a", 25), ("x", 1)], "table_id string, pos long")
    assert {tuple(r) for r in H.pure_phase(log, chunks, unseen=True).collect()} == {("a", 15), ("a", 25), ("x", 1)}
    assert {tuple(r) for r in H.pure_phase(log, chunks).collect()} == {("a", 15), ("a", 25)}


def test_writes_between_the_phases_of_a_chunk_are_not_lost(spark):
    """Rows written after the low watermark are in the chunk, or in the log after it, or both; the merge has each once."""
    rows = [(1, 1, "c", "a"), (2, 2, "c", "b")]

    def write(op, k, v):
        rows.append((len(rows) + 1, k, op, v))

    for phase in S.PHASES:
        del rows[2:]
        driver = S.SnapshotDriver(lambda: len(rows), lambda lo, hi: spark.createDataFrame([(p, k, "r", v) for k, (p, v) in state(rows).items()], LOG), {phase: lambda n: (write("u", 1, "late"), write("d", 2, None), write("c", 3, "new"))})
        snapshot, control = driver.chunk(0, None, None, lambda df: spark.createDataFrame(df.collect(), df.schema))
        log = spark.createDataFrame(rows, LOG)
        during = log.where((F.col("pos") > control["low_wm"]) & (F.col("pos") <= control["high_wm"]))
        chunk = M.upsert_chunk(snapshot, during, ["pk"], F.lit(True))
        final = M.latest_state(chunk.unionByName(log.where(F.col("pos") > control["high_wm"])), ["pk"])
        assert got(final) == state(rows), phase


def test_jdbc_catalog_loads_every_view():
    from unittest.mock import MagicMock

    from tideline.sources.catalog import jdbc_catalog

    spark = MagicMock()
    options = spark.read.format.return_value.options
    out = jdbc_catalog(spark, "jdbc:x", "it's", user="u")
    assert len(out) == 6 and all(v is options.return_value.load.return_value for v in out.values())
    assert any("TABLE_SCHEMA = 'it''s'" in c.kwargs["query"] for c in options.call_args_list)


def test_committed_rows_are_in_order_of_commit_within_partitions(spark):
    rows = [(t, h, h, kind, h * 7 % 31 + 40 if kind == "COMMIT" else None, "v") for t in (1, 2) for h in range(20) for kind in ("PREWRITE", "COMMIT")]
    feed = spark.createDataFrame(rows, "table_id long, handle long, start_ts long, log_type string, commit_ts long, value string").repartition(5)
    parts = P.committed(feed).select("commit_ts", "table_id", "handle").rdd.glom().collect()
    assert sum(map(len, parts)) == 40 and all([tuple(r) for r in p] == sorted(tuple(r) for r in p) for p in parts)
