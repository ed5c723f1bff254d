"""Offsets, transaction sets, chunks, options and job states."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline import options as Opt
from tideline.plans import chunks as K
from tideline.plans import fsm
from tideline.plans import offsets as O

# --- transaction sets ---

intervals = st.dictionaries(st.sampled_from(["a", "b", "c"]), st.lists(st.tuples(st.integers(1, 40), st.integers(0, 8)).map(lambda x: (x[0], x[0] + x[1])), max_size=4), max_size=3)


def ids(s: O.GtidSet) -> set:
    return {(u, i) for u, parts in s.of.items() for a, b in parts for i in range(a, b + 1)}


@given(intervals, intervals)
@settings(deadline=None)
def test_gtid_algebra_is_that_of_sets(x, y):
    a, b = O.GtidSet(x), O.GtidSet(y)
    assert ids(a.minus(b)) == ids(a) - ids(b)
    assert ids(a.plus(b)) == ids(a) | ids(b)
    assert a.within(b) == (ids(a) <= ids(b))
    assert O.GtidSet.parse(str(a)) == a
    assert a.minus(b).within(a)


def test_gtid_sets_of_a_restart():
    server, restored = O.GtidSet.parse("A:1-100,b:1-10"), O.GtidSet.parse("a:5-40")
    assert str(restored.fixed_to(server)) == "a:1-40"
    assert str(O.GtidSet.parse("a:1-5").merged_into(O.GtidSet.parse("a:1-9,b:3"))) == "a:1-5,b:3"
    assert str(O.start_gtids(restored, server, O.GtidSet.parse("a:1-3,b:1-4"))) == "a:5-40,b:1-4"
    assert str(O.start_gtids(restored, server, O.GtidSet.parse("b:1-4"), lambda u: u != "b")) == "a:5-40"


# --- offsets ---


def test_offset_order():
    o = O.Offset
    ordered = [o("bin.000002", 5), o("BIN.000002", 5, 1), o("bin.000002", 5, 1, 2), o("bin.000002", 7), o("bin.000010", 1), O.NON_STOPPING]
    shuffled = random.Random(0).sample(ordered, len(ordered))
    assert sorted(shuffled, key=O.ordering) == ordered
    assert O.NON_STOPPING.compare(O.NON_STOPPING) == 0
    assert o("bin.2", 1).compare(o("bin.10", 1)) > 0  # names compare as text
    assert o("z", 9, server_id=1, ts_sec=5).compare(o("a", 1, server_id=2, ts_sec=6)) < 0
    a, b = o(gtids="a:1-5", event=2), o(gtids="a:1-9")
    assert a.compare(b) < 0 < b.compare(a) and a.compare(o(gtids="a:1-5", event=1)) > 0
    assert o("f", 1).compare(a) < 0 < a.compare(o("f", 1))
    assert O.Offset.from_json(a.to_json()) == a


def test_startup_offsets():
    manifest = [{"file": "l.1", "first_ts": 100, "end": 10}, {"file": "l.2", "first_ts": 200, "end": 20}]
    assert O.resolve(O.EARLIEST, manifest).file == "l.1"
    assert (O.resolve(O.LATEST, manifest).file, O.resolve(O.LATEST, manifest).pos) == ("l.2", 20)
    assert [O.resolve(O.at_timestamp(ms), manifest).file for ms in (5, 100_999, 199_999, 200_000, 10**9)] == ["l.1", "l.1", "l.1", "l.2", "l.2"]
    with pytest.raises(O.LogPurged):
        O.check_available(O.Offset("l.0", 4), ["l.1", "l.2"])
    O.check_available(O.Offset("L.1", 4), ["l.1"])
    O.check_available(O.Offset(), [])
    O.check_available(O.Offset(gtids="a:1-5"), [], "a:1-9", "a:1-5")
    with pytest.raises(O.LogPurged):
        O.check_available(O.Offset(gtids="a:1-5"), [], "a:1-9", "a:1-6")
    with pytest.raises(O.LogPurged):
        O.check_available(O.Offset(gtids="a:1-5"), [], "a:1-4")


def test_file_for_timestamp(spark):
    m = spark.createDataFrame([("l.1", 100), ("l.2", 200)], "file string, first_ts long")
    assert [O.file_for_timestamp(m, F.lit(t)).first().file for t in (5, 100, 199, 200, 999)] == ["l.1", "l.1", "l.1", "l.2", "l.2"]


# --- chunks ---


def covered(ranges, keys):
    return [sum((lo is None or k >= lo) and (hi is None or k < hi) for _, lo, hi in ranges) for k in keys]


@pytest.mark.parametrize("rows,low,high,factor,step,n", [(15000, 0, 14999, "1.0000", 8096, 2), (60000, 0, 14999, "0.2500", 2024, 8), (10, 5, 5, "0.1000", 809, 1), (20000, -7, 2**62, None, None, None)])
def test_even_chunks(spark, rows, low, high, factor, step, n):
    stats = K.KeyStats(low, high, rows)
    if factor:
        assert str(stats.factor()) == factor
    assert K.even_step(stats, True) == step
    assert K.even_step(stats, False) is None
    if step:
        ranges = sorted(tuple(r) for r in K.even_chunks(spark, stats, step, T.LongType()).collect())
        assert len(ranges) == n and ranges[0][1] is None and ranges[-1][2] is None
        assert set(covered(ranges, [low - 1, low, high, high + 1, (low + high) // 2])) == {1}


def test_empty_and_small_tables_are_one_chunk(spark):
    for stats in (K.KeyStats(None, None, 0), K.KeyStats(3, 900, 8096), K.KeyStats(3, 3, 10**6)):
        assert [tuple(r) for r in K.even_chunks(spark, stats, 5, T.LongType()).collect()] == [(0, None, None)]


@pytest.mark.parametrize("kind", ["string", "long"])
@pytest.mark.parametrize("rows,size", [(1, 10), (10, 10), (11, 10), (500, 7), (100, 2)])
def test_uneven_chunks_by_rank_are_those_by_steps(spark, kind, rows, size):
    keys = random.Random(rows).sample(range(10_000), rows)
    df = spark.createDataFrame([(f"k{k:05d}" if kind == "string" else k,) for k in keys], f"k {kind}").repartition(3)
    by_rank = sorted(tuple(r) for r in K.uneven_chunks(df, "k", size).collect())
    assert by_rank == list(K.iterate_uneven(df, "k", size))
    assert set(covered(by_rank, [r.k for r in df.collect()])) == {1}


def test_uneven_chunks_with_duplicates_and_a_restart(spark):
    df = spark.createDataFrame([(k,) for k in [1] * 30 + [2, 3, 4, 4, 4, 9, 9]], "k long")
    ranges = list(K.iterate_uneven(df, "k", 4))
    assert set(covered(ranges, [1, 2, 3, 4, 9])) == {1}
    rest = list(K.iterate_uneven(df, "k", 4, ranges[1][1], ranges[1][0]))
    assert rest == ranges[1:]


def test_null_keys_lie_in_the_first_chunk(spark):
    df = spark.createDataFrame([(None,), (1,), (7,)], "k long")
    assert df.where(K.key_in(F.col("k"), F.lit(None).cast("long"), F.lit(5).cast("long"))).count() == 2
    assert df.where(K.key_in(F.col("k"), F.lit(5).cast("long"), F.lit(None).cast("long"))).count() == 1
    assert K.scan_predicates("k`", [(None, 5), (5, None), (None, None), ("o'x", "z")]) == ["(`k``` < 5) OR `k``` IS NULL", "`k``` >= 5", "1 = 1", "`k``` >= 'o''x' AND `k``` < 'z'"]


def test_handle_ranges_cover_the_space(spark):
    rows = sorted((int(r.lo), int(r.hi)) for r in K.handle_ranges(spark, 3).collect())
    assert rows[0][0] == -(2**63) and rows[-1][1] == 2**63 and all(a[1] == b[0] for a, b in zip(rows, rows[1:], strict=False))


# --- options ---


def test_options():
    o = Opt.SourceOptions.read({"Table-Name": "a.*,b", "scan.startup.mode": "INITIAL", "connect.timeout": "20s", "password": "x", "debezium.heartbeat.interval.ms": "7", "other": "1"})
    assert (o.table, o.chunk_size, o.connect_timeout, o.mode) == ("a.*,b", 8096, 20.0, Opt.StartupMode.INITIAL)
    assert o.shown()["password"] == "***" and o.log_properties["heartbeat.interval.ms"] == "7"
    assert o.check_key(["a", "b"], ["b"]) == "b"
    with pytest.raises(Opt.OptionError):
        o.check_key(["a"], [])
    assert Opt.connector("MySQL") is Opt.SourceOptions and Opt.connector("nothing") is None


@pytest.mark.parametrize(
    "bad",
    [
        {"scan.incremental.snapshot.chunk.size": "1"}, {"chunk-meta.group.size": "1"}, {"scan.snapshot.fetch.size": "0"}, {"connection.pool.size": "1"}, {"connect.max-retries": "0"}, {"connect.timeout": "250ms"},
        {"chunk-key.even-distribution.factor.upper-bound": "0.5"}, {"chunk-key.even-distribution.factor.lower-bound": "1.5"}, {"table-name": "(a"}, {"scan.startup.mode": "soon"}, {"scan.startup.mode": "specific-offset"},
        {"scan.startup.mode": "timestamp"}, {"server-id": "9-3"}, {"port": "x"}, {"on.unknown.table": "maybe"},
    ],
)
def test_bad_options(bad):
    with pytest.raises(Opt.OptionError):
        Opt.SourceOptions.read(bad)


def test_server_ids():
    r = Opt.ServerIds.parse("5400-5402")
    assert [r.of(i) for i in range(3)] == [5400, 5401, 5402]
    with pytest.raises(Opt.OptionError):
        r.of(3)


# --- job states ---


def test_states():
    s = fsm.Status.INITIAL_ASSIGNING
    assert fsm.reads_snapshot(s) and not fsm.log_may_run(s, 1, True)
    for event in (fsm.Event.SNAPSHOT_FINISHED, fsm.Event.TABLES_ADDED, fsm.Event.SNAPSHOT_FINISHED, fsm.Event.LOG_UPDATED, fsm.Event.TABLES_ADDED):
        s = fsm.step(s, event)
    assert s is fsm.Status.NEWLY_ADDED_ASSIGNING
    assert not fsm.log_may_run(fsm.Status.INITIAL_FINISHED, 2, False) and fsm.log_may_run(fsm.Status.INITIAL_FINISHED, 1, False)
    for status in fsm.Status:
        for event in fsm.Event:
            if (status, event) not in fsm.STEPS:
                with pytest.raises(ValueError):
                    fsm.step(status, event)


def test_control_document():
    c = fsm.Control(tables=["a"], chunks=[{"table_id": "a", "chunk_no": 0, "lo": None, "hi": 5, "low_wm": 1, "high_wm": 2}])
    assert c.finished() and fsm.Control.from_json(c.to_json()) == c
    c.back(0, "a")
    assert not c.finished()
    assert [c.add_schema("a", d) for d in ("x", "x", "y")] == [1, 1, 2]
    old = fsm.Control.from_json('{"status": "INITIAL_FINISHED", "chunks": [{"table_id": "a", "chunk_no": 0, "high_wm": 9}]}')
    assert old.chunks[0]["low_wm"] == 9 and old.cursor is None
    with pytest.raises(ValueError):
        fsm.Control.from_json('{"version": 99}')
