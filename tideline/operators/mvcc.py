"""Snapshots of a multi-version key-value table at one version, in pages, with locks resolved on the way."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.twophase import committed
from tideline.options import KeyValueOptions, StartupMode
from tideline.plans.chunks import is_record_key


def at_version(versions: DataFrame, version: int, key: str = "key", values: tuple[str, ...] = ("value",), rows_only: bool = False) -> DataFrame:
    """(key, values): of each key the write with the largest commit_ts up to the version; deleted keys are gone.

    One aggregate that combines on the map side. versions has key, commit_ts, op (put or delete) and the values; with
    rows_only keys that aren't those of rows are left out.
    """
    seen = versions.where(F.col("commit_ts") <= version)
    seen = seen.where(is_record_key(F.col(key))) if rows_only else seen
    last = seen.groupBy(key).agg(F.max_by(F.struct("op", *values), "commit_ts").alias("__v"))
    return last.where("__v.op = 'put'").select(key, *(F.col(f"__v.{v}").alias(v) for v in values))


def resolve_locks(versions: DataFrame, locks: DataFrame, commits: DataFrame, version: int, key: str = "key") -> DataFrame:
    """The versions with the writes behind locks whose transaction turns out to be committed by the version.

    A lock (key, start_ts, primary, op, value) taken before the version may hide a write. Whether it was committed is
    what its primary key says: commits has (primary, start_ts, commit_ts), null for one that was rolled back. Locks
    of transactions that are still open come after the version, as their commit will.
    """
    known = locks.where(F.col("start_ts") <= version).join(commits, ["primary", "start_ts"]).where(F.col("commit_ts") <= version)
    return versions.unionByName(known.select(*versions.columns))


def snapshot_and_feed(versions: DataFrame, locks: DataFrame, commits: DataFrame, feed: DataFrame, options: KeyValueOptions, version: int, resolved: int, table: str = "table_id") -> DataFrame:
    """The changes of a key-value source, as (table, key, op, values, commit_ts): tables at one version, then what was committed after it.

    options choose the tables (table-list less table-list.excluded) and the start: initial reads the snapshot at the
    version as puts and goes on with the feed, snapshot ends there, latest-offset begins after the version, timestamp
    after the option's. versions, locks and commits are as in resolve_locks(); feed has prewrites, commits and
    rollbacks (see twophase.committed) with handle as key, and counts up to resolved. The merge by key of what comes
    out is the tables' state at the resolved time.
    """
    wanted, out = options.table_names, options.excluded_names
    chosen = F.lit(True) if not wanted else F.col(table).isin(wanted)
    chosen = chosen & ~F.col(table).isin(out) if out else chosen
    mode = StartupMode.of(options.startup_mode)
    since = options.startup_timestamp if mode is StartupMode.TIMESTAMP else version
    rows = committed(feed.where(chosen), resolved).where(F.col("commit_ts") > since)
    values = [c for c in rows.columns if c not in (table, "handle", "start_ts", "commit_ts", "op")]
    later = rows.select(table, F.col("handle").alias("key"), "op", *values, "commit_ts")
    if not mode.reads_snapshot:
        return later
    keyed, cols = [versions.where(chosen), locks.where(chosen)], [c for c in versions.columns if c not in (table, "key", "commit_ts", "op")]
    both = F.struct(F.col(table).alias("t"), F.col("key").alias("k"))
    held = at_version(resolve_locks(*(x.withColumn("key", both).drop(table) for x in keyed), commits, version), version, values=(*cols, "commit_ts"))
    snapshot = held.select(F.col("key.t").alias(table), F.col("key.k").alias("key"), F.lit("put").alias("op"), *cols, "commit_ts")
    return snapshot if not mode.reads_log else snapshot.unionByName(later)


def common_version(finished: DataFrame, position: str = "position") -> DataFrame:
    """(version): all tables are read at the same version, at which their log begins."""
    return finished.agg(F.max(position).alias("version"))


def pages(scan: Callable[[bytes, int], list[tuple[bytes, object]]], start: bytes, end: bytes, size: int) -> Iterator[list[tuple[bytes, object]]]:
    """Pages of a scan from start to end, each from after the last key of the one before; a short page is the last."""
    at = start
    while True:
        page = [(k, v) for k, v in scan(at, size) if k < end]
        if page:
            yield page
        if len(page) < size:
            return
        at = page[-1][0] + b"\0"
