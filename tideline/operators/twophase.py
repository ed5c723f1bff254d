"""Two-phase commits: prewrites, commits and rollbacks of a feed to committed rows, up to a resolved time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["table_id", "handle", "start_ts"]
TYPES = ("PREWRITE", "COMMIT", "COMMITTED", "ROLLBACK")


def resolved_over(regions: DataFrame) -> DataFrame:
    """(resolved): the time up to which every region is complete: each region's largest, of them the smallest."""
    return regions.groupBy("region").agg(F.max("resolved_ts").alias("r")).agg(F.min("r").alias("resolved"))


def committed(feed: DataFrame, resolved: int | None = None, key: list[str] | None = None) -> DataFrame:
    """Committed rows (commit_ts of the commit, op and values of the prewrite) with commit_ts up to resolved.

    A prewrite waits for the commit of its key: table, handle and start. One that is rolled back gives nothing, even
    if a commit is there. Redelivered records count once, the last value winning; COMMITTED records are whole rows of
    their own. Output order is by commit_ts, table and handle within partitions.
    """
    key = key or KEY
    known = feed.where(F.col("log_type").isin(*TYPES))
    values = [c for c in feed.columns if c not in (*key, "log_type", "commit_ts")]
    pre = known.where("log_type = 'PREWRITE'").groupBy(*key).agg(F.max_by(F.struct(*values), F.struct(*values)).alias("__v"))
    commit = known.where("log_type = 'COMMIT'").groupBy(*key).agg(F.max("commit_ts").alias("commit_ts"))
    undone = known.where("log_type = 'ROLLBACK'").select(*key).distinct()
    joined = pre.join(commit, key).join(undone, key, "left_anti").select(*key, "commit_ts", *(F.col(f"__v.{v}").alias(v) for v in values))
    direct = known.where("log_type = 'COMMITTED'").select(*key, "commit_ts", *values).distinct()
    rows = joined.unionByName(direct)
    rows = rows.where(F.col("commit_ts") <= resolved) if resolved is not None else rows
    return rows.sortWithinPartitions("commit_ts", *key[:2])


def unmatched(feed: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Commits without a prewrite: reported, never rows."""
    key = key or KEY
    pre = feed.where("log_type = 'PREWRITE'").select(*key).distinct()
    return feed.where("log_type = 'COMMIT'").join(pre, key, "left_anti")
