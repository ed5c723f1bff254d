"""The change feed of a key-value store by regions, as a Python data source: files of JSON lines, read by pieces.

Lines are events: ROW (log_type, table_id, handle, start_ts, commit_ts, op, value), RESOLVED (resolved_ts) and ERROR
(message, resolved_ts). Each names its region; without a name it is that of its file, up to the first dot. RESOLVED
events come as rows too, of log_type RESOLVED: what reads the feed takes each region's largest, and of them the
smallest (operators.twophase.resolved_over, streaming.state.CommitSink).
"""

from __future__ import annotations

import json

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader

from tideline.operators.twophase import TYPES
from tideline.sources.folders import Folder, Piece, batches, pieces

SCHEMA = "region string, table_id bigint, handle bigint, start_ts bigint, log_type string, commit_ts bigint, op string, value string, resolved_ts bigint"


class RegionError(RuntimeError):
    """A region failed, and its feed hasn't been taken up again."""


def _arrow_schema():
    import pyarrow as pa

    kinds = {"string": pa.string(), "bigint": pa.int64()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in SCHEMA.split(", "))])


class KvFeed(DataSource):
    """spark.read or spark.readStream .format("kvfeed").option("path", folder).

    Options: tables, a comma list of ids; ranges, a comma list of handles low-high, ends included, by which rows are
    kept; file-pattern; errors. A region that fails (ERROR) is read again by its server from the resolved time that
    the error names: with errors=resume, the default, the feed goes on, and what is delivered once more is told by its
    times (see CommitSink); with fail the read raises RegionError; with skip errors are passed over without a mark.
    """

    @classmethod
    def name(cls) -> str:
        return "kvfeed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return FeedReader(self)

    def streamReader(self, schema):  # noqa: N802
        return FeedStream(self)

    @property
    def folder(self) -> Folder:
        return Folder(self.options["path"], self.options.get("file-pattern", r"[^._].*\.jsonl"))

    def ends(self) -> dict[str, int]:
        """Of each file the byte behind its last whole line."""
        folder = self.folder
        return {f: folder.whole(f, n) for f, n in folder.sizes().items()}

    def rows(self, part: Piece):
        tables = {int(t) for t in self.options.get("tables", "").split(",") if t.strip()}
        ranges = [tuple(int(x) for x in r.split("-")) for r in self.options.get("ranges", "").split(",") if r.strip()]
        errors = self.options.get("errors", "resume")
        for _, line in self.folder.lines(part.file, part.start, part.end):
            if not line.strip():
                continue
            e = json.loads(line)
            region = str(e.get("region", part.file.partition(".")[0]))
            if e["kind"] == "ERROR":
                if errors == "fail":
                    raise RegionError(f"{region}: {e.get('message', 'region error')}")
                if errors == "resume":
                    yield region, None, None, None, "ERROR", None, None, e.get("message"), e.get("resolved_ts")
            elif e["kind"] == "RESOLVED":
                yield region, None, None, None, "RESOLVED", None, None, None, e["resolved_ts"]
            elif e["kind"] == "ROW" and e.get("log_type") in TYPES and (not tables or e["table_id"] in tables) and (not ranges or any(a <= e["handle"] <= b for a, b in ranges)):
                yield region, e["table_id"], e["handle"], e["start_ts"], e["log_type"], e.get("commit_ts"), e.get("op"), e.get("value"), None


class FeedReader(DataSourceReader):
    def __init__(self, source: KvFeed):
        self.source = source

    def partitions(self):
        return pieces({}, self.source.ends())

    def read(self, partition):
        yield from batches(self.source.rows(partition), _arrow_schema()) if partition is not None else ()


class FeedStream(DataSourceStreamReader):
    """An offset is the bytes read of each file."""

    def __init__(self, source: KvFeed):
        self.source = source

    def initialOffset(self):  # noqa: N802
        return {}

    def latestOffset(self):  # noqa: N802
        return self.source.ends()

    def partitions(self, start, end):
        return pieces(start, end)

    def read(self, partition):
        yield from batches(self.source.rows(partition), _arrow_schema())

    def commit(self, end):
        """The feed keeps its files."""
