"""A change log in a folder of JSON-lines files, as a Python data source for batches and streams, with the snapshot before it.

Files are read in the order of their names. A record's position is its file and the byte behind its line, where the
next one begins. Each line is an envelope: op, key, before, after, source (db, table, ts_ms, gtid, event, row) and
ts_ms, or a heartbeat or a schema change.
"""

from __future__ import annotations

import json
from bisect import bisect_right

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition

from tideline.options import OptionError, SourceOptions, StartupMode
from tideline.plans.offsets import GtidSet, LogPurged, check_available
from tideline.sources.folders import Folder, Piece, batches, pieces

SCHEMA = "file string, pos bigint, kind string, op string, table_id string, key string, before string, after string, ts_ms bigint, ddl string, gtid string"


def _arrow_schema():
    import pyarrow as pa

    kinds = {"string": pa.string(), "bigint": pa.int64()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in SCHEMA.split(", "))])


def _text(x):
    return None if x is None else json.dumps(x, sort_keys=True, default=str)


def parse_line(file: str, pos: int, line: bytes | str) -> tuple[tuple, dict]:
    """(row, source) of a line."""
    try:
        e = json.loads(line)
    except ValueError as error:
        raise ValueError(f"{file}, up to byte {pos}: not JSON") from error
    kind = e.get("kind") or ("schema" if e.get("ddl") else "data")
    source = e.get("source") or {}
    table = e.get("table_id") or (f"{source['db']}.{source['table']}" if "table" in source else None)
    return (file, pos, kind, e.get("op"), table, _text(e.get("key")), _text(e.get("before")), _text(e.get("after")), source.get("ts_ms", e.get("ts_ms")), e.get("ddl"), source.get("gtid")), source


class SnapshotPiece(InputPartition):
    """A row group of a file of the snapshot."""

    def __init__(self, file: str, group: int):
        super().__init__(file)
        self.file, self.group = file, group


class JsonLogSource(DataSource):
    """spark.read or spark.readStream .format("jsonlog").option("path", folder), or in SQL CREATE TEMPORARY VIEW ... USING jsonlog OPTIONS (path ...).

    Options: those of SourceOptions on startup, whose mode is earliest-offset where it isn't given; file-pattern, which
    files are the log's; end-file and end-pos, up to which a batch reads; and for the modes initial and snapshot
    snapshot.path, a folder of Parquet files with the table's rows, snapshot.key, its key columns, snapshot.table, and
    snapshot.file and snapshot.pos, where the log stood when it was taken. Rows of a snapshot are read records (op r) at
    that position; the log follows from there, which makes both together exact by the merge by key.

    A start by transaction ids (specific-offset.gtid-set) leaves out the records of those transactions, and fails if
    others are purged (log.purged-gtids). A start by file and position leaves out skip-events events, and of the next
    skip-rows rows, of the transaction that goes on there. A start by timestamp finds the file by its first time, and
    leaves out earlier data records, by whole seconds. A mode that can't be had raises OptionError.
    """

    @classmethod
    def name(cls) -> str:
        return "jsonlog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return JsonLogReader(self)

    def streamReader(self, schema):  # noqa: N802
        return JsonLogStream(self)

    @property
    def log(self) -> Folder:
        if "path" not in self.options:
            raise OptionError("option 'path' is required")
        return Folder(self.options["path"], self.options.get("file-pattern", r"[^._].*\.jsonl"))

    @property
    def startup(self) -> SourceOptions:
        given = {k: v for k, v in self.options.items() if k.startswith("scan.startup")}
        return SourceOptions.read({"scan.startup.mode": "earliest-offset"} | given)

    def start(self) -> dict:
        """The offset at which reading begins: snapshot (0 before, 1 after, absent without), file and pos."""
        options, files = self.startup, list(self.log.sizes())
        if options.mode.reads_snapshot:
            if "snapshot.path" not in self.options:
                raise OptionError(f"startup mode {options.mode.value} reads a snapshot first: give snapshot.path, or start from the log")
            return {"snapshot": 0, "file": self.options.get("snapshot.file", files[0] if files else ""), "pos": int(self.options.get("snapshot.pos", 0))}
        if options.mode is StartupMode.LATEST:
            return self.end()
        if options.mode is StartupMode.SPECIFIC and options.startup_file is not None and not options.startup_gtids:
            if options.startup_file not in files:
                raise LogPurged(f"the log has no file {options.startup_file} any more; it has {', '.join(files) or 'none'}")
            return {"file": options.startup_file, "pos": options.startup_pos}
        if options.startup_gtids:
            from tideline.plans.offsets import Offset

            check_available(Offset(gtids=options.startup_gtids), files, self.options.get("log.gtids", options.startup_gtids), self.options.get("log.purged-gtids", ""))
        if options.mode is StartupMode.TIMESTAMP:
            first = bisect_right(files, options.startup_timestamp // 1000, key=lambda f: self._first_second(f))
            return {"file": files[max(0, first - 1)] if files else "", "pos": 0}
        return {"file": files[0] if files else "", "pos": 0}

    def _first_second(self, file: str) -> float:
        """Of a file's first record with a time; files are looked up by halves, so that few of them are opened."""
        log = self.log
        for at, line in log.lines(file, 0, log.sizes()[file]):
            t = parse_line(file, at, line)[0][8] if line.strip() else None
            if t is not None:
                return t // 1000
        return float("inf")

    def end(self) -> dict:
        if "end-file" in self.options:
            return {"file": self.options["end-file"], "pos": int(self.options.get("end-pos", 0))}
        log = self.log
        sizes = log.sizes()
        last = next(reversed(sizes), "")
        return {"file": last, "pos": log.whole(last, sizes[last]) if last else 0}

    def latest(self) -> dict:
        mode = self.startup.mode
        if not mode.reads_snapshot:
            return self.end()
        return {"snapshot": 1} | (self.end() if mode.reads_log else {k: v for k, v in self.start().items() if k != "snapshot"})

    def parts(self, start: dict, end: dict) -> list[InputPartition]:
        """Row groups of the snapshot, if it isn't read yet, and pieces of the files between two offsets."""
        first, last = start["file"].lower(), end["file"].lower()
        ends = {f: (end["pos"] if f.lower() == last else n) for f, n in self.log.sizes().items() if first <= f.lower() <= last}
        log = pieces({f: start["pos"] for f in ends if f.lower() == first}, ends)
        return (self.snapshot_parts() if start.get("snapshot") == 0 and end.get("snapshot", 1) == 1 else []) + log

    # --- the snapshot ---

    @property
    def snapshot(self) -> Folder:
        return Folder(self.options["snapshot.path"], r"[^._].*\.parquet")

    def snapshot_parts(self) -> list[InputPartition]:
        import pyarrow.parquet as pq

        folder, out = self.snapshot, []
        for name in folder.sizes():
            with folder.open(name) as f:
                out += [SnapshotPiece(name, i) for i in range(pq.ParquetFile(f).num_row_groups)]
        return out

    def snapshot_rows(self, part: SnapshotPiece):
        import pyarrow.parquet as pq

        keys, at = [k.strip() for k in self.options["snapshot.key"].split(",")], self.start()
        table = self.options.get("snapshot.table")
        with self.snapshot.open(part.file) as f:
            for batch in pq.ParquetFile(f).iter_batches(1024, row_groups=[part.group]):
                for row in batch.to_pylist():
                    yield at["file"], at["pos"], "data", "r", table, _text({k: row[k] for k in keys}), None, _text(row), 0, None, None

    # --- the log ---

    def log_rows(self, part: Piece):
        options = self.startup
        gtids = GtidSet.parse(options.startup_gtids) if options.startup_gtids else None
        since = options.startup_timestamp // 1000 * 1000 if options.mode is StartupMode.TIMESTAMP else None
        going_on = self._transaction_at(options) if options.startup_skip_events or options.startup_skip_rows else None
        for pos, line in self.log.lines(part.file, part.start, part.end):
            if not line.strip():
                continue
            row, source = parse_line(part.file, pos, line)
            if since is not None and row[2] == "data" and (row[8] or 0) < since:
                continue
            if gtids and row[10] and GtidSet.parse(row[10]).within(gtids):
                continue
            if going_on and row[10] == going_on[0] and part.file == options.startup_file:
                event, number, skip = source.get("event", 1), source.get("row", 0), options.startup_skip_events
                if event <= skip or event == skip + 1 and number < options.startup_skip_rows:
                    continue
            yield row

    def _transaction_at(self, options: SourceOptions) -> tuple[str | None] | None:
        """The transaction id of the first data record from the start on, in a tuple: its events and rows are those that are skipped."""
        for pos, line in self.log.lines(options.startup_file, options.startup_pos, self.log.sizes()[options.startup_file]):
            row = parse_line(options.startup_file, pos, line)[0] if line.strip() else None
            if row and row[2] == "data":
                return (row[10],)
        return None


class JsonLogReader(DataSourceReader):
    """A bounded read. Tests on op, kind, table_id and pos are pushed down."""

    COLUMNS = {"kind": 2, "op": 3, "table_id": 4, "pos": 1}

    def __init__(self, source: JsonLogSource):
        self.source, self.tests = source, []

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            i = self.COLUMNS.get(f.attribute[0]) if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if i is not None and isinstance(f, EqualTo):
                self.tests.append(lambda row, i=i, v=f.value: row[i] == v)
            elif i == 1 and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                least = f.value + isinstance(f, GreaterThan)
                self.tests.append(lambda row, least=least: row[1] >= least)
            else:
                yield f

    def partitions(self):
        return self.source.parts(self.source.start(), self.source.latest())

    def read(self, partition):
        if partition is None:
            return
        rows = self.source.snapshot_rows(partition) if isinstance(partition, SnapshotPiece) else self.source.log_rows(partition)
        yield from batches((row for row in rows if all(t(row) for t in self.tests)), _arrow_schema())


class JsonLogStream(DataSourceStreamReader):
    """A stream of the log, after its snapshot where there is one; heartbeats move the offset without giving rows."""

    def __init__(self, source: JsonLogSource):
        self.source = source

    def initialOffset(self):  # noqa: N802
        return self.source.start()

    def latestOffset(self):  # noqa: N802
        return self.source.latest()

    def partitions(self, start, end):
        return self.source.parts(start, end)

    def read(self, partition):
        rows = self.source.snapshot_rows(partition) if isinstance(partition, SnapshotPiece) else self.source.log_rows(partition)
        yield from batches((row for row in rows if row[2] != "heartbeat"), _arrow_schema())

    def commit(self, end):
        """Nothing to do: the log keeps its files."""


def register(spark: SparkSession) -> None:
    spark.dataSource.register(JsonLogSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def check_manifest(manifest: dict) -> None:
    """What a log must be to be read: a version from 5.6 on, whole row images in row format, and a clock near the reader's.

    manifest: version, format, row_image, value_options and offset_minutes (of the server's zone from the configured one).
    """
    from tideline.functions.convert import version_key

    if version_key(manifest["version"]) < (5, 6, 0):
        raise OptionError(f"version {manifest['version']} is older than 5.6")
    for name, want in (("format", "ROW"), ("row_image", "FULL"), ("value_options", "")):
        if manifest.get(name, want).upper() != want:
            raise OptionError(f"the log's {name} must be {want or 'empty'}, not {manifest[name]}")
    if abs(manifest.get("offset_minutes", 0)) > 30:
        raise OptionError(f"the server's time zone is {manifest['offset_minutes']} minutes from the configured one")
