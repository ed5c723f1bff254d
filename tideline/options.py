"""Options of sources, sinks and pipelines, with their defaults and checks.

Fixed values: the keys below, and their defaults, are the public names that jobs are configured by.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields
from enum import Enum


class OptionError(ValueError):
    """An option is missing, malformed or out of range."""


class StartupMode(Enum):
    """Where a source starts."""

    INITIAL = "initial"
    SNAPSHOT = "snapshot"
    EARLIEST = "earliest-offset"
    LATEST = "latest-offset"
    SPECIFIC = "specific-offset"
    TIMESTAMP = "timestamp"

    @classmethod
    def of(cls, text: str) -> StartupMode:
        for mode in cls:
            if mode.value == text.lower():
                return mode
        raise OptionError(f"unknown startup mode {text!r}; one of {', '.join(m.value for m in cls)}")

    @property
    def reads_snapshot(self) -> bool:
        return self in (StartupMode.INITIAL, StartupMode.SNAPSHOT)

    @property
    def reads_log(self) -> bool:
        return self is not StartupMode.SNAPSHOT


@dataclass(frozen=True)
class ServerIds:
    """A range of server ids, `a` or `a-b`; reader k of a job gets the k-th."""

    first: int
    last: int

    @classmethod
    def parse(cls, text: str) -> ServerIds:
        m = re.fullmatch(r"\s*(\d+)\s*(?:-\s*(\d+)\s*)?", text)
        if not m:
            raise OptionError(f"a server id is a number or a range like 5400-5408, not {text!r}")
        first, last = int(m[1]), int(m[2] or m[1])
        if last < first:
            raise OptionError(f"the server id range {text!r} ends before it begins")
        return cls(first, last)

    def of(self, reader: int) -> int:
        if reader < 0 or self.first + reader > self.last:
            raise OptionError(f"{self.last - self.first + 1} server ids are too few for reader {reader}")
        return self.first + reader


def _number(text: str) -> float:
    """Durations: a number with ms, s, min, h or d; milliseconds without a unit."""
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*(ms|s|min|h|d)?\s*", str(text))
    if not m:
        raise OptionError(f"not a duration: {text!r}")
    return float(m[1]) * {None: 0.001, "ms": 0.001, "s": 1, "min": 60, "h": 3600, "d": 86400}[m[2]]


def key(name: str, default=None, **checks):
    return field(default=default, metadata={"key": name, **checks})


SECRETS = ("password", "token", "secret")


@dataclass(frozen=True)
class Options:
    """Options read from a map of strings by their keys; unknown keys go to `extra`."""

    extra: tuple[tuple[str, str], ...] = ()

    @classmethod
    def read(cls, given: dict[str, str]) -> Options:
        known = {f.metadata["key"]: f for f in fields(cls) if "key" in f.metadata}
        low = {k.lower(): v for k, v in given.items()}
        values = {}
        for name, f in known.items():
            if name in low:
                values[f.name] = cls._convert(f, low.pop(name))
            elif f.metadata.get("required"):
                raise OptionError(f"option {name!r} is required")
        return cls(extra=tuple(sorted(low.items())), **values).checked()

    @staticmethod
    def _convert(f, text):
        kind = f.metadata.get("kind") or (type(f.default) if f.default is not None else str)
        try:
            if kind is bool and not isinstance(text, bool):
                return {"true": True, "false": False}[text.strip().lower()]
            return _number(text) if kind == "duration" else kind(text)
        except (KeyError, ValueError) as e:
            raise OptionError(f"option {f.metadata['key']!r} can't be {text!r}") from e

    def checked(self) -> Options:
        for f in fields(self):
            value, name = getattr(self, f.name), f.metadata.get("key")
            if value is None or not name:
                continue
            above, least, most = (f.metadata.get(k) for k in ("above", "least", "most"))
            if above is not None and not value > above:
                raise OptionError(f"option {name!r} must be larger than {above}, not {value}")
            if least is not None and value < least or most is not None and value > most:
                raise OptionError(f"option {name!r} must be from {least} to {most if most is not None else 'any number'}, not {value}")
            if f.metadata.get("regex"):
                for part in re.split(r"(?<!\\),", value):
                    try:
                        re.compile(part.strip())
                    except re.error as e:
                        raise OptionError(f"option {name!r} holds the bad pattern {part!r}") from e
        return self

    def shown(self) -> dict[str, str]:
        """For logs: every option, secrets masked."""
        out = {f.metadata["key"]: getattr(self, f.name) for f in fields(self) if "key" in f.metadata}
        out |= dict(self.extra)
        return {k: "***" if any(s in k.lower() for s in SECRETS) and v else str(v) for k, v in out.items()}


@dataclass(frozen=True)
class SourceOptions(Options):
    """Of a source of keyed tables with a change log."""

    hostname: str | None = key("hostname")
    port: int = key("port", 3306, least=1, most=65535)
    username: str | None = key("username")
    password: str | None = key("password")
    database: str | None = key("database-name", regex=True)
    table: str | None = key("table-name", regex=True)
    path: str | None = key("path")
    server_id: str | None = key("server-id")
    time_zone: str | None = key("server-time-zone")
    incremental: bool = key("scan.incremental.snapshot.enabled", True)
    chunk_size: int = key("scan.incremental.snapshot.chunk.size", 8096, above=1)
    chunk_key: str | None = key("scan.incremental.snapshot.chunk.key-column")
    skip_backfill: bool = key("scan.incremental.snapshot.backfill.skip", False)
    fetch_size: int = key("scan.snapshot.fetch.size", 1024, above=1)
    group_size: int = key("chunk-meta.group.size", 1000, above=1)
    upper_factor: float = key("chunk-key.even-distribution.factor.upper-bound", 1000.0, least=1)
    lower_factor: float = key("chunk-key.even-distribution.factor.lower-bound", 0.05, least=0, most=1)
    connect_timeout: float = key("connect.timeout", 30.0, kind="duration", above=0.25)
    connect_retries: int = key("connect.max-retries", 3, above=0)
    pool_size: int = key("connection.pool.size", 20, above=1)
    heartbeat: float = key("heartbeat.interval", 30.0, kind="duration", above=0)
    startup_mode: str = key("scan.startup.mode", "initial")
    startup_file: str | None = key("scan.startup.specific-offset.file")
    startup_pos: int | None = key("scan.startup.specific-offset.pos", kind=int, least=0)
    startup_gtids: str | None = key("scan.startup.specific-offset.gtid-set")
    startup_skip_events: int = key("scan.startup.specific-offset.skip-events", 0, least=0)
    startup_skip_rows: int = key("scan.startup.specific-offset.skip-rows", 0, least=0)
    startup_timestamp: int | None = key("scan.startup.timestamp-millis", kind=int, least=0)
    new_tables: bool = key("scan.newly-added-table.enabled", False)
    schema_changes: bool = key("include.schema.changes", False)
    close_idle: bool = key("scan.incremental.close-idle-reader.enabled", False)
    unknown_table: str = key("on.unknown.table", "fail")

    def checked(self) -> SourceOptions:
        super().checked()
        mode = self.mode
        if mode is StartupMode.SPECIFIC:
            if not self.startup_gtids and (self.startup_file is None or self.startup_pos is None):
                raise OptionError("startup at a specific offset takes a file and a position, or a set of transaction ids")
        elif mode is StartupMode.TIMESTAMP and self.startup_timestamp is None:
            raise OptionError("startup at a timestamp takes scan.startup.timestamp-millis")
        if self.unknown_table not in ("fail", "warn", "skip"):
            raise OptionError("on.unknown.table is fail, warn or skip")
        if self.server_id:
            ServerIds.parse(self.server_id)
        return self

    @property
    def mode(self) -> StartupMode:
        return StartupMode.of(self.startup_mode)

    @property
    def log_properties(self) -> dict[str, str]:
        """What is passed through to the log reader: keys below `debezium.`, without it; they win over defaults."""
        defaults = {"bigint.unsigned.handling.mode": "precise", "heartbeat.interval.ms": str(int(self.heartbeat * 1000)), "include.schema.changes": "true"}
        return defaults | {k.removeprefix("debezium."): v for k, v in self.extra if k.startswith("debezium.")}

    def check_key(self, columns: list[str], primary_key: list[str]) -> str | None:
        """The chunk key: the option's column, which must exist, else the first of the primary key; parallel snapshots need one."""
        if self.chunk_key:
            if self.chunk_key not in columns:
                raise OptionError(f"the chunk key {self.chunk_key!r} is no column of the table")
            return self.chunk_key
        if primary_key:
            return primary_key[0]
        if self.incremental and self.mode.reads_snapshot:
            raise OptionError("a table without a primary key takes scan.incremental.snapshot.chunk.key-column")
        return None


@dataclass(frozen=True)
class KeyValueOptions(Options):
    """Of a source over a transactional key-value store."""

    addresses: str | None = key("pd-addresses", required=True)
    database: str | None = key("database-name", regex=True)
    tables: str | None = key("table-list")
    excluded: str = key("table-list.excluded", "")
    startup_mode: str = key("scan.startup.mode", "initial")
    startup_timestamp: int = key("scan.startup.timestamp-millis", 0, least=0)
    parallelism: int = key("scan.parallelism", 1, above=0)

    @property
    def table_names(self) -> list[str]:
        return [t.strip() for t in (self.tables or "").split(",") if t.strip()]

    @property
    def excluded_names(self) -> list[str]:
        return [t.strip() for t in self.excluded.split(",") if t.strip()]


@dataclass(frozen=True)
class SinkOptions(Options):
    """Of the upserting sink. Options of databases (hosts, drivers, pools, loaders) go to `extra`: there is no such sink."""

    path: str | None = key("sink.data.save.directory", required=True)
    keys: str | None = key("primary-key", required=True)
    parallelism: int = key("sink.parallelism", 1, above=0)
    flush_interval: int = key("sink.snapshot.flush.interval.seconds", 5, above=0)
    delete_allowed: bool = key("sink.operator.delete.allowed", True)
    delete_excluded: str = key("sink.operator.delete.excluded-tables", "")
    create_schema: bool = key("sink.create.schema.allowed", False)

    @property
    def key_columns(self) -> list[str]:
        return [k.strip() for k in self.keys.split(",") if k.strip()]

    @property
    def excluded_tables(self) -> list[str]:
        return [t.strip() for t in re.split("[,;]", self.delete_excluded) if t.strip()]

    @property
    def trigger(self) -> dict[str, str]:
        """Of a stream that flushes by the interval."""
        return {"processingTime": f"{self.flush_interval} seconds"}


@dataclass(frozen=True)
class PipelineOptions(Options):
    """Of a stream's run (streaming.state.upsert_stream): its name, its tasks after a shuffle, how often it commits."""

    name: str = key("pipeline.name", "tideline")
    parallelism: int = key("pipeline.parallelism", 1, above=0)
    checkpoint_interval: float = key("pipeline.checkpoint.interval", 300.0, kind="duration", above=0)


#: Connectors by name; only those with a source can be read.
CONNECTORS = {"mysql": SourceOptions, "tidb": KeyValueOptions, "oracle": None, "doris": None, "hbase": None}


def connector(name: str) -> type[Options] | None:
    """The options class of a connector, whatever the case of its name; None for those without a source and unknown ones."""
    return CONNECTORS.get(name.lower())
