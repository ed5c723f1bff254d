"""What a job is doing about its tables: snapshots first, then the log, then new tables beside it."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from enum import Enum


class Status(Enum):
    INITIAL_ASSIGNING = 0
    INITIAL_FINISHED = 1
    NEWLY_ADDED_ASSIGNING = 2
    NEWLY_ADDED_SNAPSHOT_FINISHED = 3
    NEWLY_ADDED_FINISHED = 4


class Event(Enum):
    SNAPSHOT_FINISHED = "snapshot finished"
    TABLES_ADDED = "tables added"
    LOG_UPDATED = "log updated"


STEPS = {
    (Status.INITIAL_ASSIGNING, Event.SNAPSHOT_FINISHED): Status.INITIAL_FINISHED,
    (Status.INITIAL_FINISHED, Event.TABLES_ADDED): Status.NEWLY_ADDED_ASSIGNING,
    (Status.NEWLY_ADDED_ASSIGNING, Event.SNAPSHOT_FINISHED): Status.NEWLY_ADDED_SNAPSHOT_FINISHED,
    (Status.NEWLY_ADDED_SNAPSHOT_FINISHED, Event.LOG_UPDATED): Status.NEWLY_ADDED_FINISHED,
    (Status.NEWLY_ADDED_FINISHED, Event.TABLES_ADDED): Status.NEWLY_ADDED_ASSIGNING,
}


def step(status: Status, event: Event) -> Status:
    """The next status; raises ValueError for an event that the status doesn't take."""
    if (status, event) not in STEPS:
        raise ValueError(f"{event.value!r} can't follow in {status.name}")
    return STEPS[status, event]


def reads_snapshot(status: Status) -> bool:
    return status in (Status.INITIAL_ASSIGNING, Status.NEWLY_ADDED_ASSIGNING)


def log_may_run(status: Status, parallelism: int, committed: bool) -> bool:
    """The log is read once all chunks are finished and, with more than one reader, their rows are committed."""
    return not reads_snapshot(status) and (parallelism == 1 or committed)


VERSION = 3


@dataclass
class Control:
    """A job's control document: what it must know to go on after a restart."""

    status: str = Status.INITIAL_ASSIGNING.name
    tables: list[str] = field(default_factory=list)
    chunks: list[dict] = field(default_factory=list)  # table_id, chunk_no, lo, hi, low_wm, high_wm (null: not read yet)
    cursor: dict | None = None  # of a table whose uneven chunks are still being cut: table_id, next lo, next number
    offset: dict | None = None
    schemas: dict[str, list[str]] = field(default_factory=dict)
    committed: bool = False

    def to_json(self) -> str:
        return json.dumps({"version": VERSION} | asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> Control:
        """Also reads the documents of earlier versions: 1 had chunks without low_wm, 2 no cursor and no schemas."""
        doc = json.loads(text)
        version = doc.pop("version", 1)
        if version > VERSION:
            raise ValueError(f"control document of version {version}, which is newer than {VERSION}")
        if version == 1:
            doc["chunks"] = [{"low_wm": c.get("high_wm")} | c for c in doc.get("chunks", [])]
        return cls(**{k: v for k, v in doc.items() if k in cls.__dataclass_fields__})

    def finished(self) -> bool:
        return all(c["high_wm"] is not None for c in self.chunks)

    def add_schema(self, table: str, ddl: str) -> int:
        """Registers a table's new schema; returns its version, from 1. A stream goes on with the one it began with until it is restarted."""
        versions = self.schemas.setdefault(table, [])
        if not versions or versions[-1] != ddl:
            versions.append(ddl)
        return len(versions)

    def back(self, chunk: int, table: str) -> None:
        """A chunk whose reader failed is to be read again."""
        for c in self.chunks:
            if c["table_id"] == table and c["chunk_no"] == chunk:
                c["low_wm"] = c["high_wm"] = None
