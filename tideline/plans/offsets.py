"""Log offsets: their total order, transaction-id sets, startup and availability."""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass
from enum import Enum
from functools import cmp_to_key

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Kind(Enum):
    EARLIEST = "EARLIEST"
    LATEST = "LATEST"
    TIMESTAMP = "TIMESTAMP"
    SPECIFIC = "SPECIFIC"
    NON_STOPPING = "NON_STOPPING"


class GtidSet:
    """Transaction ids: for each server's uuid, disjoint intervals of numbers, ends included."""

    def __init__(self, intervals: dict[str, list[tuple[int, int]]] | None = None):
        self.of = {u: joined for u, i in (intervals or {}).items() if (joined := self._join(i))}

    @staticmethod
    def _join(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for low, high in sorted(intervals):
            if out and low <= out[-1][1] + 1:
                out[-1] = (out[-1][0], max(out[-1][1], high))
            else:
                out.append((low, high))
        return out

    @classmethod
    def parse(cls, text: str | None) -> GtidSet:
        of: dict[str, list[tuple[int, int]]] = {}
        for part in re.sub(r"\s", "", text or "").split(","):
            if part:
                uuid, _, ranges = part.partition(":")
                for r in ranges.split(":"):
                    low, _, high = r.partition("-")
                    of.setdefault(uuid.lower(), []).append((int(low), int(high or low)))
        return cls(of)

    def __str__(self) -> str:
        return ",".join(f"{u}:" + ":".join(f"{a}-{b}" if b > a else f"{a}" for a, b in i) for u, i in sorted(self.of.items()))

    def __eq__(self, other) -> bool:
        return isinstance(other, GtidSet) and self.of == other.of

    def __hash__(self) -> int:
        return hash(str(self))

    def within(self, other: GtidSet) -> bool:
        """Whether each of these ids is in the other set."""
        return all(any(c <= a and b <= d for c, d in other.of.get(u, [])) for u, i in self.of.items() for a, b in i)

    def minus(self, other: GtidSet) -> GtidSet:
        out: dict[str, list[tuple[int, int]]] = {}
        for u, intervals in self.of.items():
            rest = intervals
            for c, d in other.of.get(u, []):
                rest = [x for a, b in rest for x in ((a, min(b, c - 1)), (max(a, d + 1), b)) if x[0] <= x[1]]
            out[u] = rest
        return GtidSet(out)

    def plus(self, other: GtidSet) -> GtidSet:
        return GtidSet({u: self.of.get(u, []) + other.of.get(u, []) for u in {*self.of, *other.of}})

    def merged_into(self, base: GtidSet) -> GtidSet:
        """Of servers that both have, these intervals; of others, whoever has them."""
        return GtidSet(base.of | self.of)

    def fixed_to(self, server: GtidSet) -> GtidSet:
        """A restored set against what a server has: per server, the gaps before the restored end are filled with what the server has done up to there."""
        out: dict[str, list[tuple[int, int]]] = {}
        for u, intervals in self.of.items():
            end = intervals[-1][1]
            out[u] = intervals + [(a, min(b, end)) for a, b in server.of.get(u, []) if a <= end]
        return GtidSet(out)

    def where(self, keep) -> GtidSet:
        return GtidSet({u: i for u, i in self.of.items() if keep(u)})


def start_gtids(restored: GtidSet, available: GtidSet, purged: GtidSet, keep=lambda uuid: True) -> GtidSet:
    """What a reader asks for: its own ids of the servers it wants, and of servers new to it what is purged already."""
    own = restored.where(keep)
    new = available.where(lambda u: keep(u) and u not in own.of)
    return own.plus(purged.where(lambda u: u in new.of))


@dataclass(frozen=True)
class Offset:
    """A place in the log. Without GTIDs: file and position, events to skip after it and rows of the next."""

    file: str = ""
    pos: int = 0
    event: int = 0
    row: int = 0
    gtids: str = ""
    ts_sec: int = 0
    server_id: int = 0
    kind: str = Kind.SPECIFIC.value

    def compare(self, that: Offset) -> int:
        """Negative, zero or positive, as this offset is before, at or after that one."""
        ends = [x.kind == Kind.NON_STOPPING.value for x in (self, that)]
        if any(ends):
            return ends[0] - ends[1]
        if that.gtids:
            if not self.gtids:
                return -1
            mine, its = GtidSet.parse(self.gtids), GtidSet.parse(that.gtids)
            if mine == its:
                return self.event - that.event
            return -1 if mine.within(its) else 1
        if self.gtids:
            return 1
        if self.server_id and that.server_id and self.server_id != that.server_id:
            return self.ts_sec - that.ts_sec
        a, b = ((x.file.lower(), x.pos, x.event, x.row) for x in (self, that))
        return (a > b) - (a < b)

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> Offset:
        return cls(**json.loads(text))


ordering = cmp_to_key(Offset.compare)
EARLIEST, LATEST, NON_STOPPING = Offset(kind="EARLIEST"), Offset(kind="LATEST"), Offset(kind="NON_STOPPING")


def at_timestamp(millis: int) -> Offset:
    """Timestamps of a log are whole seconds."""
    return Offset(ts_sec=millis // 1000, kind=Kind.TIMESTAMP.value)


def order_key(file: Column, pos: Column, event: Column, row: Column) -> Column:
    """A column that sorts and compares as file-and-position offsets of one server do."""
    return F.struct(F.lower(file).alias("file"), pos.alias("pos"), event.alias("event"), row.alias("row"))


def file_for_timestamp(manifest: DataFrame, seconds: Column, file: str = "file", first_ts: str = "first_ts") -> DataFrame:
    """(file, pos): the last file whose first event isn't after the time, or the first file where all are; position 0."""
    found = manifest.agg(F.max_by(file, F.when(F.col(first_ts) <= seconds, F.struct(first_ts, file))).alias("f"), F.min_by(file, F.struct(first_ts, file)).alias("first"), F.count_if(F.col(first_ts) <= seconds).alias("n"))
    return found.select(F.when(F.col("n") > 0, F.col("f")).otherwise(F.col("first")).alias("file"), F.lit(0).cast("long").alias("pos"))


class LogPurged(RuntimeError):
    """The log no longer holds the place to start from."""


def resolve(offset: Offset, manifest: list[dict]) -> Offset:
    """The offset at which reading begins, given the log's files in order, each with `file`, `first_ts` (seconds) and `end`."""
    if offset.kind == Kind.EARLIEST.value:
        return Offset(file=manifest[0]["file"] if manifest else "")
    if offset.kind == Kind.LATEST.value:
        return Offset(file=manifest[-1]["file"], pos=manifest[-1]["end"]) if manifest else Offset()
    if offset.kind == Kind.TIMESTAMP.value:
        before = [f for f in manifest if f["first_ts"] <= offset.ts_sec]
        return Offset(file=(before[-1] if before else manifest[0])["file"], ts_sec=offset.ts_sec) if manifest else Offset()
    return offset


def check_available(offset: Offset, files: list[str], available: str = "", purged: str = "") -> None:
    """Raises LogPurged where reading can't begin at the offset. An offset that names nothing is fine."""
    if offset.gtids:
        mine = GtidSet.parse(offset.gtids)
        if not mine.within(GtidSet.parse(available)):
            raise LogPurged(f"the log lacks transactions of {offset.gtids}")
        lost = GtidSet.parse(purged).minus(mine)
        if lost.of:
            raise LogPurged(f"transactions {lost} that were not read are purged")
    elif offset.file and offset.file.lower() not in {f.lower() for f in files}:
        raise LogPurged(f"the log has no file {offset.file} any more; it has {', '.join(files) or 'none'}")
