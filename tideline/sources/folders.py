"""Folders of line files that driver and executors read alike: local, or any store that pyarrow opens by its URI."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql.datasource import InputPartition

#: Files are read in pieces of about so many bytes, a task each.
PART_BYTES = 64 << 20
BLOCK = 1 << 20
#: Rows of an Arrow batch.
ROWS = 4096


class Folder:
    def __init__(self, path: str, pattern: str = r"[^._].*\.jsonl"):
        from pyarrow import fs

        self.path, self.pattern = path, re.compile(pattern)
        if re.match(r"\w+:", path):
            self.store, self.root = fs.FileSystem.from_uri(path)
        else:
            self.store, self.root = fs.LocalFileSystem(), path

    def sizes(self) -> dict[str, int]:
        """The files by name, in order, with their sizes."""
        from pyarrow import fs

        found = self.store.get_file_info(fs.FileSelector(self.root))
        return {i.base_name: i.size for i in sorted(found, key=lambda i: (i.base_name.lower(), i.base_name)) if i.is_file and self.pattern.fullmatch(i.base_name)}

    def open(self, name: str):
        return self.store.open_input_file(f"{self.root.rstrip('/')}/{name}")

    def whole(self, name: str, size: int) -> int:
        """The byte behind the last whole line: what a writer hasn't ended is left for later. Reads the file's end only."""
        with self.open(name) as f:
            end = size
            while end > 0:
                start = max(0, end - BLOCK)
                at = f.read_at(end - start, start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                end = start
        return 0

    def lines(self, name: str, start: int, end: int) -> Iterator[tuple[int, bytes]]:
        """(byte behind the line, line) of the lines that begin in [start, end). A start within a line begins with the next."""
        with self.open(name) as f:
            at = start
            if start > 0 and f.read_at(1, start - 1) != b"\n":
                at = self._after_line(f, start)
            rest = b""
            while at < end:
                block = f.read_at(BLOCK, at + len(rest))
                if not block:
                    return
                *lines, rest = (rest + block).split(b"\n")
                for line in lines:
                    if at >= end:
                        return
                    at += len(line) + 1
                    yield at, line

    @staticmethod
    def _after_line(f, start: int) -> int:
        while block := f.read_at(BLOCK, start):
            at = block.find(b"\n")
            if at >= 0:
                return start + at + 1
            start += len(block)
        return start


class Piece(InputPartition):
    """Lines of a file that begin in [start, end)."""

    def __init__(self, file: str, start: int, end: int):
        super().__init__(file)
        self.file, self.start, self.end = file, start, end


def pieces(start: dict[str, int], end: dict[str, int], size: int = PART_BYTES) -> list[Piece]:
    """What lies between two maps from file to byte."""
    return [Piece(f, at, min(at + size, n)) for f, n in end.items() for at in range(start.get(f, 0), n, size)]


def batches(rows: Iterator[tuple], schema) -> Iterator:
    """Rows as Arrow batches of a schema."""
    import pyarrow as pa

    held: list[tuple] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= ROWS:
            yield batch()
            held = []
    if held:
        yield batch()
