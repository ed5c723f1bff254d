"""WARC: archives of pages written in parallel, and a Python data source that reads them."""

from __future__ import annotations

import hashlib
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith

from tideline.llm._shared import cut, map_batches, shared_folder

#: Equal payloads of at least so many bytes are stored once.
MIN_REVISIT = 1000
#: Files are packed into partitions of about so many bytes.
PARTITION_BYTES = 32 << 20
#: Records of a batch hold about so many bytes of payload.
BATCH_BYTES = 8 << 20
LEVEL = 1


# --- records ---


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(urn: str) -> int | None:
    tail = urn.rpartition(":")[2].rstrip(">")
    return int(tail) if tail.lstrip("-").isdigit() else None


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record with the payload in an HTTP message, or a revisit record with its headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    length = len(http) + (0 if revisit else len(payload))
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {quote(url or 'urn:none', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http + (b"" if revisit else payload) + b"\r\n\r\n"


def pack(record: bytes) -> bytes:
    """A gzip member of one record; the extra field 'sl' has its size, packed and plain, so that readers can step over it."""
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    extra = b"sl" + struct.pack("<H", 8) + struct.pack("<II", 24 + len(body) + 8, len(record) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


class FileBytes:
    """A file's bytes by slices, of which one block is held: a reader that steps over payloads doesn't read them all."""

    def __init__(self, file, block: int = 1 << 20):
        self.file, self.size, self.block, self.start, self.held = file, file.size(), block, 0, b""

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, key):
        if isinstance(key, int):
            return self[key : key + 1][0]
        start, stop, _ = key.indices(self.size)
        if not self.start <= start <= stop <= self.start + len(self.held):
            self.start, self.held = start, self.file.read_at(max(self.block, stop - start), start)
        return self.held[start - self.start : max(start, stop) - self.start]


class Members:
    """The gzip members of a file's bytes: (headers, rest) of each record, where rest() inflates what follows the headers."""

    def __init__(self, data: bytes | FileBytes):
        self.data = data

    def __iter__(self) -> Iterator[tuple[dict[str, str], object]]:
        data, at = self.data, 0
        while at < len(data):
            if bytes(data[at : at + 3]) != b"\x1f\x8b\x08":
                raise ValueError(f"no gzip member at byte {at}")
            flags, body, size = data[at + 3], at + 10, 0
            if flags & 4:
                n = int.from_bytes(data[body : body + 2], "little")
                extra = bytes(data[body + 2 : body + 2 + n])
                if extra[:2] == b"sl" and len(extra) >= 8:
                    size = int.from_bytes(extra[4:8], "little")
                body += 2 + n
            for flag in (8, 16):  # name, comment
                if flags & flag:
                    while data[body]:
                        body += 1
                    body += 1
            body += 2 * bool(flags & 2)
            inflate = zlib.decompressobj(-15)
            window = data[body : body + 4096] if not size else data[body : min(body + 4096, at + size)]
            head = inflate.decompress(window, 2048)
            fed = body + len(window)
            while b"\r\n\r\n" not in head:
                more = inflate.unconsumed_tail or bytes(data[fed : fed + 4096])
                if not inflate.unconsumed_tail:
                    fed += len(more)
                if not more or inflate.eof:
                    raise ValueError(f"no end of headers in the record at byte {at}")
                head += inflate.decompress(more, 2048)
            lines, _, begun = head.partition(b"\r\n\r\n")
            headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines.decode("utf-8", "replace").split("\r\n")[1:])}
            state = {"end": at + size if size else None}

            def rest(inflate=inflate, begun=begun, fed=fed, state=state) -> bytes:
                parts = [begun]
                if inflate.unconsumed_tail:
                    parts.append(inflate.decompress(inflate.unconsumed_tail))
                stop = state["end"] or len(data)
                step = stop - fed if state["end"] else 1 << 16
                while not inflate.eof and fed < stop:
                    parts.append(inflate.decompress(data[fed : min(fed + step, stop)]))
                    fed = min(fed + step, stop)
                if not inflate.eof:
                    raise ValueError("a record is cut off")
                state["end"] = state["end"] or fed - len(inflate.unused_data) + 8
                return b"".join(parts)

            yield headers, rest
            if state["end"] is None:
                rest()
            at = state["end"]


def payload_of(block: bytes, content_length: int) -> bytes:
    """The payload of an HTTP message: what follows its headers."""
    return block[:content_length].partition(b"\r\n\r\n")[2]


# --- writing ---


def _open_folder(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _writer(folder: str):
    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        store, root = _open_folder(folder)
        task = TaskContext.get()
        name = posixpath.join(root, f"part-{task.partitionId():05d}.warc.gz")
        draft = f"{name}.{task.taskAttemptId()}.draft"
        n = 0
        with store.open_output_stream(draft) as out:
            for batch in batches:
                ids, urls, pages, digests, refers = (batch.column(i) for i in range(5))
                for i in range(batch.num_rows):
                    out.write(pack(build_record(ids[i].as_py(), urls[i].as_py(), (pages[i].as_py() or "").encode(), digests[i].as_py(), refers[i].as_py())))
                    n += 1
        store.move(draft, name)  # whole or not at all; a repeated task replaces the same file
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["file", "records"])

    return write


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = MIN_REVISIT) -> int:
    """Writes a record for each page, the html in UTF-8 as its payload, to .warc.gz files in a folder that all executors share; returns how many.

    Of records with equal payloads of at least min_revisit bytes, that with the largest id is a response, the others
    revisit it. A null html is an empty payload; a row with a null id has a record but is never revisited; repeated
    rows with the largest id are responses each. A very long html is one
    record, which must fit in a task. An empty table writes no records. Other input columns are not
    written. A task writes a file under a name of its own and moves it in place, so tasks can be repeated. Digests,
    not payloads, are grouped to find the keepers.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    keyed = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("n"))
    large = keyed.where(F.col("n") >= min_revisit)
    keepers = cut(large.groupBy("digest").agg(F.max("id").alias("keeper"), F.count("*").alias("k")).where("k > 1 AND keeper IS NOT NULL").drop("k"))
    both = keyed.join(keepers, "digest", "left")
    refers = F.when((F.col("n") >= min_revisit) & ~F.col("id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    store, root = _open_folder(folder)
    store.create_dir(root, recursive=True)
    done = map_batches(both.select("id", "url", "html", "digest", refers.alias("refers")), _writer(folder), "file string, records long")
    return done.agg(F.sum("records")).first()[0] or 0


# --- reading ---

FIELDS = {
    "record_id": T.StringType(), "record_type": T.StringType(), "target_uri": T.StringType(), "refers_to": T.StringType(), "header_digest": T.StringType(),
    "header_length": T.LongType(), "payload_digest": T.StringType(), "payload_length": T.LongType(), "payload": T.BinaryType(),
}
#: Those known from a record's headers alone, by the header.
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "refers_to": "warc-refers-to", "header_digest": "warc-payload-digest", "header_length": "x-payload-length"}


class FilePartition(InputPartition):
    def __init__(self, files: tuple[str, ...]):
        super().__init__(files)
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, folder: str, fields: list[str]):
        self.folder, self.fields, self.tests = folder, fields, []

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        """Takes equality, membership and prefix tests of header fields; Spark keeps the rest."""
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name not in HEADERS or name == "header_length":
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append((HEADERS[name], "in", {f.value}))
            elif isinstance(f, In):
                self.tests.append((HEADERS[name], "in", set(f.value)))
            elif isinstance(f, StringStartsWith):
                self.tests.append((HEADERS[name], "prefix", f.value))
            else:
                yield f

    def partitions(self):
        """Files, packed by size, largest first, each into the emptiest partition."""
        from pyarrow import fs

        store, root = _open_folder(self.folder)
        files = [(i.size, i.path) for i in store.get_file_info(fs.FileSelector(root)) if i.path.endswith((".warc.gz", ".warc")) and i.is_file]
        n = max(1, min(len(files), -(-sum(s for s, _ in files) // PARTITION_BYTES)))
        bins: list[list] = [[0, []] for _ in range(n)]
        for size, path in sorted(files, reverse=True):
            least = min(bins, key=lambda b: b[0])
            least[0] += size
            least[1].append(path)
        return [FilePartition(tuple(b[1])) for b in bins if b[1]] or [FilePartition(())]

    def wanted(self, headers: dict[str, str]) -> bool:
        for header, how, what in self.tests:
            value = headers.get(header)
            if value is None or (value not in what if how == "in" else not value.startswith(what)):
                return False
        return True

    def read(self, partition):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        store, _ = _open_folder(self.folder)
        decode = {"payload", "payload_digest", "payload_length"} & set(self.fields)
        rows: list[dict] = []
        size = 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([r.get(f) for r in rows], to_arrow_type(FIELDS[f])) for f in self.fields], list(self.fields))

        for path in partition.files:
            with store.open_input_file(path) as f:
                data = FileBytes(f)
                for headers, rest in Members(data) if path.endswith(".gz") else _plain(data):
                    if not self.wanted(headers):
                        continue
                    row = {k: headers.get(h) for k, h in HEADERS.items()}
                    row["header_length"] = int(row["header_length"]) if row["header_length"] else None
                    if decode and row["record_type"] == "response":
                        payload = payload_of(rest(), int(headers["content-length"]))
                        row |= {"payload_digest": hashlib.sha1(payload).hexdigest(), "payload_length": len(payload), "payload": payload if "payload" in decode else None}
                        size += len(payload) if "payload" in decode else 0
                    rows.append(row)
                    if len(rows) >= 4096 or size >= BATCH_BYTES:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()


def _plain(data) -> Iterator[tuple[dict[str, str], object]]:
    """As Members, of an archive that isn't compressed."""
    at = 0
    while at < len(data):
        end = at
        head = b""
        while b"\r\n\r\n" not in head:
            end = min(end + 2048, len(data))
            head = bytes(data[at:end])
            if end == len(data) and b"\r\n\r\n" not in head:
                raise ValueError(f"no end of headers in the record at byte {at}")
        lines = head.partition(b"\r\n\r\n")[0]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines.decode("utf-8", "replace").split("\r\n")[1:])}
        start, n = at + len(lines) + 4, int(headers["content-length"])
        yield headers, lambda start=start, n=n: bytes(data[start : start + n])
        at = start + n + 4


class WarcDataSource(DataSource):
    """spark.read.format("warc").option("path", folder): a row for each record.

    Option `columns`, comma-separated, chooses fields of FIELDS. Headers are parsed first, filters on them decide
    whether a record is wanted, and only a wanted response whose payload, or its digest or length, is asked for is
    inflated to its end.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def fields(self) -> list[str]:
        chosen = self.options.get("columns", "")
        return [c.strip() for c in chosen.split(",")] if chosen else list(FIELDS)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f, FIELDS[f]) for f in self.fields()])

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(self.options["path"], self.fields())


def read_warc(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The records of the archives in a folder."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").option("columns", ",".join(columns)).load(folder)


def archive(pages: DataFrame, **options) -> tuple[str, int]:
    """write_warc() into a new folder of the shared one, which goes when the driver's process ends: (folder, records). All else as there."""
    folder = f"{shared_folder(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    where = pages.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(pages.sparkSession._jsc.hadoopConfiguration()).deleteOnExit(where)
    return folder, write_warc(pages, folder, **options)
