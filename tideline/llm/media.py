"""Media columns: payloads as AVI motion JPEG, their frames read back, and shots found in them."""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm._shared import map_batches

#: Frames are so many samples wide and high, and a second has so many.
WIDTH, HEIGHT, RATE = 64, 16, 25
FRAME = WIDTH * HEIGHT
#: Shots: histograms of so many bins; a cut is a difference above the mean of the last WINDOW ones by SIGMAS deviations, and above FLOOR.
BINS, WINDOW, SIGMAS, FLOOR = 16, 12, 2.0, 0.1


# --- lossless JPEG frames: process 14 of ISO/IEC 10918-1, eight bits, one component, predictor 1 (left) ---


@functools.lru_cache(maxsize=1)
def _codes() -> tuple[np.ndarray, np.ndarray, bytes]:
    """Encoding by difference + 255, decoding by 16-bit word, and the DHT segment.

    Category k of a difference has a Huffman code of 16 - k bits, followed by k bits of its value: each sample takes
    16 bits exactly, so that whole frames are translated by table.
    """
    order = list(range(8, -1, -1))
    code, codes, counts = 0, {}, [0] * 16
    for length, k in zip(range(8, 17), order, strict=True):
        codes[k] = code
        counts[length - 1] = 1
        code = (code + 1) << 1
    encode, decode = np.zeros(511, dtype=np.uint16), np.full(1 << 16, 1 << 14, dtype=np.int16)
    for d in range(-255, 256):
        k = abs(d).bit_length()
        word = (codes[k] << k) | (d if d >= 0 else d + (1 << k) - 1)
        encode[d + 255], decode[word] = word, d
    body = bytes([0]) + bytes(counts) + bytes(order)
    return encode, decode, b"\xff\xc4" + struct.pack(">H", len(body) + 2) + body


def _head() -> bytes:
    sof = b"\xff\xc3" + struct.pack(">HBHHBBBB", 11, 8, HEIGHT, WIDTH, 1, 1, 0x11, 0)
    sos = b"\xff\xda" + struct.pack(">HBBBBBB", 8, 1, 1, 0, 1, 0, 0)
    return b"\xff\xd8" + _codes()[2] + sof + sos


def encode_frames(samples: np.ndarray) -> list[bytes]:
    """JPEG files of frames of samples (n, HEIGHT, WIDTH)."""
    x = samples.astype(np.int16)
    d = np.empty_like(x)
    d[:, :, 1:] = x[:, :, 1:] - x[:, :, :-1]
    d[:, 1:, 0] = x[:, 1:, 0] - x[:, :-1, 0]
    d[:, 0, 0] = x[:, 0, 0] - 128
    words = _codes()[0][d + 255].astype(">u2").reshape(len(x), -1)
    head = _head()
    return [head + w.tobytes().replace(b"\xff", b"\xff\x00") + b"\xff\xd9" for w in words]


def _scan(jpeg: bytes) -> bytes:
    """The entropy-coded bytes of a frame, without stuffing; checks that it is of the kind that encode_frames() writes."""
    head = _head()
    if not jpeg.startswith(head) or not jpeg.endswith(b"\xff\xd9"):
        raise ValueError("not a lossless JPEG frame of this profile")
    return jpeg[len(head) : -2].replace(b"\xff\x00", b"\xff")


def decode_frames(jpegs: list[bytes]) -> np.ndarray:
    """The samples (n, HEIGHT, WIDTH) of JPEG files."""
    if not jpegs:
        return np.empty((0, HEIGHT, WIDTH), dtype=np.uint8)
    words = np.frombuffer(b"".join(map(_scan, jpegs)), dtype=">u2").astype(np.uint16)
    d = _codes()[1][words].reshape(-1, HEIGHT, WIDTH)
    if (d == 1 << 14).any():
        raise ValueError("a code that no sample has")
    d = d.astype(np.int32)
    d[:, 0, 0] += 128
    d[:, :, 0] = np.cumsum(d[:, :, 0], axis=1)
    return np.cumsum(d, axis=2).astype(np.uint8)


# --- the RIFF file around them ---


def _chunk(kind: bytes, body: bytes) -> bytes:
    return kind + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def write_avi(payload: bytes) -> bytes:
    """An AVI file with the payload's bytes as samples; the last frame is filled with 0, the length is in the INFO list."""
    n = max(1, -(-len(payload) // FRAME))
    samples = np.frombuffer(payload.ljust(n * FRAME, b"\0"), dtype=np.uint8).reshape(n, HEIGHT, WIDTH)
    jpegs = encode_frames(samples)
    largest = max(map(len, jpegs))
    avih = struct.pack("<14I", 1_000_000 // RATE, largest * RATE, 0, 0x10, n, 0, 1, largest, WIDTH, HEIGHT, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIIIhhhh", b"vids", b"MJPG", 0, 0, 0, 0, 1, RATE, 0, n, largest, 0xFFFFFFFF, 0, 0, 0, WIDTH, HEIGHT)
    strf = struct.pack("<IiiHH4sIiiII", 40, WIDTH, HEIGHT, 1, 8, b"MJPG", FRAME, 0, 0, 0, 0)
    strl = _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf))
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + strl)
    info = _chunk(b"LIST", b"INFO" + _chunk(b"ICMT", b"payload %d\0" % len(payload)))
    movi, index, at = [b"movi"], [], 4
    for j in jpegs:
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(j)))
        movi.append(_chunk(b"00dc", j))
        at += len(movi[-1])
    return _chunk(b"RIFF", b"AVI " + hdrl + info + _chunk(b"LIST", b"".join(movi)) + _chunk(b"idx1", b"".join(index)))


def _chunks(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(kind, start, end) of the chunks from at to end; a list has its form as kind."""
    while at + 8 <= end:
        kind, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
        if at + 8 + size > end:
            raise ValueError("a chunk beyond its parent's end")
        yield (data[at + 8 : at + 12], at + 12, at + 8 + size) if kind in (b"LIST", b"RIFF") else (kind, at + 8, at + 8 + size)
        at += 8 + size + size % 2


@dataclass
class Video:
    rate: float
    payload_bytes: int | None
    jpegs: list[bytes]


def read_avi(data: bytes) -> Video:
    """Parses an AVI file: its frames by the index, or in file order where it has none."""
    form = next(_chunks(data, 0, len(data)), None)
    if form is None or form[0] != b"AVI ":
        raise ValueError("not an AVI file")
    rate, length, movi, index, loose = 25.0, None, 0, None, []
    for kind, a, b in _chunks(data, form[1], form[2]):
        if kind == b"hdrl":
            for k, x, _ in _chunks(data, a, b):
                if k == b"avih":
                    rate = 1e6 / max(1, int.from_bytes(data[x : x + 4], "little"))
        elif kind == b"INFO":
            for k, x, y in _chunks(data, a, b):
                if k == b"ICMT" and data[x:y].startswith(b"payload "):
                    length = int(data[x + 8 : y].rstrip(b"\0"))
        elif kind == b"movi":
            movi = a - 4
            loose = [(x, y) for k, x, y in _chunks(data, a, b) if k == b"00dc"]
        elif kind == b"idx1":
            index = [struct.unpack_from("<4sIII", data, i) for i in range(a, b - 15, 16)]
    if index is not None:
        places = [(movi + at + 8, movi + at + 8 + size) for k, _, at, size in index if k == b"00dc"]
    else:
        places = loose
    return Video(rate, length, [data[x:y] for x, y in places])


# --- shots ---


def histograms(frames: np.ndarray) -> np.ndarray:
    """The share of each bin in each frame, in samples."""
    n = len(frames)
    bins = (frames.reshape(n, -1) >> np.uint8(8 - BINS.bit_length() + 1)).astype(np.int64) + BINS * np.arange(n)[:, None]
    return np.bincount(bins.ravel(), minlength=n * BINS).reshape(n, BINS)


def find_shots(hist: np.ndarray) -> list[tuple[int, int]]:
    """(first, last + 1) frames of each shot, by differences of histograms against their recent mean and deviation."""
    n = len(hist)
    if not n:
        return []
    diff = np.abs(np.diff(hist / np.maximum(1, hist.sum(axis=1, keepdims=True)), axis=0)).sum(axis=1) / 2
    cuts = [0]
    one, two = np.concatenate([[0], np.cumsum(diff)]), np.concatenate([[0], np.cumsum(diff * diff)])
    at = np.arange(len(diff))
    low = np.maximum(0, at - WINDOW)
    k = np.maximum(1, at - low)
    mean = (one[at] - one[low]) / k
    dev = np.sqrt(np.maximum(0, (two[at] - two[low]) / k - mean * mean))
    cuts += (np.flatnonzero(diff > np.maximum(FLOOR, mean + SIGMAS * dev)) + 1).tolist()
    return list(zip(cuts, [*cuts[1:], n], strict=True))


def timed(shots: list[tuple[int, int]], rate: float) -> list[dict]:
    return [{"shot": i, "first_frame": a, "n_frames": b - a, "start_s": a / rate, "end_s": b / rate} for i, (a, b) in enumerate(shots)]


CLIP = T.StructType([T.StructField(n, T.LongType()) for n in ("shot", "first_frame", "n_frames")] + [T.StructField(n, T.DoubleType()) for n in ("start_s", "end_s")])
RESULT = {
    "n_bytes": T.LongType(), "payload_bytes": T.LongType(), "payload_sha256": T.StringType(), "tail_crc32": T.LongType(),
    "media_bytes": T.LongType(), "media_sha256": T.StringType(), "feature": T.StringType(), "clips": T.ArrayType(CLIP), "media": T.BinaryType(),
}


def _work(text: str | None) -> tuple:
    raw = (text or "").encode()
    payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
    media = write_avi(payload)
    video = read_avi(media)
    frames = decode_frames(video.jpegs)
    back = frames.tobytes()[: video.payload_bytes]
    shots = find_shots(histograms(frames))
    clips = timed(shots, video.rate)
    feature = f"frames={len(frames)};shots={len(shots)};mean={int(np.frombuffer(back, np.uint8).sum(dtype=np.int64)) * 1000 // len(back)};cuts={zlib.crc32(repr(shots).encode()):08x}"
    return len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature, clips, media


def store_as_video(docs: DataFrame, text_col: str = "text", results: tuple[str, ...] = tuple(RESULT)) -> DataFrame:
    """Returns the documents with the chosen results of RESULT.

    The text as UTF-8, filled with bytes 0 to a positive multiple of 64, is the payload. media is an AVI file whose
    lossless JPEG frames have its bytes as samples; all other results are of what is read back from media: the
    payload's size, digest and the CRC-32 of its last 64 bytes, the file's size and digest, the timed clips of its
    shots, and a feature string (frames, shots, mean sample in thousandths, CRC-32 of the shots). Choose media only
    where the files are wanted; they take twice the text's size.

    A null text is an empty one, of one payload of 64 bytes 0. Equal texts, repeated rows too, give equal results. A
    text is one file, which must fit in a task; sizes in it have 32 bits, so that beyond 2 GiB of text, which no column
    holds, an error is raised. Empty tables stay empty. Input columns named as the results are replaced.
    """
    keep = [f for f in docs.schema.fields if f.name.lower() not in results]
    names = [f.name for f in keep]
    at = [list(RESULT).index(r) for r in results]

    def apply(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(RESULT[r]) for r in results]
        for batch in batches:
            rows = []
            for text in batch.column(batch.num_columns - 1):
                row = _work(text.as_py())
                rows.append([row[i] for i in at])
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*names, *results])

    schema = T.StructType([*keep, *(T.StructField(r, RESULT[r]) for r in results)])
    return map_batches(docs.select(*[f"`{x}`" for x in names], F.col(text_col).alias("__text")), apply, schema)


def clip_rows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row for each shot of each document's video (see store_as_video): the document's columns and those of CLIP, which replace columns of their names."""
    keep = [c for c in docs.columns if c.lower() not in {f.name for f in CLIP.fields}]
    out = store_as_video(docs.select(*(f"`{c}`" for c in keep)), text_col, ("clips",))
    return out.select("*", F.inline("clips")).drop("clips")


def _shots_of(media: bytes | None) -> tuple[int, list[dict], str | None]:
    """(frames, clips, error) of a file; frames are decoded one by one, and only their histograms kept."""
    from tideline.llm.jpeg import UnknownJpeg, first_component

    if media is None:
        return 0, [], None
    try:
        video = read_avi(media)
        hist = np.concatenate([histograms(first_component(j)[None]) for j in video.jpegs]) if video.jpegs else np.empty((0, BINS))
    except (UnknownJpeg, ValueError, IndexError, struct.error) as e:
        return 0, [], str(e) or "not an AVI file"
    return len(hist), timed(find_shots(hist), video.rate), None


def find_clips(files: DataFrame, media_col: str = "media") -> DataFrame:
    """Returns the rows with n_frames, clips (an array of CLIP) and error, of AVI motion-JPEG files of any writer.

    RIFF lists are parsed, frames found by the index, or in file order without one, and decoded: baseline and extended
    Huffman frames of one or more components, with the standard tables where a frame has none, and lossless ones, of
    eight bits and any size. Shots are found in the first component. A null file has no frames and no clips; a file
    that isn't AVI, is damaged, or holds frames of other kinds (progressive, arithmetic) has none either, and error
    says why. A very large file is one row and must fit in a task, though its decoded frames needn't. Repeated rows
    get the same results, empty tables stay empty, input columns named as the results are replaced.
    """
    taken = {"n_frames", "clips", "error"}
    keep = [f for f in files.schema.fields if f.name.lower() not in taken]
    names = [f.name for f in keep]

    def apply(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        for batch in batches:
            rows = [_shots_of(x.as_py()) for x in batch.columns[-1]]
            columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], to_arrow_type(T.ArrayType(CLIP))), pa.array([r[2] for r in rows], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*names, "n_frames", "clips", "error"])

    schema = T.StructType([*keep, T.StructField("n_frames", T.LongType()), T.StructField("clips", T.ArrayType(CLIP)), T.StructField("error", T.StringType())])
    return map_batches(files.select(*[f"`{x}`" for x in names], F.col(media_col).alias("__media")), apply, schema)
