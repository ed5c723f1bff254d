"""JPEG frames of any writer to samples of their first component: baseline and extended Huffman DCT, and lossless, of eight bits."""

from __future__ import annotations

import functools
import struct
from dataclasses import dataclass, field

import numpy as np


class UnknownJpeg(ValueError):
    """Not a JPEG, or one of a kind that isn't decoded: progressive, arithmetic, hierarchical, or of more than eight bits."""


def _zigzag() -> np.ndarray:
    """Where the k-th coefficient of a block stands, by rows: diagonals up and down in turn."""
    cells = sorted(((i + j, (i if (i + j) % 2 else j), i * 8 + j) for i in range(8) for j in range(8)))
    return np.array([c for *_, c in cells])


ZIGZAG = _zigzag()

# The tables that motion JPEG files leave out (ISO/IEC 10918-1, K.3): codes by length, and what they stand for.
DC_LUMA = (bytes([0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0]), bytes(range(12)))
DC_CHROMA = (bytes([0, 3, 1, 1, 1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0]), bytes(range(12)))
AC_LUMA_SHORT = "01 02 03 00 04 11 05 12 21 31 41 06 13 51 61 07 22 71 14 32 81 91 a1 08 23 42 b1 c1 15 52 d1 f0 24 33 62 72 82"
AC_CHROMA_SHORT = "00 01 02 03 11 04 05 21 31 06 12 41 51 07 61 71 13 22 32 81 08 14 42 91 a1 b1 c1 09 23 33 52 f0 15 62 72 d1 0a 16 24 34 e1 25 f1"


def _with_rest(short: str) -> bytes:
    """The values of short codes, then all others of the 162 in order, which have the longest codes."""
    first = bytes.fromhex(short)
    return first + bytes(v for run in range(16) for v in range(run * 16 + 1, run * 16 + 11) if v not in first)


AC_LUMA = (bytes([0, 2, 1, 3, 3, 2, 4, 3, 5, 5, 4, 4, 0, 0, 1, 125]), _with_rest(AC_LUMA_SHORT))
AC_CHROMA = (bytes([0, 2, 1, 2, 4, 4, 3, 4, 7, 5, 4, 4, 0, 1, 2, 119]), _with_rest(AC_CHROMA_SHORT))
STANDARD = {(0, 0): DC_LUMA, (0, 1): DC_CHROMA, (1, 0): AC_LUMA, (1, 1): AC_CHROMA}


@functools.lru_cache(maxsize=64)
def lookup(counts: bytes, values: bytes) -> list[tuple[int, int]]:
    """(length, value) by the next 16 bits; length 0 where no code begins so."""
    table, code, k = [(0, 0)] * (1 << 16), 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            low = code << (16 - length)
            if k >= len(values) or low >= 1 << 16:
                raise UnknownJpeg("a Huffman table with too many codes")
            table[low : low + (1 << (16 - length))] = [(length, values[k])] * (1 << (16 - length))
            code, k = code + 1, k + 1
        code <<= 1
    return table


@dataclass
class Component:
    id: int
    h: int
    v: int
    quant: int
    dc: int = 0
    ac: int = 0


@dataclass
class Frame:
    lossless: bool = False
    width: int = 0
    height: int = 0
    components: list[Component] = field(default_factory=list)
    quants: dict[int, np.ndarray] = field(default_factory=dict)
    huffman: dict[tuple[int, int], tuple[bytes, bytes]] = field(default_factory=lambda: dict(STANDARD))
    restart: int = 0
    predictor: int = 0
    shift: int = 0
    scan: bytes = b""


def parse(data: bytes) -> Frame:
    """The headers of a file and its one scan."""
    if data[:2] != b"\xff\xd8":
        raise UnknownJpeg("no JPEG")
    out, at = Frame(), 2
    try:
        while True:
            while data[at] == 0xFF and data[at + 1] == 0xFF:
                at += 1
            if data[at] != 0xFF:
                raise UnknownJpeg("no marker where one must be")
            marker, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xDB:
                i = 0
                while i < len(body):
                    wide, k = body[i] >> 4, body[i] & 15
                    out.quants[k] = np.frombuffer(body, ">u2" if wide else "u1", 64, i + 1).astype(np.int64)
                    i += 1 + 64 * (2 if wide else 1)
            elif marker == 0xC4:
                i = 0
                while i < len(body):
                    counts = body[i + 1 : i + 17]
                    out.huffman[body[i] >> 4, body[i] & 15] = (counts, body[i + 17 : i + 17 + sum(counts)])
                    i += 17 + sum(counts)
            elif marker in (0xC0, 0xC1, 0xC3):
                bits, out.height, out.width, n = struct.unpack_from(">BHHB", body)
                if bits != 8 or not out.height or not out.width:
                    raise UnknownJpeg(f"{bits} bits a sample, {out.width} x {out.height}")
                out.lossless = marker == 0xC3
                out.components = [Component(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
            elif 0xC0 <= marker <= 0xCF:
                raise UnknownJpeg(f"frames of kind {marker:#x} aren't decoded")
            elif marker == 0xDD:
                out.restart = struct.unpack(">H", body)[0]
            elif marker == 0xDA:
                n, by_id = body[0], {c.id: c for c in out.components}
                if n != len(out.components):
                    raise UnknownJpeg("components in scans of their own aren't decoded")
                for i in range(n):
                    c = by_id[body[1 + 2 * i]]
                    c.dc, c.ac = body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15
                out.predictor, out.shift = body[1 + 2 * n], body[3 + 2 * n] & 15
                out.scan = data[at:]
                return out
    except (IndexError, KeyError, struct.error, ValueError) as e:
        if isinstance(e, UnknownJpeg):
            raise
        raise UnknownJpeg("it ends, or a table is missing, before the scan") from e


def _intervals(scan: bytes) -> list[bytes]:
    """The scan's bytes without stuffing, cut at restart markers, up to the end marker."""
    out, at = [], 0
    start = 0
    while True:
        at = scan.find(b"\xff", at)
        if at < 0 or at + 1 >= len(scan):
            out.append(scan[start:])
            break
        if scan[at + 1] == 0:
            at += 2
        elif 0xD0 <= scan[at + 1] <= 0xD7:
            out.append(scan[start:at])
            at += 2
            start = at
        else:
            out.append(scan[start:at])
            break
    return [x.replace(b"\xff\x00", b"\xff") for x in out]


class Bits:
    def __init__(self, data: bytes):
        self.data, self.at, self.end = data + b"\xff\xff\xff\xff", 0, 8 * len(data)

    def symbol(self, table: list[tuple[int, int]]) -> int:
        i, r = self.at >> 3, self.at & 7
        d = self.data
        length, value = table[((d[i] << 16 | d[i + 1] << 8 | d[i + 2]) >> (8 - r)) & 0xFFFF]
        if not length or self.at + length > self.end:
            raise UnknownJpeg("a code that no table has, or the end of the scan")
        self.at += length
        return value

    def number(self, n: int) -> int:
        """n bits, as a difference of category n."""
        if not n:
            return 0
        i, r = self.at >> 3, self.at & 7
        if self.at + n > self.end:
            raise UnknownJpeg("the end of the scan")
        v = (int.from_bytes(self.data[i : i + 4], "big") >> (32 - r - n)) & ((1 << n) - 1)
        self.at += n
        return v if v >> (n - 1) else v - (1 << n) + 1


def _dct_basis() -> np.ndarray:
    k, x = np.arange(8)[:, None], np.arange(8)[None, :]
    return np.where(k == 0, np.sqrt(1 / 8), 0.5) * np.cos((2 * x + 1) * k * np.pi / 16)


BASIS = _dct_basis()


def first_component(data: bytes) -> np.ndarray:
    """The samples (height, width) of a file's first component: the luma of colour frames."""
    f = parse(data)
    try:
        return _lossless(f) if f.lossless else _dct(f)
    except (IndexError, KeyError) as e:
        raise UnknownJpeg("a table is missing, or the scan ends early") from e


def _dct(f: Frame) -> np.ndarray:
    alone = len(f.components) == 1
    most_h, most_v = max(c.h for c in f.components), max(c.v for c in f.components)
    first = f.components[0]
    if alone:
        first.h = first.v = most_h = most_v = 1
    across, down = -(-f.width // (8 * most_h)), -(-f.height // (8 * most_v))
    blocks = np.zeros((down * first.v, across * first.h, 64))
    tables = [(lookup(*f.huffman[0, c.dc]), lookup(*f.huffman[1, c.ac])) for c in f.components]
    intervals, n = _intervals(f.scan), across * down
    each = f.restart or n
    for k, part in enumerate(intervals):
        bits, last = Bits(part), [0] * len(f.components)
        for mcu in range(k * each, min(n, (k + 1) * each)):
            row, col = divmod(mcu, across)
            for i, c in enumerate(f.components):
                dc, ac = tables[i]
                for y in range(c.v):
                    for x in range(c.h):
                        last[i] += bits.number(bits.symbol(dc))
                        block = blocks[row * c.v + y, col * c.h + x] if i == 0 else None
                        if block is not None:
                            block[0] = last[i]
                        at = 1
                        while at < 64:
                            s = bits.symbol(ac)
                            run, size = s >> 4, s & 15
                            if not size:
                                if run != 15:
                                    break
                                at += 16
                                continue
                            at += run
                            v = bits.number(size)
                            if block is not None:
                                block[at] = v
                            at += 1
    if len(intervals) * each < n:
        raise UnknownJpeg("the scan ends early")
    coefficients = np.zeros_like(blocks)
    coefficients[..., ZIGZAG] = blocks * f.quants[first.quant]
    square = BASIS.T @ coefficients.reshape(*blocks.shape[:2], 8, 8) @ BASIS
    image = np.clip(np.rint(square + 128), 0, 255).astype(np.uint8).transpose(0, 2, 1, 3).reshape(8 * blocks.shape[0], 8 * blocks.shape[1])
    return image[: -(-f.height * first.v // most_v), : -(-f.width * first.h // most_h)]


def _lossless(f: Frame) -> np.ndarray:
    if any((c.h, c.v) != (1, 1) for c in f.components) and len(f.components) > 1 or not 1 <= f.predictor <= 7:
        raise UnknownJpeg("lossless frames of this sampling or predictor aren't decoded")
    n, tables = len(f.components), [lookup(*f.huffman[0, c.dc]) for c in f.components]
    out = np.zeros((n, f.height, f.width), dtype=np.int64)
    each, start = f.restart or f.height * f.width, 1 << (7 - f.shift)
    for k, part in enumerate(_intervals(f.scan)):
        bits, low = Bits(part), k * each
        for mcu in range(low, min(f.height * f.width, low + each)):
            y, x = divmod(mcu, f.width)
            top = low // f.width
            for i, table in enumerate(tables):
                size = bits.symbol(table)
                d = 32768 if size == 16 else bits.number(size)
                plane = out[i]
                if y == top:
                    p = plane[y, x - 1] if x else start
                elif not x:
                    p = plane[y - 1, 0]
                else:
                    a, b, c = plane[y, x - 1], plane[y - 1, x], plane[y - 1, x - 1]
                    p = (a, b, c, a + b - c, a + ((b - c) >> 1), b + ((a - c) >> 1), (a + b) >> 1)[f.predictor - 1]
                plane[y, x] = (p + d) & 0xFF
    return (out[0] << f.shift).astype(np.uint8)
