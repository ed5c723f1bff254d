"""Word shingles of many texts at once, as sorted arrays of 64-bit hashes, and their SuperMinHash signatures."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SIZE = 5
#: Bytes of text, and then elements, that are worked on at once.
CHUNK_BYTES = 1 << 20
CHUNK_ELEMENTS = 1 << 16

U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False
_SEEDED = np.random.Generator(np.random.PCG64(20240607))  # the same on every machine
_BYTE = _SEEDED.integers(1, 2**64, 256, dtype=U)
_PLACE = _SEEDED.integers(1, 2**64, SIZE, dtype=U) | U(1)
_FEW = _SEEDED.integers(1, 2**64, SIZE, dtype=U)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        x = np.full(n, base, dtype=U)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


def _word_hashes(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of texts that lie one after another and end at ends: each word's hash, and the index of its text."""
    buf = _LOWER[buf]
    inside = _IN_WORD[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = ends[(ends > 0) & (ends < len(buf))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    n = 1 << max(20, int(len(buf)).bit_length())
    power, inverse = _powers(n)
    total = np.zeros(len(buf) + 1, dtype=U)
    np.cumsum(_BYTE[buf] * power[: len(buf)], out=total[1:])
    return mix((total[stop] - total[start]) * inverse[start] + (stop - start).astype(U)), np.searchsorted(ends, start, side="right")


def _chunks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The bytes of consecutive texts, and where each ends; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, side="right")) - 1)
        j = min(j, len(column))
        yield data[offsets[i] : offsets[j]], offsets[i + 1 : j + 1] - offsets[i]
        i = j


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles: SIZE words, or all words of a text with fewer."""
    for buf, ends in _chunks(column):
        if not len(buf):
            yield from (np.empty(0, dtype=U) for _ in ends)
            continue
        word, of = _word_hashes(buf, ends)
        n = np.bincount(of, minlength=len(ends))
        if len(word) >= SIZE:
            runs = np.zeros(len(word) - SIZE + 1, dtype=U)
            for k in range(SIZE):
                runs += word[k : k + len(runs)] * _PLACE[k]
            runs = mix(runs)
        at = 0
        for count in n.tolist():
            if count >= SIZE:
                yield np.unique(runs[at : at + count - SIZE + 1])
            elif count:
                yield mix((word[at : at + count] * _PLACE[:count]).sum(dtype=U, keepdims=True) + _FEW[count])
            else:
                yield np.empty(0, dtype=U)
            at += count


def _super_minhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash: a row of m ranks for each set, none of which is empty.

    Every element walks a random permutation of the m places, of its own seed, and offers the place at step i the
    value i + r with r random in [0, 1): places of one element never share a rank, which lowers the variance. A set
    whose largest value is below the next step's rank can't change any more, and stops. Values are integers, the rank
    in the upper half and r in the lower.
    """
    element = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    best = np.full(len(sets) * m, np.iinfo(U).max, dtype=U)
    perm = None
    for step in range(m):
        x = mix(element + U((step + 1) * _BASE & (2**64 - 1)))
        place = step + ((x >> U(32)) * U(m - step) >> U(32)).astype(np.int64)
        if step == 0:
            value = place
            drawn = [place]
        else:
            rows = np.arange(len(element))
            value = perm[rows, place]
            perm[rows, place] = perm[rows, step]
        np.minimum.at(best, of * m + value, (U(step) << U(32)) | (x & U(0xFFFFFFFF)))
        open_ = best.reshape(-1, m).max(axis=1) >= (U(step + 1) << U(32))
        keep = open_[of]
        if not keep.any():
            break
        if not keep.all():
            element, of = element[keep], of[keep]
            perm = perm[keep] if perm is not None else None
        if step == 0:
            perm = np.tile(np.arange(m, dtype=np.uint16), (len(element), 1))
            first = drawn[0][keep]
            rows = np.arange(len(element))
            perm[rows, first] = 0
    return best.reshape(-1, m)


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """Of each row of signatures, a 64-bit key for each band of `rows` ranks, different from band to band."""
    bands = signature.reshape(len(signature), -1, rows)
    key = mix(np.arange(1, bands.shape[1] + 1, dtype=U) * U(_BASE))[None, :]
    for k in range(rows):
        key = mix(key ^ bands[:, :, k])
    return key.view(np.int64)


def bands_of(sets: Iterable[np.ndarray], bands: int, rows: int) -> Iterator[np.ndarray | None]:
    """The band keys of each set's signature; None for an empty set."""

    def flush(block: list[np.ndarray]) -> Iterator[np.ndarray | None]:
        full = [s for s in block if len(s)]
        keys = iter(band_keys(_super_minhash(full, bands * rows), rows)) if full else iter(())
        for s in block:
            yield next(keys) if len(s) else None

    block, size = [], 0
    for s in sets:
        if block and size + len(s) > CHUNK_ELEMENTS:
            yield from flush(block)
            block, size = [], 0
        block.append(s)
        size += len(s)
    yield from flush(block)
