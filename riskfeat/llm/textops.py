"""Vectorised text helpers used inside Arrow tasks.

A batch of texts is looked at as one UTF-8 byte array plus row offsets; words
are runs of bytes outside ``[\\x20\\x09-\\x0D]`` and never cross rows.  Null
texts count as empty.  Work is done in slices of bounded bytes, so memory
follows the slice (or the longest single text), not the partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard

SLICE_BYTES = 2 << 20
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_SEP = np.zeros(256, bool)
IS_SEP[list(SEPARATORS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_BYTES = bytes(LOWER)

MULT = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)


def mix64(h: np.ndarray) -> np.ndarray:
    """The 64-bit avalanche step of MurmurHash3."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(n: int) -> np.ndarray:
    """MULT ** 0..n-1 modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(max(n, 64), MULT, np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS[:n]


def byte_view(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and its n + 1 offsets (null: empty)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if pa.types.is_null(arr.type):
        arr = arr.cast(pa.string())
    if arr.null_count:
        arr = arr.fill_null("" if not pa.types.is_binary(arr.type) else b"")
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, off, dat = arr.buffers()
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset : arr.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(dat, np.uint8) if dat is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


KEPT: list = []  # what a worker keeps between tasks; each entry has forget()


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES, keep: object = None) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices whose ``text`` column holds about ``limit`` bytes.

    Python workers are used again by later tasks and stages: what other tasks
    kept there is forgotten first, but for ``keep``, and what the slices took
    goes back to the system when a task has read them all.
    """
    for kept in KEPT:
        if kept is not keep:
            kept.forget()
    try:
        for b in batches:
            if not b.num_rows:
                continue
            _, offs = byte_view(b.column(text))
            at = 0
            while at < b.num_rows:
                to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1)
                yield b.slice(at, to - at)
                at = to
    finally:
        release()


def release() -> None:
    """Gives freed memory back to the system; without glibc, Arrow's part alone."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of every word."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~IS_SEP[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    first = offs[:-1]
    before[first[first < len(data)]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    last = offs[1:] - 1
    after[last[last >= 0]] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    # starts rise, and rows are fewer: look the rows up among the starts
    row = np.repeat(np.arange(len(offs) - 1), np.diff(np.searchsorted(start, offs)))
    return row, start, end


# by byte: its number plus one, nothing for a separator
_WORD_BYTE = np.where(IS_SEP, 0, np.arange(256) + 1).astype(np.uint64)


def all_word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``word_hashes`` of all words of ``data``, as ``word_spans`` gives them: separators between them count nothing."""
    if not len(start):
        return np.zeros(0, np.uint64)
    reach = np.diff(start, append=end[-1])
    local = np.arange(int(start[0]), int(end[-1])) - np.repeat(start, reach)
    vals = _WORD_BYTE[data[start[0] : end[-1]]] * powers(int(reach.max()))[local]
    return mix64(np.add.reduceat(vals, start - start[0]) + (end - start).astype(np.uint64))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes (polynomial, then avalanche)."""
    n = end - start
    if not len(n):
        return np.zeros(0, np.uint64)
    before = np.cumsum(n) - n
    local = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(before, n)
    take = local + np.repeat(start, n)
    vals = (data[take].astype(np.uint64) + np.uint64(1)) * powers(int(n.max()))[local]
    return mix64(np.add.reduceat(vals, before) + n.astype(np.uint64))


def shingle_hashes(row: np.ndarray, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit hash of every run of ``k`` words inside one row."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ok = row[:n] == row[k - 1 :]
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = h * MULT + words[i : i + n]
    return row[:n][ok], mix64(h[ok])


def counts_by_row(row: np.ndarray, n_rows: int) -> np.ndarray:
    return np.bincount(row, minlength=n_rows).astype(np.int64)


def pack(a: np.ndarray) -> bytes:
    """An array's bytes, compressed for the shuffle."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def unpack(b: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)
