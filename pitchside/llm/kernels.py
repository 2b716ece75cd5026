"""Vectorised text kernels that run inside Spark tasks.

A batch of texts is one UTF-8 byte buffer with offsets (the Arrow layout), cut
into pieces of about ``CHUNK_BYTES`` so that a task's memory is bounded by the
piece (or by the longest single text). Hashes are 64-bit polynomial hashes over
random byte values, finished with a bit mixer; prefix sums make the hash of any
span two lookups.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = (1 << 19) - 64  # with its borders, within one doubling of the power tables
SLICE_ROWS = 512
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser (a bijection on 64-bit integers)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit integers, the same in every process."""
    with np.errstate(over="ignore"):
        return mix(np.uint64(seed) * _M1 + np.arange(1, n + 1, dtype=np.uint64) * _GOLD)


BYTE_VALUES = stream(11, 256)
FOLDED_VALUES = BYTE_VALUES.copy()  # A-Z hash like a-z
FOLDED_VALUES[65:91] = BYTE_VALUES[97:123]

KEPT: dict[str, dict] = {}  # what a worker keeps from task to task, by name


def give_back() -> None:
    """Unused memory of this process goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def drop_kept(but: str | None) -> None:
    """Drop what this worker keeps for other stages than the one that needs ``but``."""
    held = [kept for name, kept in KEPT.items() if name != but and kept]
    for kept in held:
        kept.clear()
    if held:
        give_back()


def tidy(work, keeps: str | None = None):
    """``work`` for mapInArrow whose worker gives its memory back after each task: workers are
    used again, and what one stage held would else stay beside the next one's. So goes, before
    the task, what ``KEPT`` has but under the name ``keeps``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept(keeps)
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


# byte classes; every byte of a multi-byte character is >= 0x80, so classes that
# hold all non-ASCII characters can be decided byte by byte
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NON_SPACE = ~SPACE
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


class Powers:
    """Powers of an odd multiplier modulo 2^64 and of its inverse, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base = base | 1
        self.inv = pow(self.base, -1, 1 << 64)
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, m, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inv, m, 1 << 64))])
        return self.up, self.down


BYTE_POWERS = Powers(0xD1342543DE82EF95)
WORD_POWERS = Powers(0xAF251AF3B0F025B5)


def prefix(values: np.ndarray, powers: Powers) -> np.ndarray:
    up, _ = powers.upto(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def span_hash(pre: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of every span [start, end) from a prefix array; equal spans agree anywhere."""
    _, down = powers.upto(len(pre))
    length = (end - start).astype(np.uint64)
    return mix((pre[end] - pre[start]) * down[start] + length * _GOLD)


@dataclass
class Texts:
    """A run of documents: bytes, offsets into them, and the rows they came from."""

    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, n + 1, from 0
    first: int  # index of the first row in its batch

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    n = len(col)
    if n == 0 or col.buffers()[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Short views of batches, for work on Python strings: only a view's texts are objects."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def runs(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """Cut a text column into runs of about ``limit`` bytes (a longer text is its own run)."""
    data, off = buffers(col)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield Texts(data[off[i] : off[j]], off[i : j + 1] - off[i], i)
        i = j


@dataclass
class Words:
    start: np.ndarray  # byte positions in the run
    end: np.ndarray
    hash: np.ndarray  # uint64
    doc: np.ndarray  # document index in the run
    bounds: np.ndarray  # word offsets of documents, n + 1


def words(t: Texts, word_class: np.ndarray, values: np.ndarray = BYTE_VALUES) -> Words:
    """Maximal runs of bytes of a class, never across documents."""
    n = len(t.data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(0, np.uint64), z, np.zeros(len(t) + 1, np.int64))
    inside = word_class[t.data]
    cut = np.zeros(n + 1, bool)
    cut[t.offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | cut[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    pre = prefix(values[t.data], BYTE_POWERS)
    bounds = np.searchsorted(start, t.offsets)
    doc = np.repeat(np.arange(len(t)), np.diff(bounds))
    return Words(start, end, span_hash(pre, start, end, BYTE_POWERS), doc, bounds)


def gram_hashes(values: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k items from each position, and whether they stay in one document."""
    n = len(values)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    pre = prefix(values, WORD_POWERS)
    start = np.arange(n - k + 1)
    left = np.repeat(bounds[1:], np.diff(bounds))[: n - k + 1] - start
    return span_hash(pre, start, start + k, WORD_POWERS), left >= k


def _slide(x: np.ndarray, w: int, op) -> np.ndarray:
    """op over each window of w entries (len(x) - w + 1 results), by doubling."""
    size, acc = 1, x
    while size * 2 <= w:
        acc = op(acc[: len(acc) - size], acc[size:])
        size *= 2
    rest = w - size
    return op(acc[: len(acc) - rest], acc[rest:]) if rest else acc


def winnow(h: np.ndarray, ok: np.ndarray, w: int) -> np.ndarray:
    """Positions whose hash is a minimum of some window of w valid grams.

    Ties are all kept, so the choice depends on the window's content alone: a span
    of w + k - 1 items that occurs twice has the same positions picked in both.
    """
    if len(h) < w:
        return np.zeros(0, np.int64)
    h = h | np.uint64(1)
    low = _slide(h, w, np.minimum)
    inside = _slide(ok, w, np.logical_and)
    low[~inside] = 0
    pad = np.zeros(w - 1, np.uint64)
    best = _slide(np.concatenate([pad, low, pad]), w, np.maximum)
    return np.flatnonzero(best == h)


def marked(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Boolean mask of length n with every [start, end) set."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, ends, -1)
    return np.cumsum(d)[:n] > 0
