"""Vectorised work on the UTF-8 bytes of Arrow string columns: words, shingles, gram hashes.

Hashes are polynomials in a fixed odd multiplier modulo 2^64, taken from prefix sums so that
the hash of any byte range costs one subtraction and one product, and finished by a mixer.
They depend on the bytes alone, so equal strings agree across tasks and runs.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes worked on at a time. A single longer document is taken alone.
CHUNK_BYTES = 1 << 20

U64 = np.uint64
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)

#: White space as the contracts define it: blank and 0x09 to 0x0D.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_tables: dict[str, np.ndarray] = {}

Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


#: Large tables that a worker keeps between tasks of one operator, by name.
_resident: dict[str, object] = {}


def resident(name: str, make: Callable[[], object]) -> object:
    """A large table by name; a worker keeps one at a time."""
    if name not in _resident:
        _resident.clear()
        _resident[name] = make()
    return _resident[name]


def release(keep: str | None = None) -> None:
    """Give freed memory back: workers are kept between tasks, and their allocators keep what they had.

    Large tables go too, but for the one named.
    """
    for name in [n for n in _resident if n != keep]:
        del _resident[name]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(work: Work, keep: str | None = None) -> Work:
    """The same work over a partition's batches; freed memory goes back before and after."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(keep)
        try:
            yield from work(batches)
        finally:
            release(keep)
    return run


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: One random-looking value per byte, so that sums of bytes do not show in the hashes.
BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))


def powers(n: int, base: int = MULTIPLIER, name: str = "up") -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept between calls and grown when needed."""
    have = _tables.get(name)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.full(size, base & ((1 << 64) - 1), dtype=U64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 4 * CHUNK_BYTES:
            _tables[name] = have
    return have[:n]


class RangeHash:
    """Hashes of byte ranges of one buffer."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum(BYTE_VALUES[data] * powers(len(data)), out=self.sums[1:])
        self.down = powers(len(data) + 1, INVERSE, "down")

    def __call__(self, start, end) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(raw + U64(0x632BE59BD9B4E019) * np.asarray(end - start).astype(U64))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_null(column.type) or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=wide)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most limit bytes each; a longer row stands alone."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


def _segments(data: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cut one long text at white space, so that memory does not follow its length."""
    low = 0
    while low < len(data):
        high = min(low + limit, len(data))
        if high < len(data):
            gaps = np.flatnonzero(IS_SPACE[data[low:high]])
            if len(gaps):
                high = low + int(gaps[-1]) + 1
            else:
                later = high
                while later < len(data) and not IS_SPACE[data[later]]:
                    later += 1
                high = later
        yield low, high
        low = high


def _hash_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = ~IS_SPACE[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    before[offsets] = False  # a document's first byte continues no word
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    hashes = RangeHash(LOWER[data])(starts, ends)
    counts = np.diff(np.searchsorted(starts, offsets))
    return hashes, counts


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z lower-cased) of some rows, and the number of words per row."""
    if len(offsets) == 2 and len(data) > 2 * CHUNK_BYTES:
        parts = [_hash_words(data[a:b], np.array([0, b - a]))[0]
                 for a, b in _segments(data, CHUNK_BYTES)]
        hashes = np.concatenate(parts)
        return hashes, np.array([len(hashes)])
    return _hash_words(data, offsets)


def rows_of_words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, words per row) over a whole column, a bounded slice at a time."""
    data, offsets = bytes_of(column)
    for low, high in slices(offsets):
        part = offsets[low:high + 1]
        hashes, counts = word_hashes(data[part[0]:part[-1]], part - part[0])
        yield low, hashes, counts


def shingle_sets(column: pa.Array, words: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes) of the runs of so many words in each row.

    A text with fewer words gives its whole word sequence as one; without words, none.
    """
    steps = [U64(pow(MULTIPLIER, 2 * i + 3, 1 << 64)) for i in range(words)]
    for low, hashes, counts in rows_of_words(column):
        ends = np.cumsum(counts)
        if len(hashes) >= words:
            n = len(hashes) - words + 1
            runs = np.zeros(n, dtype=U64)
            for i, step in enumerate(steps):
                runs += hashes[i:i + n] * step
            runs = mix(runs)
        for i, (end, count) in enumerate(zip(ends.tolist(), counts.tolist())):
            if count >= words:
                got = np.sort(runs[end - count:end - words + 1])
                if count > words:
                    keep = np.empty(len(got), dtype=bool)
                    keep[0] = True
                    np.not_equal(got[1:], got[:-1], out=keep[1:])
                    got = got[keep]
            elif count:
                whole = hashes[end - count:end]
                got = mix(np.array([sum(int(h) * int(s) for h, s in zip(whole, steps))
                                    + count & (1 << 64) - 1], dtype=U64))
            else:
                got = np.zeros(0, dtype=U64)
            yield low + i, got
