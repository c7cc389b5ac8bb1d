"""Word and shingle hashes of whole texts, computed on Arrow buffers with numpy inside Spark tasks.

A block is a run of texts laid end to end as UTF-8. Words are separated by ASCII white space. A word's
hash is the polynomial of its bytes, read off one running sum for the whole block, so that the work is
a few passes over the bytes whatever their number of words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Texts are taken together up to so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
#: Bytes of batches after which a worker gives back to the system what it has freed.
GIVEN_BACK = 32 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def give_back() -> None:
    """Hand memory that is free in the allocators of Arrow and C to the system. It changes no result."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, a function of batches, giving back what it has freed now and then, and at its end: the
    worker that ran it is kept for other tasks, beside a JVM that may need the memory."""

    def watched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 0
        for batch in batches:
            size += batch.nbytes
            yield batch
            if size >= GIVEN_BACK:
                give_back()
                size = 0

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(watched(batches))
        give_back()

    return whole


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, row after the last, bytes, offsets`` of each block; NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = column.fill_null("").cast(pa.large_string()).cast(pa.large_binary())
    n = len(binary)
    if not n:
        return
    _, ends, data = binary.buffers()
    offsets = np.frombuffer(ends, np.int64)[binary.offset : binary.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, n)
        yield first, last, raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def word_spans(raw: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for every text the number of its first word (one more at the end)."""
    inside = ~separator[raw]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    begin = np.flatnonzero(starts)
    return begin, np.flatnonzero(ends) + 1, np.searchsorted(begin, offsets)


def running(raw: np.ndarray) -> np.ndarray:
    up, _ = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + _U(1)) * up[: len(raw)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _power_tables(len(sums))
    return mix((sums[end] - sums[begin]) * down[begin])


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and for every text the number of its first word."""
    if lower:
        raw = LOWER[raw]
    begin, end, first = word_spans(raw, offsets)
    return span_hashes(running(raw), begin, end), first


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of every run of ``k`` words, whatever text they belong to."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _BASE + words[j : j + n]
    return mix(out)


def shingles(words: np.ndarray, first: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``k`` words; of fewer words the whole
    sequence is the only run; a text without words has none."""
    runs = run_hashes(words, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(runs[a : b - k + 1]))
        elif b > a:
            out.append(run_hashes(words[a:b], b - a) + _U(b - a))
        else:
            out.append(runs[:0])
    return out


def shingle_sets(column: pa.Array, k: int = 5) -> Iterator[tuple[int, list[np.ndarray]]]:
    """``first row, shingle sets`` block by block."""
    for at, _, raw, offsets in blocks(column):
        yield at, shingles(*word_hashes(raw, offsets), k)
