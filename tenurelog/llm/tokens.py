"""Words, shingles and their hashes for whole Arrow batches, without a loop over rows.

All functions work on the UTF-8 bytes of a batch of texts laid end to end.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_BYTES = 1 << 20
U64 = np.uint64

# A-Z to lower case, everything else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Letters, digits and every byte of a character beyond ASCII.
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True

# Everything but blank, tab, line feed, vertical tab, form feed, carriage return.
VISIBLE = np.ones(256, dtype=bool)
VISIBLE[[32, 9, 10, 11, 12, 13]] = False

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


_caches: list[Callable[[], None]] = []


def on_release(clear: Callable[[], None]) -> Callable[[], None]:
    """Register what empties a cache of this worker."""
    _caches.append(clear)
    return clear


def release() -> None:
    """Empty the caches of this process and give free memory back to the system."""
    for clear in _caches:
        clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def freed(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``run`` over a partition; behind it the worker's caches are emptied and free memory goes back to the system.

    Spark keeps workers for the tasks of later stages. What they hold on to would
    add up over the stages of a pipeline.
    """

    @wraps(run)
    def whole(*args, **named):
        try:
            yield from run(*args, **named)
        finally:
            release()

    return whole


@on_release
def _forget_powers() -> None:
    _powers[:] = [np.ones(1, U64), np.ones(1, U64)]


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = MAX_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows again in batches of about ``max_bytes`` of text; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size.astype(np.int64) + 16)
        first = 0
        while first < len(ends):
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + max_bytes, "right")))
            yield batch.slice(first, last - first)
            first = last


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and where each begins; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = pc.fill_null(column.cast(kind), b"" if kind == pa.large_binary() else "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finaliser of SplitMix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, 2 * MAX_BYTES)
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(n, base, U64)
            table[0] = 1
            np.cumprod(table, out=table)
            _powers[k] = table
    return _powers


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, backward: bool = False) -> np.ndarray:
    """A 64-bit hash of each byte span, the same wherever the span lies; spans in order, not overlapping.

    ``backward`` weighs the bytes by the inverse powers, which gives a second hash. Works on stretches of about ``MAX_BYTES``, so the tables stay small for any buffer.
    """
    out = np.empty(len(starts), U64)
    first = 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, low + MAX_BYTES, "right")))
        begin, end = starts[first:last] - low, ends[first:last] - low
        part = data[low : ends[last - 1]]
        power, inverse = _power_tables(len(part) + 1)[:: -1 if backward else 1]
        sums = np.zeros(len(part) + 1, U64)
        np.cumsum((part.astype(U64) + U64(1)) * power[: len(part)], out=sums[1:])
        out[first:last] = mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(U64))
        first = last
    return out


def spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each maximal run of member bytes."""
    inside = member[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes; start, end, text number and hash of each word of letters and digits."""
    data = LOWER[data]
    starts, ends, text = spans(data, offsets, WORD)
    return data, starts, ends, text, span_hashes(data, starts, ends)


def shingles(word: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words that begin at each word, and whether they lie in one text."""
    n = len(word)
    if n < k:
        return np.zeros(0, U64), np.zeros(0, bool)
    total = np.zeros(n - k + 1, U64)
    for j in range(k):
        total += word[j : n - k + 1 + j] * U64(pow(_BASE, 2 * j + 1, 1 << 64))
    return mix(total + U64(k)), text[: n - k + 1] == text[k - 1 :]


def first_of_each(text: np.ndarray, count: int) -> np.ndarray:
    """For sorted text numbers: where each text's entries begin, one more than there are texts."""
    return np.searchsorted(text, np.arange(count + 1))
