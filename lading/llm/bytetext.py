"""Texts as NumPy byte arrays: the shared inner loop of the Arrow operators.

A string column of an Arrow batch is one byte buffer plus row offsets.  Words
are found and hashed on that buffer with array operations, so no Python object
is made per word.  Null texts are empty texts here; callers that must tell
them apart read the column's validity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
#: Text handled at once inside a task; bounds the arrays made from it.
SLICE_BYTES = 1 << 20


def byte_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into row ranges of at most ``limit`` bytes (a longer
    text is a range of its own).  Yields (first row, end row, bytes, offsets);
    offsets has one entry more than the range has rows and starts at 0."""
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    _, offset_buf, data_buf = column.buffers()
    offsets = np.frombuffer(offset_buf, np.int64)[column.offset: column.offset + n + 1]
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None and data_buf.size else np.zeros(0, np.uint8)
    if column.null_count:
        lengths = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
        if lengths.sum() != offsets[-1] - offsets[0]:  # bytes below a null: rebuild without them
            yield from byte_slices(column.fill_null(""), limit)
            return
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]
        i = j


def lower_ascii() -> np.ndarray:
    """Byte table that lower-cases A-Z and keeps every other byte."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of word bytes, never across texts.  ``is_word`` is a
    boolean table over byte values.  Returns starts, ends and, per text, the
    index of its first word (one entry more than there are texts)."""
    if len(data) == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    mask = is_word[data]
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = mask[edges]
    starts = np.flatnonzero(first)
    last = mask
    last = last.copy()
    last[:-1] &= ~mask[1:]
    last[edges - 1] = mask[edges - 1]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_POWERS: dict[str, np.ndarray] = {}
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least n."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, _U)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def _byte_values(fold: np.ndarray) -> np.ndarray:
    """A random 64-bit value for each byte, equal for bytes folded alike."""
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 64, 256, dtype=_U)[fold]


def running_hash(data: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of the polynomial hash, and the powers that undo a place:
    ``(total[end] - total[start]) * down[start]`` depends on the bytes alone."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, _U)
    value = _byte_values(fold)[data]
    value *= up[: len(data)]
    np.cumsum(value, out=total[1:])
    return total, down


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] per span after folding bytes by the
    table ``fold``; equal contents hash alike in every task."""
    total, down = running_hash(data, fold)
    h = (total[ends] - total[starts]) * down[starts]
    return mix64(h + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def release(n: int) -> None:
    """Drop the power tables if one very long text made them large."""
    if n > 4 * SLICE_BYTES:
        _POWERS.clear()
