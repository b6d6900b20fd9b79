"""Texts as numpy arrays: words, their 64-bit hashes and hashes of runs of words or bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: The bytes of ``[\x20\x09-\x0D]``.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_POLY = np.uint64(0xD6E8FEB86659FD93)
#: A random 64-bit value per byte.
BYTE_VALUES = np.random.Generator(np.random.PCG64(2024)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = 1 << 20
#: Texts of a batch that are copied at once.
_ROWS = 1024


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values; works on a copy."""
    x = x ^ (x >> np.uint64(32))
    x *= _B
    x ^= x >> np.uint64(29)
    return x


def gram_hashes(tokens: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` tokens, a polynomial of them, scrambled; empty if there are fewer."""
    n = len(tokens) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, size, done, out = tokens, 1, 0, None
    while True:
        raised = np.uint64(pow(int(_A), size, 2**64))
        if k & size:
            part = power[done : done + n]
            if out is None:
                out = part.copy()
            else:
                out *= raised
                out += part
            done += size
        if done == k:
            return mix(out)
        longer = power[:-size] * raised
        longer += power[size:]
        power = longer
        size *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    out, size = values, 1
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts on end and the offsets between them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    n, start = len(column), column.offset
    offsets = np.frombuffer(column.buffers()[1], np.int64)[start : start + n + 1] if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def document_slices(offsets: np.ndarray, limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``limit`` bytes; a longer text is alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last
        first = last


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of the first word of each text (one more entry than texts)."""
    inside = ~IS_SPACE[raw]
    before = np.empty(len(raw), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(raw)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(raw), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends_of = cuts[cuts > 0] - 1
    after[ends_of] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, from sums of byte values times powers of a base."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, low + _BLOCK, "right")))
        part = BYTE_VALUES[raw[low : ends[last - 1]]]
        up, down = _powers(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up, out=sums[1:])
        a, b = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        first = last
    return out


#: What a task left in this process for later tasks of its query, by the query's token. Queries that read words let it go.
HELD: dict[tuple, tuple] = {}

_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = _BLOCK if n <= _BLOCK else n
    if size not in _cache:
        inverse = np.uint64(pow(int(_POLY), -1, 2**64))
        made = []
        for base in (_POLY, inverse):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            made.append(np.multiply.accumulate(row))
        if size > _BLOCK:
            return made[0][:n], made[1][:n]
        _cache[size] = (made[0], made[1])
    up, down = _cache[size]
    return up[:n], down[:n]


def words_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice of texts: number of its first text, bytes, word starts, word ends, first words and word hashes."""
    HELD.clear()
    for low in range(0, len(column), _ROWS):
        raw, offsets = text_bytes(column.slice(low, _ROWS))
        for a, b in document_slices(offsets):
            part = raw[offsets[a] : offsets[b]]
            starts, ends, firsts = word_bounds(part, offsets[a : b + 1] - offsets[a])
            yield low + a, part, starts, ends, firsts, word_hashes(part, starts, ends)
    pa.default_memory_pool().release_unused()
