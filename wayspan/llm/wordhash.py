"""Words of Arrow text columns as numpy arrays: limits and hashes, without a Python object for each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
CHUNK = 2 << 20  # bytes of text handled at once; a longer text is a chunk of its own
WORDS_AT_ONCE = 1 << 18


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def text_chunks(texts: pa.Array, size: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row limits in bytes) for runs of rows of about ``size`` or CHUNK bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    limits = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(limits, limits[row] + (size or CHUNK), "right")) - 1)
        yield row, end, raw[limits[row] : limits[end]], limits[row : end + 1] - limits[row]
        row = end


def word_limits(raw: np.ndarray, limits: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte limits of the words, and the number of words before each row
    (one entry more than rows). A word ends with its row. ``blank`` tells for every byte whether
    it is outside of words."""
    inside = ~blank[raw]
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1]
    cuts = limits[1:-1]
    cuts = cuts[cuts < len(raw)]
    fresh[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends_at = cuts[cuts > 0] - 1
    last[ends_at] = inside[ends_at]
    starts, ends = np.flatnonzero(fresh), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, limits)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, bases: tuple[int, ...]) -> list[np.ndarray]:
    """A 64-bit hash of every word for each of ``bases`` (odd numbers)."""
    out = [np.empty(len(starts), np.uint64) for _ in bases]
    lo = 0
    while lo < len(starts):
        hi = min(len(starts), lo + WORDS_AT_ONCE)
        s, lens = starts[lo:hi], ends[lo:hi] - starts[lo:hi]
        before = np.cumsum(lens) - lens
        within = np.arange(int(lens.sum())) - np.repeat(before, lens)
        values = raw[np.repeat(s, lens) + within].astype(np.uint64) + np.uint64(1)
        for h, base in zip(out, bases, strict=True):
            h[lo:hi] = _mix(np.add.reduceat(values * _powers(base, int(lens.max()))[within], before) + lens.astype(np.uint64))
        lo = hi
    return out


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)


def joined(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, count: np.ndarray) -> pa.Array:
    """The texts of runs of ``count`` words (one or more) from word ``first``, with one space between words."""
    if not len(first):
        return pa.array([], pa.string())
    stop = np.cumsum(count)
    word = np.repeat(first - (stop - count), count) + np.arange(int(stop[-1]))
    size = ends[word] - starts[word] + 1
    size[stop - 1] -= 1  # no space after the last word
    after = np.cumsum(size)
    spot = np.repeat(starts[word] - (after - size), size) + np.arange(int(after[-1]))
    out = raw[np.minimum(spot, len(raw) - 1)]
    gap = np.ones(len(word), bool)
    gap[stop - 1] = False
    out[after[gap] - 1] = 32
    limits = np.append(0, after[stop - 1]).astype(np.int32)
    return pa.StringArray.from_buffers(len(first), pa.py_buffer(limits), pa.py_buffer(out))


def rolling(h: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of every run of ``width`` entries; empty if there are fewer."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for k in range(1, width):
        out *= np.uint64(base)
        out += h[k : k + n]
    return _mix(out)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbouring entries."""
    low, span = x, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
