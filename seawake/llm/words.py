"""Whole-batch word hashing with numpy, shared by the operators on word windows.

A word is a run of word bytes of the UTF-8 text (all separators are ASCII, so bytes are enough), A-Z lower-cased.
Words and windows are 64-bit hashes: a polynomial over random byte values, finished by a bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20  # bytes of text hashed at once; bounds a task's memory whatever a text's length
_RANDOM = np.random.default_rng(20240101)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)

_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
#: Runs of anything but ASCII white space.
SPACED = ~_space
#: Runs of ASCII letters, digits and all characters outside ASCII.
ALNUM = np.array([c >= 0x80 or chr(c).isalnum() for c in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _hash_runs(data: np.ndarray, cuts: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``data`` and where each begins; no word crosses a position in ``cuts``."""
    inside = word_byte[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = cuts[cuts < len(data)]
    first[cuts] = inside[cuts]
    begin = np.flatnonzero(first)
    if not len(begin):
        return np.empty(0, np.uint64), begin
    packed = np.cumsum(inside)[begin] - 1
    lengths = np.diff(packed, append=int(inside.sum()))
    values = _BYTE[_LOWER[data[inside]]]
    place = np.arange(len(values)) - np.repeat(packed, lengths)
    values *= _powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(values, packed) + lengths.astype(np.uint64)), begin


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and its offsets; a null is an empty text."""
    texts = texts.fill_null("") if texts.null_count else texts
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, offsets


def hashed_words(texts: pa.Array, word_byte: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields (first row, row after the last, word hashes, offsets of each row's words) for runs of rows.

    A run holds ``CHUNK`` bytes at most, unless it is a single longer text: that is hashed piece by piece, cut between
    words, and yields its words together.
    """
    data, offsets = text_buffers(texts)
    row, rows = 0, len(texts)
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, "right")) - 1)
        low, high = offsets[row], offsets[end]
        if high - low <= CHUNK:
            hashes, begin = _hash_runs(data[low:high], offsets[row:end] - low, word_byte)
            yield row, end, hashes, np.searchsorted(begin, offsets[row:end + 1] - low)
        else:
            parts = []
            while low < high:
                cut = min(low + CHUNK, high)
                while cut < high and word_byte[data[cut]]:
                    cut += 1
                parts.append(_hash_runs(data[low:cut], np.zeros(1, np.int64), word_byte)[0])
                low = cut
            hashes = np.concatenate(parts)
            yield row, end, hashes, np.array([0, len(hashes)])
        row = end


def hashed_windows(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within each row, and the offsets of each row's windows.

    A row of fewer words, but not none, has one window of all its words.
    """
    counts = np.diff(offsets)
    short = np.flatnonzero((counts > 0) & (counts < size))
    windows = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    out = np.concatenate(([0], np.cumsum(windows)))
    place = np.arange(out[-1]) - np.repeat(out[:-1], windows) + np.repeat(offsets[:-1], windows)
    total = np.zeros(out[-1], np.uint64)
    padded = np.concatenate((words, np.zeros(size, np.uint64)))
    for k in range(size):
        total += padded[place + k] * _PLACE[k]
    total += np.uint64(size)
    for row in short:
        part = words[offsets[row]:offsets[row + 1]]
        total[out[row]] = (part * _PLACE[:len(part)]).sum(dtype=np.uint64) + np.uint64(len(part))
    return mix(total), out
