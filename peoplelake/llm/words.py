"""Words of whole texts as numpy arrays: bounds and 64-bit hashes, for code that runs on Arrow batches inside tasks.

A word is a longest run of bytes other than space and 0x09-0x0D, as in ``[^\\x20\\x09-\\x0D]+``; UTF-8 bytes of other
characters never equal those six. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
CHUNK_BYTES = 2 << 20
PIECE_BYTES = 1 << 18
#: Odd multipliers of the polynomial hashes.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def text_chunks(batch: pa.RecordBatch, name: str = "text", chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple]:
    """``(first row, rows, bytes, offsets)`` of consecutive rows with about ``chunk_bytes`` of text, or of one longer row."""
    column = batch.column(batch.schema.get_field_index(name))
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    ends = np.frombuffer(offsets, dtype=width)[column.offset : column.offset + n + 1].astype(np.int64)
    every = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + chunk_bytes, side="right")) - 1)
        yield row, stop - row, every[ends[row] : ends[stop]], ends[row : stop + 1] - ends[row]
        row = stop


def word_bounds(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of bytes in ``table``, and for each row the index of its first one (one more at the end)."""
    inside = table[data]
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    edges = np.unique(offsets)
    edges = edges[edges < len(data)]
    begins[edges] = inside[edges]
    edges = edges[edges > 0] - 1
    stops[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(multiplier: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers, at least, of an odd multiplier and of its inverse; tables of usual length are kept."""
    held = _POWERS.get(multiplier)
    if held is not None and len(held[0]) >= n:
        return held
    out = []
    for base in (multiplier, pow(multiplier, -1, 1 << 64)):
        steps = np.full(n, base, dtype=np.uint64)
        steps[:1] = 1
        out.append(np.multiply.accumulate(steps))
    if n <= PIECE_BYTES:
        _POWERS[multiplier] = (out[0], out[1])
    return out[0], out[1]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, multiplier: int = MULTIPLIERS[0]) -> np.ndarray:
    """A 64-bit hash of every word: the sum of its bytes times powers, from running sums over pieces of the bytes.

    Words are in order. A piece has PIECE_BYTES, or one longer word.
    """
    out = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        begin = int(starts[low])
        high = max(low + 1, int(np.searchsorted(ends, begin + PIECE_BYTES, side="right")))
        n = int(ends[high - 1]) - begin
        up, down = powers(multiplier, max(n, PIECE_BYTES))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data[begin : begin + n].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        first = starts[low:high] - begin
        out[low:high] = (sums[ends[low:high] - begin] - sums[first]) * down[first]
        low = high
    return mixed(out + (ends - starts).astype(np.uint64) * np.uint64(multiplier))


def window_hashes(words: np.ndarray, size: int, multiplier: int = MULTIPLIERS[0]) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes; runs that cross rows are included and must be left out."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(multiplier) + words[i : i + n]
    return mixed(out)


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words with one space after each, and where they start and end there."""
    lengths = ends - starts
    to = np.cumsum(lengths + 1) - (lengths + 1)
    out = np.full(int((lengths + 1).sum()), 0x20, np.uint8)
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(to, lengths) + place] = data[np.repeat(starts, lengths) + place]
    return out.tobytes(), to, to + lengths
