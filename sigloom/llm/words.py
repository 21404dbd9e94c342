"""Words of whole texts and hashes of word sequences, over the bytes of an Arrow batch.

Words are the maximal runs of bytes outside ``\\x20\\x09-\\x0D``. A word's hash takes in
eight bytes at a time through a mixing step that is not linear, and a sequence's
hash is made of those of its halves in the same way, so that no pattern of bytes
or words cancels out. Two different words or sequences of equal length agree with a chance of 2**-64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Odd multipliers that set the left part of a sequence apart from the right one, and a start for every hash.
LEFT, SEED = U(0x9E3779B97F4A7C15), U(0x632BE59BD9B4E019)
#: The low bytes of eight that a word of so many bytes has.
LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Bytes of text taken at once (a longer text is one block), words and bytes handled at once inside it, and the longest word hashed by steps of eight.
BLOCK, WORDS, PIECE, LONG = 1 << 18, 1 << 16, 1 << 20, 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and where each text begins (n + 1 offsets); null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about BLOCK bytes, or one long row."""
    data, at = texts(column)
    n, i = len(at) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + BLOCK, "right")) - 1)
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def words(data: np.ndarray, at: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and stop of every word in the bytes, and the first word of each text (n + 1)."""
    starts, stops = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for x in range(0, len(data), PIECE):
        # a byte more on either side shows whether a word goes on there
        y = min(len(data), x + PIECE)
        low, high = max(0, x - 1), min(len(data), y + 1)
        ink = np.zeros(y - x + 2, bool)
        ink[low - x + 1 : high - x + 1] = ~blank[data[low:high]]
        begins, ends = ink[1:-1] & ~ink[:-2], ink[1:-1] & ~ink[2:]
        edges = at[(at > 0) & (at < len(data))]
        first, last = edges[(edges >= x) & (edges < y)] - x, edges[(edges > x) & (edges <= y)] - x - 1
        begins[first] |= ink[1:-1][first]
        ends[last] |= ink[1:-1][last]
        starts.append(np.flatnonzero(begins) + x)
        stops.append(np.flatnonzero(ends) + x + 1)
    start, stop = np.concatenate(starts), np.concatenate(stops)
    return start, stop, np.searchsorted(start, at) if len(data) else np.zeros(len(at), np.int64)


def _eights(data: np.ndarray, fold: bool) -> np.ndarray:
    """For every place the number that the eight bytes from it on make."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = LOWER[data] if fold else data
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray, fold: bool = False) -> np.ndarray:
    """A hash of each word; with ``fold`` A-Z count as a-z."""
    eights, out = _eights(data, fold), np.empty(len(start), np.uint64)
    for x in range(0, len(start), WORDS):
        begin, length = start[x : x + WORDS], stop[x : x + WORDS] - start[x : x + WORDS]
        h = mix((eights[begin] & LOW[np.minimum(length, 8)]) ^ (length.astype(np.uint64) * LEFT + SEED))
        for k in range(8, LONG, 8):
            more = np.flatnonzero(length > k)
            if not len(more):
                break
            h[more] = mix(h[more] * LEFT + (eights[begin[more] + k] & LOW[np.minimum(length[more] - k, 8)]))
        for i in np.flatnonzero(length > LONG).tolist():
            word = data[begin[i] : begin[i] + length[i]]
            h[i] = int.from_bytes(hashlib.blake2b((LOWER[word] if fold else word).tobytes(), digest_size=8).digest(), "little")
        out[x : x + WORDS] = h
    return out


def beginnings(data: np.ndarray, start: np.ndarray, size: int, fold: bool = True) -> np.ndarray:
    """A hash of the first ``size`` (8 at most) bytes of words that have as many."""
    return mix((_eights(data, fold)[start] & LOW[size]) ^ (U(size) * SEED + LEFT))


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words, made of runs of one, two, four and so on."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, have, level, width = None, 0, hashes, 1
    while True:
        if size & width:
            part = level[have : have + n]
            out = mix(part + SEED) if out is None else mix(out * LEFT + part)
            have += width
        if have == size:
            return out
        level = mix(level[:-width] * LEFT + level[width:])
        width *= 2


def windows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all runs of ``size`` words within one text, and the text each is in."""
    count = np.maximum(np.diff(first) - size + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    return first[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count), text
