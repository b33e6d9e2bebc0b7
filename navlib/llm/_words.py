"""Words, hashes and windows of a whole Arrow batch at once, in numpy.

A word is a maximal run of bytes of a given class; the classes used here hold
all bytes from 0x80 on, so UTF-8 characters never break.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_U = np.uint64
_LOW = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 9)], dtype=_U)  # masks for 0 to 8 bytes


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))  # after lower-casing A-Z
NONSPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's finaliser)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of the rows); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of whole rows of about ``size`` bytes with (bytes, offsets) of the text column."""
    data, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at), data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def find_words(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte spans of all words and, per row, the index of its first word (one more at the end)."""
    inside = word[data]
    if len(data) == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    cut = offsets[:-1][offsets[:-1] < len(data)]
    before[cut] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes a step."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    length = end - start
    h = length.astype(_U) * _U(0x9E3779B97F4A7C15)
    at, left, rows = start, length, None
    while len(at):
        part = eight[at] & _LOW[np.minimum(left, 8)]
        if rows is None:
            h = mix(h ^ mix(part + _U(0x9E3779B97F4A7C15)))
        else:
            h[rows] = mix(h[rows] ^ mix(part + _U(0x9E3779B97F4A7C15)))
        more = np.flatnonzero(left > 8)
        rows = more if rows is None else rows[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def window_hashes(word_hash: np.ndarray, length: int) -> np.ndarray:
    """Rabin-Karp hashes of all runs of ``length`` words, across row borders too (see window_starts)."""
    n = len(word_hash) - length + 1
    if n <= 0:
        return np.zeros(0, _U)
    h = word_hash[:n].copy()
    for k in range(1, length):
        h *= _U(0xD6E8FEB86659FD93)
        h += word_hash[k : k + n]
    return mix(h)


def window_starts(first: np.ndarray, length: int) -> np.ndarray:
    """For each run of ``length`` words of the chunk: does it lie within one row?"""
    n = max(0, int(first[-1]) - length + 1)
    ok = np.ones(n, bool)
    for row_end in (first[1:-1],):
        low = np.maximum(row_end - length + 1, 0)
        for k in range(length - 1):
            at = low + k
            ok[at[(at < row_end) & (at < n)]] = False
    return ok


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def distinct_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.DictionaryArray:
    """The words of ``find_words`` by NONSPACE as an exact dictionary: equal words have equal indices."""
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    packed = np.ascontiguousarray(data[NONSPACE[data]])  # the bytes of all words, without what is between
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    return words.dictionary_encode()
