"""Byte-level word helpers shared by the text operators.

A batch of texts is viewed as one flat array of UTF-8 bytes with row offsets;
words are found and hashed with whole-array NumPy operations. Hashes only
select candidates or stand for words in 64-bit signatures; nothing here loops
over bytes in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_MULT = U64(0x9E3779B97F4A7C15)
CHUNK_BYTES = 2 << 20

# A-Z to a-z, every other byte as it is
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# bytes that are not white space 0x20, 0x09-0x0D
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
# digits, ASCII letters and every byte of a non-ASCII character
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = True
ALNUM[128:] = True


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()                    # views, the batch is not copied
    o = np.frombuffer(offs, dtype=np.int64 if wide else np.int32) if offs is not None and offs.size else np.zeros(1, np.int64)
    o = o[column.offset:column.offset + len(column) + 1].astype(np.int64)
    d = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d[o[0]:o[-1]], o - o[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``limit`` bytes: (first row, end row, bytes,
    offsets). A longer text is a run of its own."""
    data, offs = flat(column)
    row, n = 0, len(offs) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offs, offs[row] + limit, side="right")) - 1)
        yield row, end, data[offs[row]:offs[end]], offs[row:end + 1] - offs[row]
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift, multiply)."""
    x = x ^ (x >> U64(31))
    x = x * _MULT
    x = x ^ (x >> U64(29))
    x = x * U64(0xBF58476D1CE4E5B9)
    return x ^ (x >> U64(32))


def spans(data: np.ndarray, offs: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and each row's first word (rows + 1)."""
    inside = word_byte[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offs] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, U64), np.full(n - 1, _MULT)]), dtype=U64)


_POW = _powers(1 << 10)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word of (already lower-cased) bytes."""
    global _POW
    if not len(starts):
        return np.zeros(0, dtype=U64)
    lens = ends - starts
    longest = int(lens.max())
    if longest > len(_POW):
        _POW = _powers(1 << (longest - 1).bit_length())
    first = np.cumsum(lens) - lens
    place = np.arange(int(lens.sum()), dtype=np.int32)
    in_word = place - np.repeat(first.astype(np.int32), lens)
    terms = (data[np.repeat((starts - first).astype(np.int32), lens) + place] + U64(1)) * _POW[in_word]
    return mix(np.add.reduceat(terms, first) + lens.astype(U64) * U64(0xD6E8FEB86659FD93))


def joined(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words, by its first word (len - n + 1 values)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=U64)
    out = np.zeros(m, dtype=U64)
    for k in range(n):
        out = out * U64(0x100000001B3) + hashes[k:k + m]
    return mix(out)


def runs_in_rows(word_of_row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, row) of each run of n words that lies within one row."""
    counts = np.maximum(np.diff(word_of_row) - n + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) - np.repeat(first, counts) + word_of_row[:-1][rows], rows
