"""Elias-Fano coding of sorted integers in flat, mappable arrays.

The low bits stand packed at fixed width; the high bits are a bit vector with
a one per value and a zero per high part. The number of ones (or zeros) before
every 64 bits is counted when first asked for. ``at`` reads values by number,
``find`` returns the number of an equal value; both work on whole arrays of
queries.
"""

from __future__ import annotations

import numpy as np

BLOCK = 512
_AT_ONCE = 1 << 16
_U = np.uint64
_IN_BYTE = np.full((256, 9), 8, dtype=np.uint8)
for _b in range(256):
    _places = [i for i in range(8) if _b >> i & 1]
    _IN_BYTE[_b, :len(_places)] = _places
_L8, _H8 = _U(0x0101010101010101), _U(0x8080808080808080)        # a one in, the top bit of, each byte
_M1, _M2, _M4 = _U(0x5555555555555555), _U(0x3333333333333333), _U(0x0F0F0F0F0F0F0F0F)
FIELDS = ("low", "high")


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Arrays of non-decreasing values below ``universe``."""
    v = values.astype(_U)
    n = len(v)
    width = max(0, int(max(universe, 1) // max(n, 1)).bit_length() - 1)
    packed = np.zeros(-(-n * width // 64) + 1, dtype=_U)
    for lo in range(0, n if width else 0, _AT_ONCE):    # packed in runs of whole words
        part = v[lo:lo + _AT_ONCE] & _U((1 << width) - 1)
        bit = np.arange(lo * width, (lo + len(part)) * width, width)
        word, shift = bit >> 6, (bit & 63).astype(_U)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        packed[word[first]] = np.bitwise_or.reduceat(part << shift, first)
        over = np.flatnonzero(shift + _U(width) > _U(64))           # goes on in the next word, where no other one begins before it
        packed[word[over] + 1] |= part[over] >> (_U(64) - shift[over])
    low = packed.view(np.uint8)
    high = (v >> _U(width)).astype(np.int64)
    n_high = int(universe >> width) + 1
    ones = high + np.arange(n)
    size = n + n_high
    bits = np.zeros(size + (-size) % BLOCK, dtype=np.uint8)
    bits[ones] = 1
    return {"low": low, "high": np.packbits(bits, bitorder="little").view(np.uint64),
            "head": np.array([n, universe, width, size], dtype=np.int64)}


class EliasFano:
    def __init__(self, parts: dict[str, np.ndarray]):
        self.n, self.universe, self.width, self.size = (int(x) for x in parts["head"])
        self.low, self.high = (parts[f] for f in FIELDS)
        self.ranks: dict[bool, np.ndarray] = {}
        self.loose = np.ndarray(shape=(len(self.low) - 7,), dtype="<u8", buffer=self.low, strides=(1,))

    def _low(self, i: np.ndarray) -> np.ndarray:
        """The low bits of values by number; up to 57 bits wide."""
        if not self.width:
            return np.zeros(len(i), dtype=_U)
        at = i * self.width
        return (self.loose[at >> 3] >> (at & 7).astype(_U)) & _U((1 << self.width) - 1)

    def _rank(self, of_one: bool) -> np.ndarray:
        """Ones (or zeros) before each word of the bit vector, and in all."""
        if of_one not in self.ranks:
            n = np.bitwise_count(self.high if of_one else ~self.high)
            rank = np.zeros(len(n) + 1, dtype=np.uint32 if len(n) < 1 << 26 else np.int64)
            np.cumsum(n, out=rank[1:])
            self.ranks[of_one] = rank
        return self.ranks[of_one]

    def _select(self, k: np.ndarray, of_one: bool) -> np.ndarray:
        """Place of the k-th one (or zero): its word by the ranks, its bit by
        the words' counts per byte."""
        rank = self._rank(of_one)
        out = np.empty(len(k), dtype=np.int64)
        for first in range(0, len(k), _AT_ONCE):
            part = k[first:first + _AT_ONCE]
            word = np.searchsorted(rank, part.astype(rank.dtype), side="right") - 1
            bits = self.high[word] if of_one else ~self.high[word]
            out[first:first + _AT_ONCE] = word * 64 + self._in_word(bits, (part - rank[word]).astype(_U))
        return out

    @staticmethod
    def _in_word(bits: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Place in each word of its one number ``left``."""
        n = bits - ((bits >> _U(1)) & _M1)
        n = (n & _M2) + ((n >> _U(2)) & _M2)
        upto = ((n + (n >> _U(4))) & _M4) * _L8          # ones up to and with each byte
        byte8 = np.bitwise_count(((left * _L8 | _H8) - upto) & _H8).astype(_U) << _U(3)
        before = ((upto << _U(8)) >> byte8) & _U(255)
        return (byte8 + _IN_BYTE[((bits >> byte8) & _U(255)).astype(np.intp), (left - before).astype(np.intp)]).astype(np.int64)

    def at(self, i: np.ndarray) -> np.ndarray:
        """Values by number."""
        high = (self._select(i, True) - i).astype(_U)
        return (high << _U(self.width) | self._low(i)).astype(np.int64)

    def find(self, x: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Number of a value equal to each x, -1 without one; only among the
        values begin (included) to end of each x where those are given. The
        values that share x's high part stand between two zeros; the successor
        of x's low part among them is found by halving that range."""
        out = np.full(len(x), -1, dtype=np.int64)
        if not self.n or not len(x):
            return out
        todo = np.flatnonzero((x >= 0) & (x < self.universe))
        high = x[todo] >> self.width
        place = np.zeros(len(todo), dtype=np.int64)
        later = np.flatnonzero(high > 0)
        place[later] = self._select(high[later] - 1, False) + 1
        lo = place - high                                # ones before the range
        # the ones that follow in this word, but where they may go on in the next
        bits = self.high[place >> 6] >> (place & 63).astype(_U)
        ones = np.bitwise_count((bits ^ (bits + _U(1))) >> _U(1)).astype(np.int64)
        on = np.flatnonzero(ones + (place & 63) >= 63)
        ones[on] = self._select(high[on], False) - place[on]
        hi = lo + ones
        if begin is not None:
            lo, hi = np.maximum(lo, begin[todo]), np.minimum(hi, end[todo])
        some = hi > lo
        todo, lo, hi = todo[some], lo[some], hi[some]
        low = (x[todo] & ((1 << self.width) - 1)).astype(_U)
        while len(todo):
            mid = (lo + hi) >> 1
            got = self._low(mid)
            equal = got == low
            out[todo[equal]] = mid[equal]
            below = got < low
            lo, hi = np.where(below, mid + 1, lo), np.where(below, hi, mid)
            go = ~equal & (lo < hi)
            todo, lo, hi, low = todo[go], lo[go], hi[go], low[go]
        return out
