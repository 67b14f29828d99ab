"""Periodic runs of words, found on a Re-Pair grammar of every text.

A run is a stretch of consecutive words with smallest period p, of at least
``EXPONENT`` periods and ``LEAST`` words, that no neighbouring word extends. Texts
become word numbers, and a batch's texts one grammar (``repair``):

1. A run that lies in the derivation tree has a lowest node that covers it, and
   crosses the boundary between that node's two parts. The start rule's symbols
   are joined two by two, so that it has such nodes too.
2. For each nonterminal, and each node of the start rule, the runs that cross its
   boundary are found once, at its first derivation position. A run of four
   periods has two whole ones on one side of the boundary, so a period counts
   only if the two blocks of that size next to the boundary are equal; equal
   stretches are measured by halving on prefix hashes.
3. Runs of a nonterminal go to all its derivation positions. Intervals of one
   period that share a whole period are merged, which leaves the maximal ones;
   of several periods of the same interval the smallest stays.
4. Every run is compared word by word at the end. A hash collision could only
   add a false one; then the batch is worked again with another hash.

Texts are independent, nothing is shuffled; a text's words must fit in a task.
Words are told apart by 64-bit hashes.

Defined cases: null, empty and wordless texts have no words and no runs; a
text of any length is worked as a whole; repeated rows and equal or null doc_ids
are rows of their own; an empty table gives no rows. Kept columns may have any
names but those of the result, which replace them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from lakegraph.llm import repair, store, words

EXPONENT, LEAST = 4, 6
RESULT = "n_words long, n_runs long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_SLICE = 1 << 20                        # (node, period) pairs tried together
_TEXTS = 1 << 21                        # bytes of texts worked together


class _Equal:
    """Equality of stretches of a number sequence, by prefix hashes modulo 2^64."""

    def __init__(self, ids: np.ndarray, salt: int):
        base = words.mix(np.array([salt + 1], dtype=words.U64))[0] | words.U64(1)
        self.power = np.cumprod(np.concatenate([np.ones(1, words.U64), np.full(len(ids), base)]), dtype=words.U64)
        terms = words.mix(ids.astype(words.U64) + words.U64(salt * 0x9E3779B97F4A7C15 % (1 << 64))) * self.power[:-1]
        self.sums = np.concatenate([np.zeros(1, words.U64), np.cumsum(terms, dtype=words.U64)])

    def __call__(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the n numbers from a equal those from b > a."""
        return (self.sums[a + n] - self.sums[a]) * self.power[b - a] == self.sums[b + n] - self.sums[b]

    def ahead(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the equal stretches from a and b > a, up to ``most``."""
        low, high = np.zeros(len(a), dtype=np.int64), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self(a, b, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def behind(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the equal stretches that end before a and b > a."""
        low, high = np.zeros(len(a), dtype=np.int64), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self(a - mid, b - mid, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low


def _crossing(ids: np.ndarray, equal: _Equal, begin: np.ndarray, cut: np.ndarray, end: np.ndarray):
    """(node, start, end, period) of the runs within [begin, end) that cross
    ``cut``, for each node."""
    most = np.where(end - begin >= LEAST, (end - begin) // EXPONENT, 0)
    nodes = np.flatnonzero(most > 0)
    found = []
    total = np.concatenate([[0], np.cumsum(most[nodes])])
    k = 0
    while k < len(nodes):
        to = max(k + 1, int(np.searchsorted(total, total[k] + _SLICE, side="right")) - 1)
        some = nodes[k:to]
        node = np.repeat(some, most[some])
        p = np.arange(len(node)) - np.repeat(total[k:to] - total[k], most[some]) + 1
        b, m, e = begin[node], cut[node], end[node]
        # two equal blocks behind the boundary
        i = np.flatnonzero(m + 2 * p <= e)
        i = i[(ids[m[i]] == ids[m[i] + p[i]]) & (ids[m[i] - 1] == ids[m[i] + p[i] - 1])]
        i = i[equal(m[i], m[i] + p[i], p[i])]
        start = m[i] - equal.behind(m[i], m[i] + p[i], m[i] - b[i])
        stop = m[i] + p[i] + equal.ahead(m[i], m[i] + p[i], e[i] - m[i] - p[i])
        found.append((node[i], start, stop, p[i]))
        # or in front of it
        i = np.flatnonzero(m - 2 * p >= b)
        i = i[(ids[m[i] - 1] == ids[m[i] - 1 - p[i]]) & (ids[m[i]] == ids[m[i] - p[i]])]
        i = i[equal(m[i] - 2 * p[i], m[i] - p[i], p[i])]
        start = m[i] - p[i] - equal.behind(m[i] - p[i], m[i], m[i] - p[i] - b[i])
        stop = m[i] + equal.ahead(m[i] - p[i], m[i], e[i] - m[i])
        found.append((node[i], start, stop, p[i]))
        k = to
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    node, start, stop, p = (np.concatenate(x) for x in zip(*found, strict=True))
    keep = stop - start >= np.maximum(LEAST, EXPONENT * p)
    return node[keep], start[keep], stop[keep], p[keep]


def _merged(start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal intervals: those of one period that share a period's words become
    one; equal intervals keep their smallest period. Ordered by start, period."""
    if not len(start):
        return start, stop, period
    order = np.lexsort((start, period))
    start, stop, period = start[order], stop[order], period[order]
    wide = int(stop.max()) + 1
    far = np.maximum.accumulate(period * wide + stop)   # furthest end so far, of one period at a time
    new = np.ones(len(start), dtype=bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] > far[:-1] - period[:-1] * wide - period[1:])
    heads = np.flatnonzero(new)
    start, period = start[heads], period[heads]
    stop = np.maximum.reduceat(stop, heads)
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[first], stop[first], period[first]
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


def _right(ids: np.ndarray, start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> bool:
    """Whether every run holds, word by word, and no neighbour extends it."""
    for lo in range(0, len(start), 256):
        s, e, p = start[lo:lo + 256], stop[lo:lo + 256], period[lo:lo + 256]
        n = e - s - p
        at = np.arange(int(n.sum())) + np.repeat(s - np.cumsum(n) + n, n)
        if (ids[at] != ids[at + np.repeat(p, n)]).any():
            return False
        before, behind = s > 0, e < len(ids)
        if (ids[s[before] - 1] == ids[s[before] - 1 + p[before]]).any() or (ids[e[behind]] == ids[e[behind] - p[behind]]).any():
            return False
    return True


def runs(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, period) of all runs of sequences that stand one behind the
    other, the k-th at ``first[k]:first[k + 1]``; they share no number."""
    g = repair.grammar(ids)
    # nonterminals at their first derivation positions
    rep = np.searchsorted(g.of, np.arange(len(g.size)))
    begin = g.at[rep] if len(rep) else g.at
    cut, end = begin + g.left, begin + g.size
    # nodes of the start rules: symbol k is the middle of one that reaches as far as k's lowest bit
    head = np.searchsorted(g.starts, first)             # first symbol of each sequence
    row = np.repeat(np.arange(len(first) - 1), np.diff(head))
    k = np.arange(len(g.starts)) - head[:-1][row]
    inner = np.flatnonzero(k > 0)
    reach = k[inner] & -k[inner]
    edges = np.append(g.starts, len(ids))
    begin = np.concatenate([begin, g.starts[inner - reach]])
    cut = np.concatenate([cut, g.starts[inner]])
    end = np.concatenate([end, np.minimum(edges[np.minimum(inner + reach, head[1:][row[inner]])], first[1:][row[inner]])])
    salt = 1
    while True:
        equal = _Equal(ids, salt)
        node, start, stop, period = _crossing(ids, equal, begin, cut, end)
        own = node < len(g.size)                        # to all derivation positions
        times = np.searchsorted(g.of, node[own], side="right") - np.searchsorted(g.of, node[own])
        place = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        shift = g.at[np.repeat(np.searchsorted(g.of, node[own]), times) + place] - np.repeat(begin[node[own]], times)
        start = np.concatenate([start[~own], np.repeat(start[own], times) + shift])
        stop = np.concatenate([stop[~own], np.repeat(stop[own], times) + shift])
        period = np.concatenate([period[~own], np.repeat(period[own], times)])
        start, stop, period = _merged(start, stop, period)
        if _right(ids, start, stop, period):
            return start, stop, period
        salt += 1


def _texts(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> pa.Array:
    """The words start:end of each row, joined by one blank."""
    lens = end - start + 1                              # with the blank behind
    total = np.concatenate([[0], np.cumsum(lens)])
    out = np.full(int(total[-1]), 32, dtype=np.uint8)
    place = np.arange(len(out)) - np.repeat(total[:-1], lens)
    inside = place < np.repeat(lens - 1, lens)
    out[inside] = data[np.repeat(start, lens)[inside] + place[inside]]
    bounds = total[first]
    some = np.diff(first) > 0
    drop = bounds[1:][some] - 1                         # the blank behind a row's last word
    out = np.delete(out, drop)
    bounds = bounds - np.concatenate([[0], np.cumsum(some)])
    return pa.LargeStringArray.from_buffers(len(first) - 1, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes()))


def _measure(data: np.ndarray, offs: np.ndarray) -> list[pa.Array]:
    """The RESULT columns of a chunk of texts."""
    begin, end, first = words.spans(data, offs, words.NOT_SPACE)
    h = words.word_hashes(data, begin, end)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    ids = np.unique(h ^ words.mix(row.astype(words.U64) + words.U64(1)), return_inverse=True)[1]     # rows share no number
    start, stop, period = runs(ids, first)
    of = np.searchsorted(first, start, side="right") - 1
    bounds = np.searchsorted(of, np.arange(len(offs)))
    found = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(x, pa.int64()) for x in (start - first[of], stop - start, period)], names=["start", "length", "period"]))
    gone = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, stop, -1)
    kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
    return [pa.array(np.diff(first), pa.int64()), pa.array(np.diff(bounds), pa.int64()), found,
            _texts(data, begin[kept], end[kept], np.searchsorted(kept, first)).cast(pa.string())]


def find_runs(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns of every row, and the RESULT columns: number of words,
    runs by start and period (word numbers from 0), and the text with what each
    run repeats after its first period left out, words joined by one blank."""
    result = StructType.fromDDL(RESULT)
    keep = tuple(c for c in keep if c not in result.names)
    schema = StructType([docs.schema[c] for c in keep] + result.fields)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # kept columns come first; the text may be one of them
            for row, end, data, offs in words.chunks(b[b.num_columns - 1], _TEXTS):
                own = [b[k].slice(row, end - row) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*own, *_measure(data, offs)], names=names)
        store.release()

    return docs.select(*keep, docs["text"].alias(store.free_name(keep, "_text"))).mapInArrow(run, schema)
