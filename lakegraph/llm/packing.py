"""Sum-of-squares packing of documents into fixed-length token sequences.

Documents longer than a sequence are cut; the first piece takes the remainder
and the others are full. Pieces are dealt evenly over blocks of bounded size.
In a block each piece goes where the sum over residual gaps of the squared
number of open bins with that gap becomes smallest, largest pieces first. Bins
that are not full are dealt over fewer blocks and packed again, until one block
holds the rest (or the rounds end). The last round also tries large pieces first
with the rest mixed; of either packing the bins left partly empty are opened and their
pieces placed again, best gap first, while that saves a bin; the one that needs fewer
bins stays. No piece is left out.

Defined cases: a null or empty text has just the end id; repeated documents
are packed once per row; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegraph.llm import store, tokens

LENGTH, END = 1024, 2
BLOCK = 16_384              # pieces packed together
ROUNDS = 4
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                     ("length", pa.int64()), ("ids_crc32", pa.int64())])


def pieces(docs: DataFrame, tokenizer: str, byte_level: bool = True, length: int = LENGTH) -> DataFrame:
    """The pieces of every document, with the CRC-32 of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer, byte_level, END)
        for b in batches:
            for first, found in enc.batches(b["text"]):
                rows = []
                for doc, ids in zip(b["doc_id"].slice(first, len(found)).to_pylist(), found, strict=True):
                    n = len(ids)
                    cuts = [0, *range(n % length or length, n + 1, length)]
                    rows += [(doc, k, s, e - s, zlib.crc32(ids[s:e])) for k, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECES, strict=True)], schema=_PIECES)
        tokens.release()

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def arrivals(sizes: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """Orders to try: largest first; more than half a bin first, then mixed."""
    down = np.argsort(-sizes, kind="stable")
    large = int((2 * sizes > length).sum())
    return [down, np.concatenate([down[:large], np.random.default_rng(len(sizes)).permutation(down[large:])])]


def sum_of_squares(sizes: np.ndarray, length: int = LENGTH, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size, placed in the given order."""
    n = len(sizes)
    order = arrivals(sizes, length)[0] if order is None else order
    where, offset = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    open_bins = np.zeros(length + 1, dtype=np.int64)        # number of bins by residual gap
    by_gap: list[list[int]] = [[] for _ in range(length + 1)]
    bins = 0
    for i in order.tolist():
        s = int(sizes[i])
        # a bin of gap g becomes one of gap g - s; gap 0 is closed and counts as none
        gaps = np.flatnonzero(open_bins[s:length + 1]) + s
        best, best_cost = -1, 2 * int(open_bins[length - s]) + 1 if s < length else 0
        if len(gaps):
            after = open_bins[gaps - s]
            after = np.where(gaps == s, 0, 2 * after + 1)
            cost = after - 2 * open_bins[gaps] + 1
            k = int(np.argmin(cost))
            if cost[k] <= best_cost:
                best, best_cost = int(gaps[k]), int(cost[k])
        if best < 0:
            b, gap, bins = bins, length, bins + 1
        else:
            b, gap = by_gap[best].pop(), best
            open_bins[best] -= 1
        where[i], offset[i] = b, length - gap
        if gap > s:
            by_gap[gap - s].append(b)
            open_bins[gap - s] += 1
    return where, offset


def best_gap(sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size, largest first, each in the open bin with the
    smallest gap that holds it."""
    where, offset = np.empty(len(sizes), dtype=np.int64), np.empty(len(sizes), dtype=np.int64)
    open_bins = np.zeros(length + 1, dtype=bool)            # whether there is a bin with this gap
    by_gap: list[list[int]] = [[] for _ in range(length + 1)]
    bins = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        k = int(open_bins[s:].argmax())
        if open_bins[s + k]:
            gap = s + k
            b = by_gap[gap].pop()
            open_bins[gap] = bool(by_gap[gap])
        else:
            b, gap, bins = bins, length, bins + 1
        where[i], offset[i] = b, length - gap
        if gap > s:
            by_gap[gap - s].append(b)
            open_bins[gap - s] = True
    return where, offset


def reopened(sizes: np.ndarray, where: np.ndarray, offset: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The packing after the pieces of bins left partly empty are placed again,
    best gap first, as long as that saves a bin. Bins are numbered from 0."""
    while True:
        fill = np.bincount(where, weights=sizes).astype(np.int64)
        part = np.flatnonzero(fill[where] < length)
        if not len(part):
            return where, offset
        again, at = best_gap(sizes[part], length)
        if again.max() + 1 >= (fill < length).sum():
            return where, offset
        full = np.flatnonzero(fill == length)
        number = np.full(len(fill), -1, dtype=np.int64)
        number[full] = np.arange(len(full))
        where, offset = number[where], offset.copy()
        where[part], offset[part] = len(full) + again, at


_PACKED = pa.schema([*_PIECES, ("block", pa.int64()), ("bin", pa.int64()), ("offset", pa.int64()), ("fill", pa.int64())])
PACKED = PIECES + ", block long, bin long, offset long, fill long"


def _pack_block(length: int, last: bool):
    def run(group: pa.Table) -> pa.Table:
        sizes = group["length"].to_numpy()
        if last:
            where, offset = min((reopened(sizes, *sum_of_squares(sizes, length, x), length) for x in arrivals(sizes, length)), key=lambda r: int(r[0].max()))
        else:
            where, offset = sum_of_squares(sizes, length)
        fill = np.bincount(where, weights=sizes)[where].astype(np.int64)
        cols = [group[c] for c in _PIECES.names] + [group["block"], pa.array(where), pa.array(offset), pa.array(fill)]
        return pa.table(cols, schema=_PACKED)
    return run


def pack(items: DataFrame, length: int = LENGTH, block: int = BLOCK, rounds: int = ROUNDS) -> DataFrame:
    """Adds sequence_id and offset to PIECES rows."""
    rest = store.saved(items, "pieces")
    done: list[DataFrame] = []
    n = rest.count()
    for step in range(rounds):
        blocks = max(1, -(-n // block))
        # row numbers of a written table: equal rows spread over blocks as well
        dealt = rest.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))
        last = blocks == 1 or step == rounds - 1
        packed = store.saved(dealt.groupBy("block").applyInArrow(_pack_block(length, last), PACKED), "packed")
        number = F.lit(step << 58) + F.col("block") * (1 << 20) + F.col("bin")
        good = F.lit(True) if last else F.col("fill") == length
        done.append(packed.filter(good).withColumn("sequence_id", number))
        if last:
            break
        rest = packed.filter(~good).select(*_PIECES.names)
        n = rest.count()
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out.select(*_PIECES.names, "sequence_id", "offset")
