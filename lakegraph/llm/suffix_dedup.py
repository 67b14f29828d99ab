"""Removal of byte strings that repeat an earlier document, exactly.

A byte goes when a string of ``SIZE`` bytes that covers it also starts in a
document with a smaller doc_id. All repeats are found by suffix arrays:

1. Documents are written as block files of some megabytes.
2. Anchors: of the 24-byte strings within every 50-byte string, those with the
   smallest hash. Equal 50-byte strings have equal anchors at equal places, so
   a repeat always shows as a shared anchor. The anchors' hashes, packed by
   hash range, meet in buckets; each block learns which are shared.
3. A shared anchor's context is all that a 50-byte string around it can reach:
   26 bytes to the left, 50 to the right from the anchor's start. Blocks send
   their distinct contexts with the smallest doc_id to the anchors' buckets.
4. A bucket cuts contexts where any two contexts of one anchor part, so that a
   context is a short string of symbols, and builds one suffix array over all
   of them by linear grouping. For every suffix the longest prefix shared with
   a smaller document gives how far the repeat reaches.
5. Blocks apply the reaches to all their occurrences and judge their rows.

Only small rows (paths, packed messages) are shuffled; a block's or bucket's
work is bounded by its size in bytes. A context that many documents hold is
sent once per block. A bucket holds the distinct contexts of its anchors.

Defined cases: a null text is empty; a null doc_id is larger than any other;
documents with equal doc_id take nothing from each other; texts shorter than
SIZE are kept; an empty table gives no rows. A text cut inside a character
loses the rest of that character when it is decoded (``text`` output only).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakegraph.llm import store, words
from lakegraph.llm.suffix_array import common_prefixes, longest_with_smaller, suffix_array

SIZE, ANCHOR = 50, 24
LEFT = SIZE - ANCHOR
BLOCK_BYTES, BUCKET_BYTES = 4 << 20, 2 << 20
BLOCKS_PER_TASK = 4
PIECE = 1 << 16                         # bytes whose anchors are found together
SLICE = 1 << 14                         # contexts worked together
PAD = 256                               # stands for "no byte" in a context
_U = words.U64
LAST = 2 ** 63 - 1


# ---- anchors -------------------------------------------------------------

def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over x[i:i + width], cut at the end."""
    step, out = 1, x
    while step * 2 <= width:
        nxt = out.copy()
        pick(out[:-step], out[step:], out=nxt[:-step])
        out, step = nxt, step * 2
    rest = width - step
    if rest:
        nxt = out.copy()
        pick(out[:-rest], out[rest:], out=nxt[:-rest])
        out = nxt
    return out


def _anchors_of(data: np.ndarray, ends: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the anchors of the documents that fill ``data``."""
    n = len(data)
    if n < SIZE:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    g = words.mix(data + _U(1))
    grams = {1: g}
    for k in (1, 2, 4, 8):
        a = grams[k]
        b = np.zeros_like(a)
        b[:n - k] = a[:n - k] * _U(0x9E3779B97F4A7C15) + a[k:]
        grams[2 * k] = b
    h = np.zeros(n, dtype=_U)
    h[:n - 16] = grams[16][:n - 16] * _U(0xC2B2AE3D27D4EB4F) + grams[8][16:]
    h = words.mix(h)
    low = (h >> _U(32)).astype(np.uint32) | np.uint32(1)
    least = _slide(low, LEFT + 1, np.minimum)            # of the 50 bytes from here
    real = np.zeros(n + 1, dtype=np.int8)                # where 50 bytes lie in one document
    long = lens >= SIZE
    np.add.at(real, (ends - lens)[long], 1)
    np.add.at(real, ends[long] - SIZE + 1, -1)
    least[np.cumsum(real[:-1]) == 0] = 0
    back = _slide(least[::-1], LEFT + 1, np.maximum)[::-1]
    at = np.flatnonzero(back == low)
    # the smallest of their neighbours: mixed again (one to one), so that ranges
    # of hashes, the buckets, hold equally many
    return at, words.mix(h[at])


def anchors(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place in the block, hash) of all anchors of a block's rows."""
    rows, places, hashes = [], [], []
    row, n = 0, len(offs) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offs, offs[row] + PIECE, side="right")) - 1)
        lens = np.diff(offs[row:end + 1])
        at, h = _anchors_of(data[offs[row]:offs[end]], offs[row + 1:end + 1] - offs[row], lens)
        places.append(at + offs[row])
        hashes.append(h)
        rows.append(np.searchsorted(offs[1:], places[-1], side="right"))
        row = end
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    return np.concatenate(rows), np.concatenate(places), np.concatenate(hashes)


# ---- messages ------------------------------------------------------------

def _squeeze(values: np.ndarray) -> bytes:
    """Any array as bytes in planes, compressed."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def _spread(message: bytes, kind, width: int = 1) -> np.ndarray:
    n = int.from_bytes(message[:8], "little")
    kind = np.dtype(kind)
    if not n:
        return np.zeros((0, width) if width > 1 else 0, dtype=kind)
    raw = np.frombuffer(pa.decompress(message[8:], n, codec="zstd", asbytes=True), dtype=np.uint8)
    out = np.ascontiguousarray(raw.reshape(kind.itemsize * width, -1).T).view(kind)
    return out.reshape(-1, width) if width > 1 else out.ravel()


def _sorted_out(v: np.ndarray) -> bytes:
    return _squeeze(np.diff(v, prepend=v.dtype.type(0)))


def _sorted_in(message: bytes, kind) -> np.ndarray:
    return np.cumsum(_spread(message, kind), dtype=kind)


def _orders(ids: pa.Array) -> np.ndarray:
    return ids.fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)


# ---- stage 1: blocks and anchor hashes ---------------------------------------

def _write_blocks(docs: DataFrame, folder: str) -> DataFrame:
    """(file): block files of whole rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, made = [], 0, []

        def flush() -> str:
            path = store.task_file(folder, f"-{len(made)}.arrow")
            table = pa.Table.from_batches(held).combine_chunks()
            with store.open_output(path) as out, pa.ipc.new_file(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as f:
                f.write_table(table)
            made.append(path)
            return path

        for b in batches:
            for row, end, data, _ in words.chunks(b["text"], BLOCK_BYTES // 4):
                held.append(b.slice(row, end - row))
                size += len(data)
                if size >= BLOCK_BYTES:
                    yield pa.RecordBatch.from_pydict({"file": [flush()]})
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"file": [flush()]})
        held = []
        store.release()

    return store.saved(docs.mapInArrow(run, "file string"), "dedup-blocks")


def _block(path: str) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """(rows, bytes, offsets, order of the documents) of a block file."""
    table = pa.ipc.open_file(store.open_input(path)).read_all()
    data, offs = words.flat(table["text"])
    return table, data, offs, _orders(table["doc_id"].combine_chunks())


def _runs(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets that sorted hashes fall into, where each one's run begins, and
    the end)."""
    of = ((hashes >> _U(40)) * _U(buckets)) >> _U(24)
    head = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    return of[head].astype(np.int64), np.append(head, len(of))


def _distinct(order: np.ndarray, row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes, number of each occurrence's hash, whether several
    documents of the block hold it)."""
    unique, of = np.unique(h, return_inverse=True)
    doc = order[row]
    lo, hi = np.full(len(unique), LAST), np.full(len(unique), -LAST - 1)
    np.minimum.at(lo, of, doc)
    np.maximum.at(hi, of, doc)
    return unique, of, lo != hi


def _send_hashes(blocks: DataFrame, buckets: int, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b["file"].to_pylist():
                _, data, offs, order = _block(path)
                row, _, h = anchors(data, offs)
                unique, _, several = _distinct(order, row, h)
                used, cut = _runs(unique, buckets)
                parts = list(zip(cut[:-1], cut[1:], strict=True))
                short = unique >> _U(64 - bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int64()), pa.array([path] * len(used), pa.string()),
                     pa.array([_sorted_out(short[i:j]) for i, j in parts], pa.binary()),
                     pa.array([np.packbits(several[i:j]).tobytes() for i, j in parts], pa.binary())],
                    names=["bucket", "file", "hashes", "several"])
        store.release()

    return blocks.mapInArrow(run, "bucket long, file string, hashes binary, several binary")


def _answer_hashes(group: pa.Table) -> pa.Table:
    """Bits of each block's hashes that other blocks, or several of its own
    documents, hold as well."""
    hashes = [_sorted_in(x.as_py(), _U) for x in group["hashes"]]
    known = [np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(h)).astype(bool) for x, h in zip(group["several"], hashes, strict=True)]
    whole = np.concatenate(hashes)
    order = np.argsort(whole, kind="stable")
    s = whole[order]
    again = np.zeros(len(s), dtype=bool)
    again[1:] = s[1:] == s[:-1]
    again[:-1] |= again[1:]
    shared = np.zeros(len(s), dtype=bool)
    shared[order] = again
    shared |= np.concatenate(known)
    cut = np.cumsum([0] + [len(h) for h in hashes])
    return pa.table({"bucket": group["bucket"], "file": group["file"],
                     "shared": pa.array([np.packbits(shared[a:b]).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())})


# ---- stage 2: contexts --------------------------------------------------------

def _contexts(data: np.ndarray, offs: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Context of each anchor: LEFT bytes before it, nearest first, then SIZE
    bytes from its start; PAD beyond the document."""
    padded = np.concatenate([np.zeros(LEFT, np.uint8), data, np.zeros(SIZE, np.uint8)])
    around = np.lib.stride_tricks.sliding_window_view(padded, LEFT + SIZE)[at]
    out = np.empty((len(at), LEFT + SIZE), dtype=np.uint16)
    out[:, :LEFT] = around[:, LEFT - 1::-1]
    out[:, LEFT:] = around[:, LEFT:]
    before, behind = at - offs[row], offs[row + 1] - at
    for edge, room, first in ((before < LEFT, before, 0), (behind < SIZE, behind, LEFT)):
        i = np.flatnonzero(edge)
        width = LEFT if first == 0 else SIZE
        beyond = np.arange(width) >= room[i][:, None]
        part = out[i, first:first + width]
        part[beyond] = PAD
        out[i, first:first + width] = part
    return out


def _same_contexts(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row of each distinct context, number of each row's context), in
    order of the anchor's hash. A hash of the bytes sorts, the bytes decide; a
    collision can only leave equal contexts apart, which changes no result."""
    wide = np.ascontiguousarray(c).view(_U)
    mixed = np.zeros(len(h), dtype=_U)
    for k in range(wide.shape[1]):
        mixed = (mixed ^ wide[:, k]) * _U(0x9E3779B97F4A7C15)
        mixed ^= mixed >> _U(29)
    order = np.lexsort((mixed, h))
    new = np.ones(len(h), dtype=bool)
    same = (h[order][1:] == h[order][:-1]) & (mixed[order][1:] == mixed[order][:-1])
    at = np.flatnonzero(same) + 1
    for lo in range(0, len(at), 1 << 14):                # the rows compared are copied, a part at a time
        part = at[lo:lo + (1 << 14)]
        new[part] = (wide[order[part]] != wide[order[part - 1]]).any(axis=1)
    number = np.empty(len(h), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _rows_as_strings(*columns: np.ndarray) -> np.ndarray:
    """Rows of integer columns as byte strings that sort like the rows."""
    parts = []
    for c in columns:
        c = c.reshape(len(c), -1)
        c = c.astype(c.dtype.newbyteorder(">"))
        parts.append(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1))
    raw = np.ascontiguousarray(np.concatenate(parts, axis=1))
    return raw.view(f"S{raw.shape[1]}").ravel()


class _Shared:
    """A block's occurrences of shared anchors by hash: row, place and hash."""

    def __init__(self, path: str, answers: pa.Table, buckets: int):
        self.table, self.data, self.offs, self.order = _block(path)
        row, at, h = anchors(self.data, self.offs)
        unique, of, several = _distinct(self.order, row, h)
        used, cut = _runs(unique, buckets)
        place = dict(zip(used.tolist(), range(len(used)), strict=True))
        for b, bits in zip(answers["bucket"].to_pylist(), answers["shared"].to_pylist(), strict=True):
            i, j = cut[place[b]], cut[place[b] + 1]
            several[i:j] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=j - i).astype(bool)
        keep = np.flatnonzero(several[of])
        keep = keep[np.argsort(h[keep], kind="stable")]
        self.row, self.at, self.h = row[keep], at[keep], h[keep]
        self.buckets, self.cut = _runs(self.h, buckets)

    def parts(self) -> Iterator[tuple]:
        """Runs of whole buckets of about SLICE occurrences: (buckets, where
        their distinct contexts begin, row, place, contexts, hash and smallest
        document of each, context of each occurrence)."""
        k = 0
        while k < len(self.buckets):
            to = max(k + 1, int(np.searchsorted(self.cut, self.cut[k] + SLICE, side="right")) - 1)
            part = slice(self.cut[k], self.cut[to])
            row, at, h = self.row[part], self.at[part], self.h[part]
            c = _contexts(self.data, self.offs, row, at)
            first, number = _same_contexts(h, c)
            least = np.full(len(first), LAST)
            np.minimum.at(least, number, self.order[row])
            begin = np.searchsorted(h[first], self.h[self.cut[k:to]])   # a bucket's smallest hash
            yield self.buckets[k:to], np.append(begin, len(first)), row, at, c[first], h[first], least, number
            k = to


def _send_contexts(group_blocks: pa.Table, answers: pa.Table, buckets: int) -> pa.Table:
    out = {"bucket": [], "file": [], "hashes": [], "docs": [], "bytes": []}
    for path in group_blocks["file"].to_pylist():
        own = answers.filter(pc.equal(answers["file"], path))
        for used, cut, _, _, c, h, least, _ in _Shared(path, own, buckets).parts():
            for b, i, j in zip(used.tolist(), cut[:-1], cut[1:], strict=True):
                out["bucket"].append(b)
                out["file"].append(path)
                out["hashes"].append(_sorted_out(h[i:j]))
                out["docs"].append(_squeeze(least[i:j]))
                out["bytes"].append(_squeeze(c[i:j]))
    store.release()
    return pa.table(out, schema=_SENT)


_SENT = pa.schema([("bucket", pa.int64()), ("file", pa.string()), ("hashes", pa.binary()), ("docs", pa.binary()), ("bytes", pa.binary())])


# ---- stage 3: suffix arrays over the contexts of a bucket ----------------------

def _sorted_side(h: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sort order, common prefix with the row before in that order, longest
    common prefix of each row with any other of its anchor)."""
    order = np.argsort(_rows_as_strings(h, side), kind="stable")
    a = side[order]
    common = np.full(len(h) + 1, -1, dtype=np.int64)
    if len(h) > 1:
        differ = a[1:] != a[:-1]
        k = np.where(differ.any(axis=1), differ.argmax(axis=1), side.shape[1])
        common[1:-1] = np.where(h[order][1:] == h[order][:-1], k, -1)
    deepest = np.empty(len(h), dtype=np.int64)
    deepest[order] = np.maximum(common[:-1], common[1:])
    return order, common[:-1], deepest


def _symbols(h: np.ndarray, side: np.ndarray, tag: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, depth, symbol) at every depth where contexts of its anchor
    part, as far as another context goes along."""
    order, common, deepest = _sorted_side(h, side)
    group = np.cumsum(np.concatenate([[True], h[order][1:] != h[order][:-1]])) - 1
    out = []
    for d in range(1, side.shape[1] + 1):
        cut = np.zeros(int(group[-1]) + 1, dtype=bool)
        cut[group[common == d]] = True
        rows = np.flatnonzero(cut[group] & (deepest[order] >= d))
        if len(rows):
            first = np.maximum.accumulate(np.where(common < d, np.arange(len(h)), 0))
            out.append((order[rows], np.full(len(rows), d), (tag << 40) + (d << 32) + first[rows]))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def reaches(h: np.ndarray, c: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For distinct contexts and the smallest document of each: bytes left and
    right of the anchor's start that a repeat of a smaller document covers."""
    lo, hi = np.zeros(len(h), dtype=np.int64), np.zeros(len(h), dtype=np.int64)
    left_len, right_len = (c[:, :LEFT] != PAD).sum(axis=1), (c[:, LEFT:] != PAD).sum(axis=1)
    keep = np.arange(len(h))
    for _ in range(2):                                   # contexts that no other can match in SIZE bytes
        if not len(keep):
            return lo, hi
        far = [np.minimum(_sorted_side(h[keep], side)[2], n[keep])
               for side, n in ((c[keep, :LEFT], left_len), (c[keep, LEFT:], right_len))]
        keep = keep[far[0] + far[1] >= SIZE]
    if not len(keep):
        return lo, hi
    lx, ld, ls = _symbols(h[keep], c[keep, :LEFT], 1)
    rx, rd, rs = _symbols(h[keep], c[keep, LEFT:], 2)
    n = len(keep)
    # each context: left symbols from far to near, right symbols, separator
    x = np.concatenate([lx, rx, np.arange(n)])
    depth = np.concatenate([-ld, rd, np.full(n, LEFT + SIZE)])
    symbol = np.concatenate([ls, rs, np.zeros(n, np.int64)])
    order = np.lexsort((depth, x))
    x, depth, symbol = x[order], depth[order], symbol[order]
    ranks = np.unique(symbol, return_inverse=True)[1] + 1        # separators are 1
    text = [*ranks.tolist(), 0]
    owner = np.append(docs[keep][x], LAST).tolist()
    array = suffix_array(text)
    best = np.array(longest_with_smaller(array, common_prefixes(text, array, 1), owner)[:-1], dtype=np.int64)
    place = np.arange(len(x))
    first_right = np.searchsorted(x, np.arange(n))
    first_right = first_right + np.bincount(lx, minlength=n)      # place of a context's first right symbol
    lefts = first_right[x] - place
    use = (lefts >= 0) & (best > lefts) & (symbol > 0)
    at = place[use]
    owner_row = keep[x[at]]
    right = np.minimum(depth[at + best[use] - 1], right_len[owner_row])
    left = np.minimum(np.where(lefts[use] > 0, -depth[at], 0), left_len[owner_row])
    ok = left + right >= SIZE
    np.maximum.at(lo, owner_row[ok], left[ok])
    np.maximum.at(hi, owner_row[ok], right[ok])
    return lo, hi


def _whole_anchors(h: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of about SLICE contexts; contexts of one anchor stay together, and
    those of several have nothing to do with each other."""
    ends = np.append(np.flatnonzero(h[1:] != h[:-1]) + 1, len(h))
    i = 0
    while i < len(h):
        j = int(ends[min(np.searchsorted(ends, i + SLICE), len(ends) - 1)])
        yield i, j
        i = j


def _answer_contexts(group: pa.Table) -> pa.Table:
    hashes = [_sorted_in(x.as_py(), _U) for x in group["hashes"]]
    h = np.concatenate(hashes)
    docs = np.concatenate([_spread(x.as_py(), np.int64) for x in group["docs"]])
    c = np.concatenate([_spread(x.as_py(), np.uint16, LEFT + SIZE) for x in group["bytes"]])
    first, number = _same_contexts(h, c)
    least = np.full(len(first), LAST)
    np.minimum.at(least, number, docs)
    lo, hi = np.zeros(len(first), dtype=np.int64), np.zeros(len(first), dtype=np.int64)
    for i, j in _whole_anchors(h[first]):
        lo[i:j], hi[i:j] = reaches(h[first[i:j]], c[first[i:j]], least[i:j])
    lo, hi = lo[number], hi[number]
    # a smaller document elsewhere has the whole context
    left, right = (c[:, :LEFT] != PAD).sum(axis=1), (c[:, LEFT:] != PAD).sum(axis=1)
    whole = (least[number] < docs) & (left + right >= SIZE)
    lo, hi = np.where(whole, left, lo).astype(np.uint8), np.where(whole, right, hi).astype(np.uint8)
    cut = np.cumsum([0] + [len(x) for x in hashes])
    packed = [_squeeze(np.stack([lo[a:b], hi[a:b]], axis=1)) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    del c, h, docs
    store.release()
    return pa.table({"bucket": group["bucket"], "file": group["file"], "reach": pa.array(packed, pa.binary())})


# ---- stage 4: rows --------------------------------------------------------------

def _removed(path: str, answers: pa.Table, reach: pa.Table, buckets: int) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """(rows, bytes, offsets, removed bytes) of a block."""
    own = _Shared(path, answers, buckets)
    reached = dict(zip(reach["bucket"].to_pylist(), reach["reach"].to_pylist(), strict=True))
    cover = np.zeros(len(own.data) + 1, dtype=np.int32)
    for used, cut, row, at, c, _, least, number in own.parts():
        lo, hi = np.zeros(len(c), dtype=np.int64), np.zeros(len(c), dtype=np.int64)
        for b, i, j in zip(used.tolist(), cut[:-1], cut[1:], strict=True):
            both = _spread(reached[b], np.uint8, 2)
            lo[i:j], hi[i:j] = both[:, 0], both[:, 1]
        left, right = (c[:, :LEFT] != PAD).sum(axis=1), (c[:, LEFT:] != PAD).sum(axis=1)
        whole = (own.order[row] > least[number]) & (left + right >= SIZE)[number]
        lo, hi = np.where(whole, left[number], lo[number]), np.where(whole, right[number], hi[number])
        np.add.at(cover, at - lo, 1)
        np.add.at(cover, at + hi, -1)
    np.cumsum(cover, out=cover)
    return own.table, own.data, own.offs, cover[:-1] > 0


RESULT = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def _rows(table: pa.Table, data: np.ndarray, offs: np.ndarray, gone: np.ndarray, schema: pa.Schema, as_text: bool) -> pa.Table:
    # row by row: no array of numbers as long as the block
    n_removed, n_spans, kept = (np.zeros(len(table), dtype=np.int64), np.zeros(len(table), dtype=np.int64), [])
    digests = []
    for i, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)):
        cut, left = gone[a:b], data[a:b]
        n = np.count_nonzero(cut)
        if n:
            n_removed[i] = n
            n_spans[i] = np.count_nonzero(cut[1:] > cut[:-1]) + int(cut[0])
            left = left[~cut]
        digests.append(hashlib.sha256(left).hexdigest())
        if as_text:
            kept.append(left.tobytes().decode(errors="ignore") if n else None)
    made = {"n_bytes": pa.array(np.diff(offs), pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
            "n_spans": pa.array(n_spans, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string())}
    if as_text:
        texts = table["text"].combine_chunks()
        made["text"] = pc.if_else(pa.array(n_removed > 0), pa.array(kept, texts.type), texts)
    return pa.table([made.get(f.name, table[f.name] if f.name in table.column_names else None) for f in schema], schema=schema)


def dedup(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), block_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The kept columns of every document (``text``: what is left of it) and
    the RESULT columns."""
    spark = docs.sparkSession
    columns = list(dict.fromkeys([*keep, "doc_id", "text"]))
    rows = docs.select(*columns)
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(1))).first()[0] or 1
    buckets = max(1, -(-total // block_bytes))
    bits = min(64, max(40, total.bit_length() + 10))
    blocks = _write_blocks(rows, store.workspace(spark, "dedup"))
    n = max(1, -(-blocks.count() // BLOCKS_PER_TASK))
    blocks = blocks.repartition(n, "file")
    answers = store.saved(_send_hashes(blocks, buckets, bits).groupBy("bucket").applyInArrow(
        _answer_hashes, "bucket long, file string, shared binary"), "dedup-shared")
    sent = blocks.groupBy("file").cogroup(answers.repartition(n, "file").groupBy("file")).applyInArrow(
        lambda x, y: _send_contexts(x, y, buckets), "bucket long, file string, hashes binary, docs binary, bytes binary")
    reach = store.saved(sent.groupBy("bucket").applyInArrow(_answer_contexts, "bucket long, file string, reach binary"), "dedup-reach")
    schema = StructType([rows.schema[c] for c in keep])
    for name, kind in zip(RESULT, ("long", "long", "long", "string"), strict=True):
        schema = schema.add(name, kind)
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    as_text = "text" in keep
    # both answers of a block travel together, told apart by which is null
    told = answers.select("file", "bucket", "shared", F.lit(None).cast("binary").alias("reach")).unionByName(
        reach.select("file", "bucket", F.lit(None).cast("binary").alias("shared"), "reach"))

    def finish(x: pa.Table, y: pa.Table) -> pa.Table:
        first, second = y.filter(pc.is_valid(y["shared"])), y.filter(pc.is_valid(y["reach"]))
        made = []
        for path in x["file"].to_pylist():
            one, two = (t.filter(pc.equal(t["file"], path)) for t in (first, second))
            made.append(_rows(*_removed(path, one, two, buckets), arrow, as_text))
        store.release()
        return pa.concat_tables(made) if made else arrow.empty_table()

    return blocks.groupBy("file").cogroup(told.repartition(n, "file").groupBy("file")).applyInArrow(finish, schema)
