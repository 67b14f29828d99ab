"""N-gram language model (order 2 or 3) in an Elias-Fano trie.

Counting and building are Spark jobs over all training documents. Level 1 is
the vocabulary in hash order with counts; level 2 holds every pair of words
seen, numbered in order; level 3 every run of three, as the number of its
first pair and the place of its last word among the followers of the middle
word. Pairs and triples are dealt over files by an even share of the expected
tokens, so the followers of a very frequent context are split over several
files. A file keeps monotone pointers from its contexts to their followers,
the followers as one monotone sequence relative to their context, and one byte
of quantised log10 probability each; level 2 also keeps running counts, the
weights of level 3's contexts. Tasks map the files that their words touch: the
pointers bound the followers of the context, the successor of the word is
searched among those.

Smoothing: absolute discounting, the freed mass goes to the next lower order
and at last to the unigrams (add one half, with a share for unknown words), so
P(w | c) = max(n(c, w) - D, 0) / n(c) + D * followers(c) / n(c) * P(w | shorter c).
The first word of a text has no context but the text's start.

Defined cases: a null or empty text is just the end token; without training
documents every score is that of the uniform rest; repeated rows count and
score as often as they stand; a null doc_id is in the training part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegraph.llm import store, words
from lakegraph.llm.elias_fano import FIELDS, EliasFano, encode

ORDER = 3
DISCOUNT = 0.75
BYTES_PER_FILE = 16 << 20       # training text behind one file of a level
END = words.U64(0x0F0E0D0C0B0A0908)   # stands for the end of a text, and before its start
STEP, FLOOR = 0.05, -12.75            # log10 probabilities in one byte
LONG_WORD = 64
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=words.U64)      # the first n bytes of eight
SHARES = 10.0 ** (np.arange(256) * STEP + FLOOR)
SCORE_BYTES = 8 << 20
TRIPLES_HELD = 1_500_000              # distinct triples of a task before it sends them


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word, eight bytes at a time; of long words byte by
    byte for all of them at once."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    blocks = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    left, at = ends - starts, starts
    out = left.astype(words.U64) * words.U64(0xD6E8FEB86659FD93)
    long = np.flatnonzero(left > LONG_WORD)
    todo = np.flatnonzero(left <= LONG_WORD) if len(long) else np.arange(len(left))
    while len(todo):
        part = left[todo]
        out[todo] = words.mix(out[todo] ^ (blocks[at[todo]] & _FIRST[np.minimum(part, 8)]))
        todo = todo[part > 8]
        at, left = at + 8, left - 8
    if len(long):
        out[long] = words.word_hashes(data, starts[long], ends[long])
    return out


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows, each row closed by END, and row offsets."""
    data = words.LOWER[data]
    s, e, first = words.spans(data, offs, words.NOT_SPACE)
    h = _hashes(data, s, e)
    n = len(offs) - 1
    out = np.full(len(h) + n, END, dtype=words.U64)
    out[np.arange(len(h)) + np.repeat(np.arange(n), np.diff(first))] = h
    return out, first + np.arange(n + 1)


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays as one compressed message; integers as differences."""
    import io
    out = io.BytesIO()
    np.savez(out, **{k: np.diff(v, prepend=v.dtype.type(0)) for k, v in arrays.items()})
    return pa.compress(out.getvalue(), codec="zstd", asbytes=True) + len(out.getvalue()).to_bytes(8, "little")


def unpack(message: bytes) -> dict[str, np.ndarray]:
    import io
    raw = pa.decompress(message[:-8], int.from_bytes(message[-8:], "little"), codec="zstd", asbytes=True)
    with np.load(io.BytesIO(raw)) as z:
        return {k: np.cumsum(z[k], dtype=z[k].dtype) for k in z.files}


def write_arrays(path: str, arrays: dict[str, np.ndarray]) -> None:
    """A flat file of aligned arrays behind a small directory."""
    with store.open_output(path) as out:
        head, at = [], 0
        for k, v in arrays.items():
            head.append(f"{k}\t{v.dtype.str}\t{at}\t{len(v)}")
            at += -(-v.nbytes // 64) * 64
        text = "\n".join(head).encode()
        text += b"\n" * (-(len(text) + 8) % 64)
        out.write(len(text).to_bytes(8, "little") + text)
        for v in arrays.values():
            out.write(v.tobytes() + bytes(-v.nbytes % 64))


def map_arrays(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file as views of the mapped bytes."""
    source = store.open_input(path)
    raw = np.frombuffer(source.read_buffer(source.size()), dtype=np.uint8)
    n = int(raw[:8].view(np.int64)[0])
    out = {}
    for line in raw[8:8 + n].tobytes().decode().split("\n"):
        if line:
            k, kind, at, size = line.split("\t")
            a = 8 + n + int(at)
            out[k] = raw[a:a + int(size) * np.dtype(kind).itemsize].view(kind)
    return out


class Counter:
    """Distinct keys with counts, merged as they come."""

    def __init__(self, limit: int = 4_000_000):
        self.keys, self.counts = [], []
        self.held, self.limit = 0, limit

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held > self.limit:
            k, c = self.total()
            self.keys, self.counts, self.held = [k], [c], len(k)
            self.limit = max(self.limit, 2 * len(k))

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, words.U64), np.zeros(0, np.int64)
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        return keys[first], np.add.reduceat(counts, first) if len(first) else counts


_MESSAGE = "bucket int, message binary"


def _counted(docs: DataFrame, keys_of: Callable, buckets_of: Callable, buckets: int) -> DataFrame:
    """Each task's distinct keys with counts, one message per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, keys, cut = Counter(), keys_of(), buckets_of()
        for b in batches:
            for _, _, data, offs in words.chunks(b["text"]):
                counter.add(*np.unique(keys(*tokens(data, offs)), return_counts=True))
        k, c = counter.total()
        bucket = cut(k)
        order = np.argsort(bucket, kind="stable")       # keys stay in order within a bucket
        k, c = k[order], c[order]
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for i in np.flatnonzero(np.diff(edges)):
            part = slice(edges[i], edges[i + 1])
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([pack({"k": k[part], "c": c[part]})], pa.binary())],
                                             names=["bucket", "message"])

    return docs.select("text").mapInArrow(run, _MESSAGE)


def _merged(messages: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    counter = Counter()
    for m in messages:
        got = unpack(m.as_py())
        counter.add(got["k"], got["c"])
    return counter.total()


def _summed(first: np.ndarray, last: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (first, last) in order, with the sum of the last of ``values``
    (counts) and any of the others."""
    low, width = (int(first.min()), int(last.max()) + 1) if len(first) else (0, 1)
    if len(first) and (int(first.max()) - low + 1) * width < 1 << 63:   # both in one number
        order = np.argsort((first - low) * width + last)
    else:
        order = np.lexsort((last, first))
    first, last = first[order], last[order]
    new = np.ones(len(first), dtype=bool)
    new[1:] = (first[1:] != first[:-1]) | (last[1:] != last[:-1])
    at = np.flatnonzero(new)
    counts = np.add.reduceat(values[-1][order], at) if len(at) else values[-1]
    return first[at], last[at], *(v[order][at] for v in values[:-1]), counts


def _counted_triples(docs: DataFrame, manifest: dict) -> DataFrame:
    """Distinct (pair, follower's place, count), sent by a task whenever it
    holds TRIPLES_HELD of them, one message per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held, n_held = _trie(manifest), [], 0

        def messages() -> Iterator[pa.RecordBatch]:
            g, r, bucket, c = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))       # buckets follow the pairs' order
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket[a]], pa.int32()), pa.array([pack({"k": g[a:b], "r": r[a:b], "c": c[a:b]})], pa.binary())],
                    names=["bucket", "message"])

        for batch in batches:
            for _, _, data, offs in words.chunks(batch["text"], SCORE_BYTES):
                found = trie.triples(*tokens(data, offs))
                if len(found[0]):
                    held.append(found)
                    n_held += len(found[0])
                if n_held > TRIPLES_HELD:
                    yield from messages()
                    held, n_held = [], 0
        if held:
            yield from messages()
        held.clear()
        store.release()

    return docs.select("text").mapInArrow(run, _MESSAGE)


class Opened:
    """Arrays of files, mapped when first asked for."""

    def __init__(self, files: list[dict]):
        self.files = files
        self.open: dict[int, dict[str, np.ndarray]] = {}

    def __getitem__(self, i: int) -> dict[str, np.ndarray]:
        if i not in self.open:
            self.open[i] = map_arrays(self.files[i]["path"])
        return self.open[i]


class Vocabulary:
    """Level 1: word hashes in order, counts and running counts, by file."""

    def __init__(self, files: list[dict]):
        self.arrays = Opened(files)
        self.edges = np.array([f["hash0"] for f in files[1:]], dtype=words.U64)
        self.base = np.array([f["id0"] for f in files] + [files[-1]["id0"] + files[-1]["n"]] if files else [0], dtype=np.int64)
        self.before = [f["tokens0"] for f in files]
        self.size = int(self.base[-1])
        self.tokens = sum(f["tokens"] for f in files)

    def ids(self, sorted_hashes: np.ndarray) -> np.ndarray:
        """Ids of sorted word hashes, -1 where unknown."""
        out = np.full(len(sorted_hashes), -1, dtype=np.int64)
        if not self.size:
            return out
        for k, part in _parts(np.searchsorted(self.edges, sorted_hashes, side="right")):
            keys, wanted = self.arrays[k]["k"], sorted_hashes[part]
            i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            out[part] = np.where(keys[i] == wanted, i + self.base[k], -1)
        return out

    def _take(self, ids: np.ndarray, name: str) -> np.ndarray:
        """A column of known ids, 0 for unknown ones; file by file."""
        out = np.zeros(len(ids), dtype=np.int64)
        order = np.argsort(ids, kind="stable")
        order = order[np.searchsorted(ids[order], 0):]
        s = ids[order]
        for k, part in _parts(np.searchsorted(self.base, s, side="right") - 1):
            out[order[part]] = self.arrays[k][name][s[part] - self.base[k]].astype(np.int64) + (self.before[k] if name == "run" else 0)
        return out

    def counts(self, ids: np.ndarray) -> np.ndarray:
        return self._take(ids, "c")

    def runs(self, ids: np.ndarray) -> np.ndarray:
        return self._take(ids, "run")


def _of_context(ids: np.ndarray, rows: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(word before, word) of each token; END stands before a row's first."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[rows[:-1]] = end
    return before, ids


_VOCAB: dict[tuple, Vocabulary] = {}


def _vocabulary(files: list[dict]) -> Vocabulary:
    key = tuple(f["path"] for f in files)
    if key not in _VOCAB:
        _VOCAB.clear()
        _VOCAB[key] = Vocabulary(files)
    return _VOCAB[key]


def _lookup(vocab: Vocabulary, hashes: np.ndarray) -> np.ndarray:
    unique, of = np.unique(hashes, return_inverse=True)
    return vocab.ids(unique)[of]


def build(train: DataFrame, order: int = ORDER) -> dict:
    """Count the training texts and write the levels (``order`` 2 or 3);
    returns the manifest (paths and totals, one entry per file)."""
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    spark = train.sparkSession
    total = train.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    buckets = max(1, -(-total // BYTES_PER_FILE))
    folder = store.workspace(spark, "ngram-trie")

    def by_hash(k: np.ndarray) -> np.ndarray:
        return ((k >> words.U64(40)) * words.U64(buckets) >> words.U64(24)).astype(np.int64)

    def level1(group: pa.Table) -> pa.Table:
        k, c = _merged(group["message"])
        run = np.cumsum(c) - c
        path = store.task_file(folder, f"-{group['bucket'][0]}.words")
        write_arrays(path, {"k": k, "c": c, "run": run})
        return pa.table({"bucket": [group["bucket"][0].as_py()], "path": [path], "hash0": [int(k[0].view(np.int64))],
                         "n": [len(k)], "tokens": [int(c.sum())]})

    found = _counted(train, lambda: lambda h, rows: h, lambda: by_hash, buckets)
    found = store.saved(found.groupBy("bucket").applyInArrow(level1, "bucket long, path string, hash0 long, n long, tokens long"), "trie-words")
    files, ids, seen = [], 0, 0
    for r in found.orderBy("bucket").collect():         # one small row per file
        files.append({"path": r.path, "hash0": r.hash0 & (2 ** 64 - 1), "n": r.n, "tokens": r.tokens, "id0": ids, "tokens0": seen})
        ids, seen = ids + r.n, seen + r.tokens
    manifest = {"words": files, "n_words": ids, "tokens": seen, "order": order, "buckets": buckets, "pairs": [], "triples": []}
    if not files:
        return manifest

    def pair_keys() -> Callable:
        vocab = _vocabulary(files)
        end = int(vocab.ids(np.array([END]))[0])

        def keys(h: np.ndarray, rows: np.ndarray) -> np.ndarray:
            a, b = _of_context(_lookup(vocab, h), rows, end)
            return a.astype(words.U64) * words.U64(ids) + b.astype(words.U64)
        return keys

    def slices() -> Callable:
        vocab = _vocabulary(files)

        def of(k: np.ndarray) -> np.ndarray:
            a, b = (k // words.U64(ids)).astype(np.int64), (k % words.U64(ids)).astype(np.int64)
            return _slice(vocab.runs(a), vocab.counts(a), vocab.runs(b), vocab.tokens, buckets)
        return of

    def level2(group: pa.Table) -> pa.Table:
        vocab = _vocabulary(files)
        k, c = _merged(group["message"])
        a, b = (k // words.U64(ids)).astype(np.int64), (k % words.U64(ids)).astype(np.int64)
        runs = {f"r_{n}": v for n, v in encode(np.concatenate([[0], np.cumsum(c)]), int(c.sum()) + 1).items()} if order > 2 else {}
        return _write_level(folder, group, "pairs", a, b, ids, np.maximum(c - DISCOUNT, 1e-9) / vocab.counts(a), int(c.sum()), runs)

    found = _counted(train, pair_keys, slices, buckets)
    found = store.saved(found.groupBy("bucket").applyInArrow(level2, _FILE), "trie-pairs")
    manifest["pairs"] = _files(found)
    if order == 2:
        return manifest
    # level 3: the universe of a context is the widest set of followers
    manifest["widest"] = widest = Level(manifest["pairs"], ids).widest()

    def level3(group: pa.Table) -> pa.Table:
        got = [unpack(m.as_py()) for m in group["message"]]
        g, r, c = _summed(*(np.concatenate([x[n] for x in got]) for n in "krc"))
        del got
        weight = _trie(manifest).level2.counts(g)
        return _write_level(folder, group, "triples", g, r, widest, np.maximum(c - DISCOUNT, 1e-9) / weight, int(c.sum()), {})

    found = _counted_triples(train, dict(manifest))
    found = store.saved(found.groupBy("bucket").applyInArrow(level3, _FILE), "trie-triples")
    manifest["triples"] = _files(found)
    return manifest


_FILE = ("bucket long, path string, lo long, hi long, at_hi long, n_lo long, n_hi long, n long, widest long, tokens long")


def _write_level(folder: str, group: pa.Table, kind: str, context: np.ndarray, follower: np.ndarray, universe: int,
                 share: np.ndarray, n_tokens: int, more: dict[str, np.ndarray]) -> pa.Table:
    """Write one file of a level, of (context, follower) in order; its row of
    the manifest. Followers of its first and last context may go on in other
    files."""
    lo, hi = int(context[0]), int(context[-1])
    begin = np.searchsorted(context, np.arange(lo, hi + 2))
    arrays = {f"p_{n}": v for n, v in encode(begin, len(context) + 1).items()}
    arrays |= {f"f_{n}": v for n, v in encode((context - lo) * universe + follower, (hi - lo + 1) * universe).items()}
    arrays["q"] = np.clip(np.round((np.log10(share) - FLOOR) / STEP), 0, 255).astype(np.uint8)
    path = store.task_file(folder, f"-{group['bucket'][0]}.{kind}")
    write_arrays(path, arrays | more)
    return pa.table({"bucket": [group["bucket"][0].as_py()], "path": [path], "lo": [lo], "hi": [hi], "at_hi": [int(begin[-2])],
                     "n_lo": [int(begin[1])], "n_hi": [int(begin[-1] - begin[-2])], "n": [len(context)],
                     "widest": [int(np.diff(begin).max())], "tokens": [n_tokens]})


def _files(found: DataFrame) -> list[dict]:
    """The rows of a level's files in order, one small row per file."""
    return [r.asDict() for r in found.orderBy("bucket").collect()]


def _slice(run_a: np.ndarray, count_a: np.ndarray, run_b: np.ndarray, total: int, buckets: int) -> np.ndarray:
    """File of each pair: the expected share of all pairs before it in id
    order, so files hold about as many pairs each and a frequent word's
    followers are split over several."""
    n = max(total, 1)
    share = (run_a + count_a * (run_b / n)) / n
    return np.minimum((share * buckets).astype(np.int64), buckets - 1)


class Level:
    """Followers of contexts, over files in the contexts' order; a file is
    opened when a lookup first touches it."""

    def __init__(self, files: list[dict], universe: int):
        self.files, self.universe = files, universe
        self.open: dict[int, tuple] = {}
        self.bucket = np.array([f["bucket"] for f in files], dtype=np.int64)
        self.lo, self.hi = (np.array([f[n] for f in files], dtype=np.int64) for n in ("lo", "hi"))
        # numbers of the files' first entries, and tokens before them
        self.number0, self.tokens0 = (np.cumsum([0] + [f[n] for f in files]) for n in ("n", "tokens"))
        first: dict[int, int] = {}                       # contexts at the ends of files: first entry, entries
        total: dict[int, int] = {}
        for f, at in zip(files, self.number0.tolist()):  # noqa: B905
            for c, start, n in {(f["lo"], at, f["n_lo"]), (f["hi"], at + f["at_hi"], f["n_hi"])}:
                first[c] = min(first.get(c, start), start)
                total[c] = total.get(c, 0) + n
        self.edges = np.array(sorted(total), dtype=np.int64)
        self.edge_first, self.edge_n = (np.array([d[c] for c in sorted(total)], dtype=np.int64) for d in (first, total))

    def file(self, i: int) -> tuple:
        """(pointers, followers, quantised values, running counts) of a file."""
        if i not in self.open:
            a = map_arrays(self.files[i]["path"])
            part = lambda x: EliasFano({n: a[f"{x}_{n}"] for n in (*FIELDS, "head")}) if f"{x}_head" in a else None
            self.open[i] = (part("p"), part("f"), a["q"], part("r"))
        return self.open[i]

    def widest(self) -> int:
        """Most followers of any context."""
        return max([1, *(f["widest"] for f in self.files), *self.edge_n.tolist()])

    def followers(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the first follower, and of followers, of ascending
        contexts (0 of unknown ones)."""
        first, n = np.zeros(len(contexts), dtype=np.int64), np.zeros(len(contexts), dtype=np.int64)
        if not self.files or not len(contexts):
            return first, n
        of = np.searchsorted(self.lo, contexts, side="left") - 1
        inside = np.flatnonzero((of >= 0) & (contexts < self.hi[of]))
        for i, part in _parts(of[inside]):
            own = inside[part]
            pointers, c = self.file(i)[0], contexts[own] - self.lo[i]
            first[own] = pointers.at(c)
            n[own] = pointers.at(c + 1) - first[own]
            first[own] += self.number0[i]
        i = np.minimum(np.searchsorted(self.edges, contexts), len(self.edges) - 1)
        edge = self.edges[i] == contexts
        first[edge], n[edge] = self.edge_first[i[edge]], self.edge_n[i[edge]]
        return first, n

    def find(self, bucket: np.ndarray, context: np.ndarray, follower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1 where not seen) and kept share (0 there) of followers,
        given the bucket that would hold them."""
        number, share = np.full(len(context), -1, dtype=np.int64), np.zeros(len(context))
        if not self.files:
            return number, share
        order = np.argsort(bucket, kind="stable")
        sorted_buckets = bucket[order]
        of = np.minimum(np.searchsorted(self.bucket, sorted_buckets), len(self.bucket) - 1)
        there = self.bucket[of] == sorted_buckets
        order, of = order[there], of[there]
        for i, part in _parts(of):
            own = order[part]
            own = own[(context[own] >= self.lo[i]) & (context[own] <= self.hi[i])]
            if not len(own):
                continue
            pointers, values, q, _ = self.file(i)
            c = context[own] - self.lo[i]
            new = np.concatenate([[True], c[1:] != c[:-1]])         # equal contexts mostly stand together
            distinct, which = c[new], np.cumsum(new) - 1
            at = values.find(c * self.universe + follower[own], pointers.at(distinct)[which], pointers.at(distinct + 1)[which])
            hit = at >= 0
            number[own[hit]] = at[hit] + self.number0[i]
            share[own[hit]] = SHARES[q[at[hit]]]
        return number, share

    def runs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens before, and counts, of entries by number."""
        run, count = np.zeros(len(numbers), dtype=np.int64), np.zeros(len(numbers), dtype=np.int64)
        order = np.argsort(numbers, kind="stable")
        of = np.searchsorted(self.number0, numbers[order], side="right") - 1
        for i, part in _parts(of):
            own = order[part]
            at, runs = numbers[own] - self.number0[i], self.file(i)[3]
            run[own] = runs.at(at)
            count[own] = runs.at(at + 1) - run[own]
            run[own] += self.tokens0[i]
        return run, count

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        return self.runs(numbers)[1]


def _parts(of: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(value, its slice) of ascending values."""
    edges = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])) if len(of) else []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(of[a]), slice(int(a), int(b))


class Chunk(NamedTuple):
    """Tokens of some rows by their distinct words and pairs of words."""

    count: np.ndarray    # of words: count, tokens before, first pair's number
    run: np.ndarray
    of: np.ndarray       # of tokens: word
    first: np.ndarray
    a: np.ndarray        # of pairs: both words, number (-1: not seen), P(b | a)
    b: np.ndarray
    pair_of: np.ndarray  # of tokens: pair that it closes
    number: np.ndarray
    p: np.ndarray
    later: np.ndarray    # tokens that do not begin a row


class Trie:
    """All levels, mapped; scores arrays of words."""

    def __init__(self, manifest: dict):
        self.vocab = Vocabulary(manifest["words"])
        self.size, self.total = manifest["n_words"], manifest["tokens"]
        self.buckets = manifest["buckets"]
        self.level2 = Level(manifest["pairs"], self.size)
        self.level3 = Level(manifest["triples"], manifest["widest"]) if "widest" in manifest else None

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.total + 0.5 * (self.size + 1))

    def chunk(self, h: np.ndarray, rows: np.ndarray) -> Chunk:
        """What the vocabulary and the pairs say of a chunk's tokens."""
        unique, of = np.unique(h, return_inverse=True)
        uid = self.vocab.ids(unique)
        count, run = self.vocab.counts(uid), self.vocab.runs(uid)
        local = np.empty_like(of)                        # local number of the word before
        local[1:] = of[:-1]
        local[rows[:-1]] = np.searchsorted(unique, END)
        pair, pair_of = np.unique(local * len(unique) + of, return_inverse=True)
        a, b = pair // len(unique), pair % len(unique)
        known = np.flatnonzero(uid >= 0)
        first, followers = np.zeros((2, len(uid)), dtype=np.int64)
        first[known], followers[known] = self.level2.followers(uid[known])
        rest = np.where(followers > 0, DISCOUNT * followers / np.maximum(count, 1), 1.0)   # an unknown word leaves everything
        number, seen = np.full(len(a), -1, dtype=np.int64), np.zeros(len(a))
        both = np.flatnonzero((uid[a] >= 0) & (uid[b] >= 0))
        x, y = a[both], b[both]
        number[both], seen[both] = self.level2.find(_slice(run[x], count[x], run[y], self.total, self.buckets), uid[x], uid[y])
        later = np.ones(len(h), dtype=bool)
        later[rows[:-1]] = False
        return Chunk(count, run, of, first, a, b, pair_of, number, seen + rest[a] * self.unigram(count)[b], np.flatnonzero(later))

    def _places(self, c: Chunk, first: np.ndarray, last: np.ndarray, run: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket, and place among the middle word's followers, of the triples
        of the seen pairs ``first`` and ``last``; run and weight: tokens
        before, and of, the first pair."""
        return _slice(run, weight, c.run[c.b[last]], self.total, self.buckets), c.number[last] - c.first[c.a[last]]

    def triples(self, h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """(pair, place of the follower, bucket, count) of the distinct runs
        of three words of training rows, whose pairs are all seen."""
        c = self.chunk(h, rows)
        triple, n = np.unique(c.pair_of[c.later - 1] * len(c.a) + c.pair_of[c.later], return_counts=True)
        first, last = triple // max(len(c.a), 1), triple % max(len(c.a), 1)
        run, weight = self.level2.runs(c.number)
        bucket, place = self._places(c, first, last, run[first], weight[first])
        return c.number[first], place, bucket, n

    def score(self, h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(count, log10 unigram probability, log10 probability) of each token."""
        c = self.chunk(h, rows)
        model = np.log10(c.p)[c.pair_of]
        if self.level3 is not None:
            triple, triple_of = np.unique(c.pair_of[c.later - 1] * len(c.a) + c.pair_of[c.later], return_inverse=True)
            first, last = triple // max(len(c.a), 1), triple % max(len(c.a), 1)
            known = np.flatnonzero(c.number >= 0)
            run, weight, rest = np.zeros(len(c.a), dtype=np.int64), np.zeros(len(c.a), dtype=np.int64), np.ones(len(c.a))
            run[known], weight[known] = self.level2.runs(c.number[known])
            followers = self.level3.followers(c.number[known])[1]        # a context not seen leaves everything to the pairs
            rest[known] = np.where(followers > 0, DISCOUNT * followers / np.maximum(weight[known], 1), 1.0)
            out = c.p[last] * rest[first]
            seen = np.flatnonzero((c.number[first] >= 0) & (c.number[last] >= 0))
            x, y = first[seen], last[seen]
            bucket, place = self._places(c, x, y, run[x], weight[x])
            out[seen] += self.level3.find(bucket, c.number[x], place)[1]
            model[c.later] = np.log10(out)[triple_of]
        return c.count[c.of], np.log10(self.unigram(c.count))[c.of], model


def _trie(manifest: dict) -> Trie:
    key = tuple(f["path"] for n in ("words", "pairs", "triples") for f in manifest[n])
    if key not in _TRIES:
        _TRIES.clear()
        _TRIES[key] = Trie(manifest)
    return _TRIES[key]


_TRIES: dict[tuple, Trie] = {}
_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_rows(trie: Trie, h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, known tokens, base score, model score) of each row."""
    count, base, model = trie.score(h, rows)
    known = np.concatenate([[0], np.cumsum(count > 0)])
    first = rows[:-1]
    return np.diff(rows), known[rows[1:]] - known[first], np.add.reduceat(base, first), np.add.reduceat(model, first)


def score(docs: DataFrame, manifest: dict) -> DataFrame:
    """SCORED rows of (doc_id, held_out, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(manifest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(sent.value)
        for b in batches:
            for row, end, data, offs in words.chunks(b["text"], SCORE_BYTES):
                h, rows = tokens(data, offs)
                n, known, base, model = score_rows(trie, h, rows)
                part = b.slice(row, end - row)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["held_out"], pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                     pa.array(np.full(len(n), trie.total), pa.int64()), pa.array(base), pa.array(model)], schema=_SCORED)

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, SCORED)
