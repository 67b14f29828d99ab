"""Benchmark decontamination by a hash set of n-gram windows.

A window is ``n`` consecutive words of a benchmark item (the whole item if it
has fewer words, but not none). The windows' hashes are broadcast; every run
of as many document words is hashed with array operations, and each run whose
hash is listed is compared with the window's words byte by byte, so a hash
collision is never a hit.

The benchmark is measured first. Up to ``MAX_BENCHMARK_BYTES`` of text it is
one broadcast block; a larger one is dealt into blocks of that size by item.
One block after the other is read, scanned against all documents and its hits
written, so the driver holds one at a time; the hits are merged at the end.

Defined cases: null or wordless texts have no words, windows or hits; a null
item_id counts as an item named ``null``; repeated items count once per
item_id; repeated documents each get their own row; empty tables give no rows
or no hits. A kept column named like a result is replaced by it.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from lakegraph.llm import store, words

N = 10
MAX_BENCHMARK_BYTES = 32 << 20
HITS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def item_words(text: str | None) -> list[bytes]:
    data, offs = words.flat(pa.array([text], pa.string()))
    data = words.LOWER[data]
    s, e, _ = words.spans(data, offs, words.ALNUM)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(s, e, strict=True)]


class Windows:
    """The windows of a block of items, by length and hash."""

    def __init__(self, items: list[tuple[str, str | None]], n: int):
        self.by_length: dict[int, dict[int, dict[bytes, set[str]]]] = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))
        for item, text in items:
            w = item_words(text)
            size = min(n, len(w))
            if size:
                hashes = words.joined(_hashes(w), size)
                for k, h in enumerate(hashes.tolist()):
                    self.by_length[size][h][b" ".join(w[k:k + size])].add(item)
        self.by_length = {k: {h: dict(x) for h, x in v.items()} for k, v in self.by_length.items()}
        self.sorted = {k: np.sort(np.fromiter(v, dtype=words.U64)) for k, v in self.by_length.items()}
        self.filters = {}
        for k, keys in self.sorted.items():
            bits = max(16, int(len(keys) * 16).bit_length())
            table = np.zeros(1 << bits, dtype=bool)
            table[keys & words.U64((1 << bits) - 1)] = True
            self.filters[k] = (table, words.U64((1 << bits) - 1))

    def scan(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, set[str]]]:
        """(word starts, first word of rows, hit words, items by row)."""
        data = words.LOWER[data]
        starts, ends, word_of_row = words.spans(data, offs, words.ALNUM)
        hashes = words.word_hashes(data, starts, ends)
        cover = np.zeros(len(starts) + 1, dtype=np.int64)
        items: dict[int, set[str]] = defaultdict(set)
        for size, listed in self.by_length.items():
            runs = words.joined(hashes, size)
            table, mask = self.filters[size]
            at = np.flatnonzero(table[runs & mask])
            keys = self.sorted[size]
            at = at[keys[np.minimum(np.searchsorted(keys, runs[at]), len(keys) - 1)] == runs[at]]
            row = np.searchsorted(word_of_row, at, side="right") - 1
            inside = at + size <= word_of_row[np.minimum(row + 1, len(word_of_row) - 1)]
            for k, r in zip(at[inside].tolist(), row[inside].tolist(), strict=True):
                text = b" ".join(data[a:b].tobytes() for a, b in zip(starts[k:k + size], ends[k:k + size], strict=True))
                found = listed[int(runs[k])].get(text)
                if found:
                    cover[k] += 1
                    cover[k + size] -= 1
                    items[r] |= found
        return starts, word_of_row, np.cumsum(cover[:-1]) > 0, items


def _hashes(w: list[bytes]) -> np.ndarray:
    lens = np.array([len(x) for x in w])
    ends = np.cumsum(lens)
    return words.word_hashes(np.frombuffer(b"".join(w), dtype=np.uint8), ends - lens, ends)


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text").distinct()


def _bytes(benchmark: DataFrame) -> int:
    return _items(benchmark).agg(F.coalesce(F.sum(F.octet_length("text") + F.lit(64)), F.lit(0))).first()[0]


def _block(benchmark: DataFrame, n: int, b: int = 0, blocks: int = 1) -> Windows:
    """One of the blocks that the items are dealt into."""
    part = _items(benchmark).filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
    return Windows([(r.item, r.text) for r in part.collect()], n)


def _scan(docs: DataFrame, block: Windows, schema: StructType, keep: list[str], raw: bool) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = sent.value
        for b in batches:
            for row, end, data, offs in words.chunks(b[b.num_columns - 1]):     # the text comes last
                part = b.slice(row, end - row)
                _, first, hit, items = windows.scan(data, offs)
                rows = range(end - row)
                cols = [part[c] for c in keep]
                hits = [np.flatnonzero(hit[first[r]:first[r + 1]]) for r in rows]
                names = [sorted(items.get(r, ())) for r in rows]
                if raw:
                    cols += [pa.array(np.diff(first), pa.int64()), pa.array([h.tolist() for h in hits], pa.list_(pa.int64())),
                             pa.array(names, pa.list_(pa.string()))]
                else:
                    cols += digest(np.diff(first), [len(h) for h in hits], names)
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)
        store.release()

    return docs.mapInArrow(run, schema)


def digest(n_words, n_hit, names) -> list[pa.Array]:
    return [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in names], pa.int64()),
            pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names], pa.string()),
            pa.array([h > 0 for h in n_hit], pa.bool_())]


def find_hits(docs: DataFrame, benchmark: DataFrame, keep: list[str], n: int = N,
              max_bytes: int = MAX_BENCHMARK_BYTES, prefix: str = "") -> DataFrame:
    """The kept columns of every document and its HITS columns; a prefix of
    their names avoids clashes with kept columns."""
    names = [prefix + x for x in HITS]
    keep = [c for c in keep if c not in names]
    schema = StructType([docs.schema[c] for c in keep])
    text, key, n_words, hit, item = (store.free_name([*keep, *names], x) for x in ("_text", "_row", "_n_words", "_hit", "_items"))
    rows = docs.select(*keep, F.col("text").alias(text))
    total = _bytes(benchmark)
    if total <= max_bytes:
        for name, kind in zip(names, ("long", "long", "long", "string", "boolean"), strict=True):
            schema = schema.add(name, kind)
        return _scan(rows, _block(benchmark, n), schema, keep, raw=False)
    # hit word numbers and items of each block, merged per row; one block is held at a time
    rows = store.saved(rows.withColumn(key, F.expr("uuid()")), "decontaminate")         # fixes the row keys
    raw = StructType([rows.schema[c] for c in [*keep, key]]).add(n_words, "long") \
        .add(hit, ArrayType(LongType())).add(item, ArrayType(StringType()))
    blocks = -(-total // max_bytes)
    out = None
    for b in range(blocks):
        found = store.saved(_scan(rows.select(*keep, key, text), _block(benchmark, n, b, blocks), raw, [*keep, key], raw=True), "hits")
        out = found if out is None else out.unionByName(found)
    items = F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_list(item)))), ",")
    n_items = F.size(F.array_distinct(F.flatten(F.collect_list(item))))
    # each row comes once per block, so a group has as many rows as blocks
    out = out.groupBy(key).agg(
        *[F.first(c).alias(c) for c in keep], F.first(n_words).alias(names[0]),
        F.size(F.array_distinct(F.flatten(F.collect_list(hit)))).cast("long").alias(names[1]),
        n_items.cast("long").alias(names[2]), F.sha2(items, 256).alias(names[3]))
    return out.drop(key).withColumn(names[4], F.col(names[1]) > 0)


def keep_clean(docs: DataFrame, benchmark: DataFrame, columns: tuple[str, ...], n: int = N) -> DataFrame:
    """The given columns of the documents without a hit, texts unchanged."""
    found = find_hits(docs, benchmark, list(columns), n, prefix="__found_")
    return found.filter(~F.col("__found_contaminated")).select(*columns)
