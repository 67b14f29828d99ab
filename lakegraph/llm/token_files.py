"""Token ids as Arrow stream files of fixed-size-list batches.

Documents are range-partitioned and sorted by doc_id; each partition becomes
one file whose id stream is cut into equal rows: a fixed-size list of ids and
one of mask bits, the last row padded under a false mask. A mapped file is
read back without a copy: ids are one flat buffer of each batch. Ids are
stored with 16 bits where the vocabulary allows it.

The document index gives file, start in the file and length; the start in the
whole corpus adds the ids of all earlier files.

Defined cases: a null or empty text has just the end id; a null doc_id sorts
first; repeated doc_ids follow each other; an empty table writes no file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegraph.llm import store, tokens

END, ROW, BATCH_ROWS = 2, 1024, 256
PARTITION_BYTES = 32 << 20          # text bytes of a file, about
READ_IDS = 4 << 20                      # ids of the files, in a reading task
INDEX = "doc_id long, file string, at long, n_tokens long, first long"
_INDEX = pa.schema([("doc_id", pa.int64()), ("file", pa.string()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("first", pa.int64())])


@lru_cache(maxsize=4)
def id_type(tokenizer: str) -> np.dtype:
    from tokenizers import Tokenizer
    return np.dtype(np.uint16 if Tokenizer.from_file(tokenizer).get_vocab_size(True) <= 1 << 16 else np.uint32)


class Writer:
    """One stream file; ``add`` takes the ids of documents in order."""

    def __init__(self, path: str, kind: np.dtype, row: int = ROW):
        self.row, self.kind = row, kind
        ids = pa.list_(pa.from_numpy_dtype(kind), row)
        self.schema = pa.schema([("ids", ids), ("mask", pa.list_(pa.bool_(), row))])
        self.out = store.open_output(path)
        self.stream = pa.ipc.new_stream(self.out, self.schema)
        self.held: list[np.ndarray] = []
        self.n = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.kind))
        self.n += len(ids)
        if self.n >= self.row * BATCH_ROWS:
            whole = np.concatenate(self.held)
            cut = len(whole) // (self.row * BATCH_ROWS) * (self.row * BATCH_ROWS)
            for lo in range(0, cut, self.row * BATCH_ROWS):
                self._batch(whole[lo:lo + self.row * BATCH_ROWS], self.row * BATCH_ROWS)
            self.held, self.n = [whole[cut:]], len(whole) - cut

    def _batch(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        self.stream.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(ids), self.row),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), self.row)], schema=self.schema))

    def close(self) -> None:
        if self.n:
            last = np.concatenate(self.held)
            self._batch(np.concatenate([last, np.zeros(-len(last) % self.row, self.kind)]), len(last))
        self.stream.close()
        self.out.close()


def write_tokens(docs: DataFrame, tokenizer: str, byte_level: bool = False,
                 partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """Write the ids of all documents; returns the document index."""
    rows = docs.select("doc_id", "text")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    folder = store.workspace(docs.sparkSession, "token-files")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, at, first = None, store.task_file(folder, ".arrows"), 0, None
        enc = tokens.encoder(tokenizer, byte_level, END)
        for b in batches:
            if not b.num_rows:
                continue
            out = out or Writer(path, id_type(tokenizer))
            for row, found in enc.batches(b["text"]):
                index = []
                for doc, ids in zip(b["doc_id"].slice(row, len(found)).to_pylist(), found, strict=True):
                    out.add(ids)
                    first = doc if first is None else first
                    index.append((doc, path, at, len(ids), first))
                    at += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*index, strict=True), _INDEX, strict=True)], schema=_INDEX)
        if out is not None:
            out.close()
        tokens.release()

    spread = rows.repartitionByRange(max(1, -(-total // partition_bytes)), "doc_id").sortWithinPartitions("doc_id")
    return store.saved(spread.mapInArrow(write, INDEX), "token-index")


def starts(index: DataFrame) -> DataFrame:
    """(file, before): ids of all files before it. One row per file meets in
    the window, a few per gigabyte of text."""
    from pyspark.sql import Window
    files = index.groupBy("file").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.sum("n_tokens").alias("n"))
    order = Window.orderBy(F.col("lo").asc_nulls_first(), F.col("hi").asc_nulls_first(), "file")
    return files.select("file", (F.sum("n").over(order) - F.col("n")).alias("before"))


class Reader:
    """Zero-copy random access to one stream file's ids."""

    def __init__(self, path: str):
        self.batches = list(pa.ipc.open_stream(store.open_input(path)))
        self.ids = [b["ids"].flatten().to_numpy(zero_copy_only=True) for b in self.batches]
        self.ends = np.cumsum([len(x) for x in self.ids])

    def slice(self, at: int, n: int) -> np.ndarray:
        """``n`` ids from place ``at``; a view when they lie in one batch."""
        k = int(np.searchsorted(self.ends, at, side="right"))
        at -= int(self.ends[k - 1]) if k else 0
        parts = []
        while n > 0:
            part = self.ids[k][at:at + n]
            parts.append(part)
            n, at, k = n - len(part), 0, k + 1
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_tokens(index: DataFrame) -> DataFrame:
    """Every document's start, number of ids and their CRC-32, from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, reader = None, None
        for b in batches:
            out = []
            for doc, path, at, n, before in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if path != opened:
                    opened, reader = path, Reader(path)
                ids = reader.slice(at, n).astype("<u4")
                out.append((doc, before + at, len(ids), zlib.crc32(ids)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _READ, strict=True)], schema=_READ)

    rows = index.join(starts(index), "file").select("doc_id", "file", "at", "n_tokens", "before")
    total = index.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    # as many tasks as there are ids for; a long file is read by several
    spread = rows.repartition(max(1, -(-total // READ_IDS)), "file", F.floor(F.col("at") / READ_IDS))
    return spread.sortWithinPartitions("file", "at").mapInArrow(read, READ)
