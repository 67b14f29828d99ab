"""URL filter over a sorted digest array.

Every listed string (a rule ``host + path prefix``, or a blocked host) is kept
under its 64-bit xxHash in sorted key files. A task memory-maps the files,
probes all candidate strings of a batch with one binary search per file, and
compares the stored string of every equal key, so a digest collision can never
match. Longer listed strings win; of equal length, the longer host.

Defined cases: a null url, or one without ``://``, has empty host and path and
gets the default verdict ``allow``; repeated rows give repeated results; an
empty list or table gives no match or no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegraph.llm import store

SEED = 42                      # of Spark's xxhash64, so keys can be made by either side
ALLOW, BLOCK, LISTED = 0, 1, 2  # rule that allows, rule that blocks, entry of the block list
ENTRIES_PER_FILE = 4_000_000
BLOCKED_HOSTS = tuple(f"{name}.example.{top}" for name in ("spam-farm", "cheap-pills") for top in ("com", "net", "org"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end,
    A-Z lower-cased. Path: from there up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def entries(spark: SparkSession, rules: list[tuple[str, str, str]], blocked_hosts: tuple[str, ...]) -> DataFrame:
    """(host, path, kind) rows of rules (action, host, path) and blocked hosts."""
    rows = [(h, p, ALLOW if a == "allow" else BLOCK) for a, h, p in rules]
    rows += [(h, "", LISTED) for h in blocked_hosts]
    return spark.createDataFrame(rows, "host string, path string, kind int")


def write_digest_files(listed: DataFrame, per_file: int = ENTRIES_PER_FILE) -> list[str]:
    """Sorted key files of the distinct (host, path, kind) rows; returns their
    paths. Files are split by key range, so the list may be of any size; only
    the file names come to the driver."""
    keyed = listed.dropna(subset=["host", "path"]).distinct().withColumn(
        "key", F.xxhash64(F.concat("host", "path")))
    keyed = store.saved(keyed, "url-list")
    n = keyed.count()
    folder = store.workspace(listed.sparkSession, "url-digests")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches([b for b in batches if b.num_rows] or [], schema=_KEYED)
        if not rows.num_rows:
            return
        path = store.task_file(folder, ".arrow")
        with store.open_output(path) as out, pa.ipc.new_file(out, rows.schema) as f:
            f.write_table(rows.combine_chunks())
        yield pa.RecordBatch.from_pydict({"path": [path]})

    keyed = keyed.select("key", "host", "path", "kind")
    files = (keyed.repartitionByRange(max(1, -(-n // per_file)), "key").sortWithinPartitions("key", "host", "path")
             .mapInArrow(write, "path string"))
    return sorted(r.path for r in files.collect())


_KEYED = pa.schema([("key", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("kind", pa.int32())])


class DigestArray:
    """Memory-mapped key files; ``find`` probes many strings at once."""

    def __init__(self, paths: list[str]):
        self.tables = [pa.ipc.open_file(store.open_input(p)).read_all() for p in paths]
        self.keys = [t.column("key").chunk(0).to_numpy(zero_copy_only=True) for t in self.tables]
        lengths = {len(p) for t in self.tables for p in t.column("path").unique().to_pylist()}
        self.path_lengths = sorted(lengths, reverse=True)

    def find(self, probes: list[tuple[str, str]]) -> list[list[int]]:
        """Kinds listed under each (host, path)."""
        out: list[list[int]] = [[] for _ in probes]
        wanted = np.array([xxhash.xxh64_intdigest((h + p).encode(), SEED) for h, p in probes],
                          dtype=np.uint64).view(np.int64)
        for table, keys in zip(self.tables, self.keys, strict=True):
            lo = np.searchsorted(keys, wanted, side="left")
            hi = np.searchsorted(keys, wanted, side="right")
            for i in np.flatnonzero(hi > lo):
                for row in range(lo[i], hi[i]):
                    if (table["host"][row].as_py(), table["path"][row].as_py()) == probes[i]:
                        out[i].append(table["kind"][row].as_py())
        return out


def suffixes(host: str) -> list[str]:
    """The host and its parent domains, longest first."""
    labels = host.split(".")
    return [".".join(labels[i:]) for i in range(len(labels))] if host else []


def judge(pages: DataFrame, files: list[str]) -> DataFrame:
    """Adds host, path, rule and verdict to (page_id, url) rows."""
    host, path = host_and_path(F.col("url"))
    schema = "page_id long, host string, path string, rule string, verdict string"

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(files)
        for b in batches:
            hosts, paths = b["host"].to_pylist(), b["path"].to_pylist()
            # candidates of each distinct (host, path start): host suffixes x listed path lengths
            longest = max(array.path_lengths, default=0)
            starts = [(h, p[:longest]) for h, p in zip(hosts, paths, strict=True)]
            found: dict[tuple[str, str], tuple[str | None, str]] = {}
            probes: dict[tuple[str, str], int] = {}
            for h, p in dict.fromkeys(starts):
                for s in suffixes(h):
                    for n in array.path_lengths:
                        if n <= len(p):
                            probes.setdefault((s, p[:n]), len(probes))
            kinds = array.find(list(probes))
            for h, p in dict.fromkeys(starts):
                best, listed = None, False
                for s in suffixes(h):
                    for n in array.path_lengths:
                        for kind in kinds[probes[s, p[:n]]] if n <= len(p) else ():
                            listed |= kind == LISTED
                            if kind != LISTED:
                                best = max(best or (0, 0), (len(s) + n, len(s), s + p[:n], kind))
                verdict = ("block" if listed else "allow") if best is None else "allow" if best[3] == ALLOW else "block"
                found[h, p] = (best[2] if best else None, verdict)
            got = [found[x] for x in starts]
            yield pa.RecordBatch.from_arrays(
                [b["page_id"], b["host"], b["path"], pa.array([r for r, _ in got], pa.string()),
                 pa.array([v for _, v in got], pa.string())], names=["page_id", "host", "path", "rule", "verdict"])

    return pages.select("page_id", host.alias("host"), path.alias("path")).mapInArrow(probe, schema)


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]],
                blocked_hosts: tuple[str, ...] = BLOCKED_HOSTS) -> DataFrame:
    """Verdict per page: the longest fitting rule's, else ``block`` when the
    host or a parent domain is on the block list, else ``allow``."""
    return judge(pages, write_digest_files(entries(pages.sparkSession, rules, blocked_hosts)))
