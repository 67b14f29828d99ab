"""Document quality rules with host-level verdicts.

Rules are judged per document; failures are aggregated by host (the
``source`` column), each host's failure rate is shrunk by a beta prior fitted
to all hosts by the method of moments, and hosts above ``max_rate`` lose all
their documents.

Defined cases: a null text has no words and fails the word-count rule; a null
host forms no group, its documents are judged by their own rules only; an
empty table gives no rows; repeated rows each count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakegraph.llm import store, words

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW, MAX_RATE = 10, 20, 5, 0.5
MIN_WEIGHT = 10.0     # the prior weighs at least as much as so many documents
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_IN_LINE = np.ones(256, dtype=bool)
_IN_LINE[10] = False
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_row(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offs[1:]] - total[offs[:-1]]


def _again(keys: np.ndarray) -> np.ndarray:
    """True where an equal key stands earlier."""
    order = np.argsort(keys, kind="stable")
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return out


def _in_row(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return words.mix(hashes + words.mix(rows.astype(words.U64) + words.U64(1)))


def measure(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """The MEASURES of each row of a flat batch."""
    n = len(offs) - 1
    starts, ends, word_of_row = words.spans(data, offs, words.NOT_SPACE)
    hashes = words.word_hashes(data, starts, ends)
    # repeated windows, as runs of words
    at, rows = words.runs_in_rows(word_of_row, WINDOW)
    keys = _in_row(words.joined(hashes, WINDOW)[at], rows) if len(at) else np.zeros(0, words.U64)
    twice = _again(keys)
    twice |= _again(keys[::-1])[::-1]
    cover = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    repeated = np.cumsum(cover[:-1]) > 0
    # lines that hold a word
    ls, le, line_of_row = words.spans(data, offs, _IN_LINE)
    has_word = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    line_row = np.repeat(np.arange(n), np.diff(line_of_row))
    ls, le, line_row = ls[has_word], le[has_word], line_row[has_word]
    dup = _again(_in_row(words.word_hashes(data, ls, le), line_row))
    return [np.diff(word_of_row), _per_row(words.NOT_SPACE[data] & _FIRST_BYTE[data], offs),
            _per_row(_SYMBOL[data], offs), np.bincount(line_row[dup], minlength=n), _per_row(repeated, word_of_row)]


def with_measures(docs: DataFrame, keep: tuple[str, ...], prefix: str = "") -> DataFrame:
    """The kept columns and the MEASURES of every whole text; a prefix of their
    names avoids clashes with kept columns."""
    names = [prefix + x for x in MEASURES]
    schema = StructType([docs.schema[c] for c in keep])
    for c in names:
        schema = schema.add(c, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, end, data, offs in words.chunks(b[text]):
                part = b.slice(row, end - row)
                yield pa.RecordBatch.from_arrays(
                    [part[c] for c in keep] + [pa.array(x, pa.int64()) for x in measure(data, offs)],
                    names=[*keep, *names])
        store.release()

    text = "text" if "text" in keep else store.free_name([*keep, *names], "_text")
    extra = [] if text in keep else [F.col("text").alias(text)]
    return docs.select(*keep, *extra).mapInArrow(run, schema)


def base_failed(min_words: int = MIN_WORDS, max_percent: int = MAX_REPEAT_PERCENT, prefix: str = "") -> Column:
    n, repeated = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (n < min_words) | (100 * repeated > max_percent * n)


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """(alpha, beta) by moments of the host rates; hosts has n and failed.
    Without spread between hosts the prior weighs as much as all documents."""
    p = F.sum("failed") / F.sum("n")
    r = hosts.agg(F.sum("n").cast("double").alias("n"), p.cast("double").alias("m"),
                  F.count(F.lit(1)).cast("double").alias("k"),
                  F.avg(F.expr("failed / n")).cast("double").alias("mean"),
                  F.var_pop(F.expr("failed / n")).cast("double").alias("var"),
                  F.avg(F.expr("1.0D / n")).cast("double").alias("inv")).first()
    if not r.n:
        return 1.0, 1.0
    m = (r.m * r.n + 0.5) / (r.n + 1.0)                 # never exactly 0 or 1
    between = r.var - m * (1 - m) * r.inv               # what sampling does not explain
    weight = m * (1 - m) / between - 1 if between > 0 else r.n
    weight = max(min(weight, r.n + 1.0), MIN_WEIGHT)
    return m * weight, (1 - m) * weight


def host_verdicts(judged: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per host: n, failed, shrunk rate, rejected."""
    hosts = (judged.filter(F.col("source").isNotNull()).groupBy("source")
             .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")))
    alpha, beta = beta_prior(hosts)
    return hosts.withColumn("rate", (F.col("failed") + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta))) \
                .withColumn("rejected", F.col("rate") > max_rate)


def judge(docs: DataFrame, keep: tuple[str, ...], max_rate: float = MAX_RATE) -> DataFrame:
    """Adds measures, base_failed and kept to the given columns (``source``
    among them). Measures are written once and read by both the host
    aggregate and the join. Kept columns named like these are replaced."""
    keep = tuple(c for c in keep if c not in (*MEASURES, "base_failed", "kept"))
    judged = store.saved(with_measures(docs, keep).withColumn("base_failed", base_failed()), "quality")
    host, mark = (store.free_name(judged.columns, x) for x in ("_host", "_bad"))
    bad = host_verdicts(judged, max_rate).filter("rejected").select(F.col("source").alias(host), F.lit(True).alias(mark))
    return (judged.join(bad, F.col("source") == F.col(host), "left")
            .withColumn("kept", ~F.col("base_failed") & F.col(mark).isNull()).drop(host, mark))


def keep(docs: DataFrame, columns: tuple[str, ...], max_rate: float = MAX_RATE) -> DataFrame:
    """The given columns of the documents that pass, texts unchanged. The
    host verdicts come from a first pass; the second judges each document
    again instead of moving whole texts through a join."""
    judged = store.saved(with_measures(docs, ("source",)).select("source", base_failed().alias("base_failed")), "quality")
    bad = host_verdicts(judged, max_rate).filter("rejected").select("source")
    good = with_measures(docs, columns, "__m_").filter(~base_failed(prefix="__m_")).select(*columns)
    return good.join(bad, "source", "left_anti").select(*columns)
