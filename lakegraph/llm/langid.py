"""Language identification by a linear-chain conditional random field.

Each word of a text is labelled with a language by forward-backward over
emissions (hashed affixes and byte n-grams, a corpus lexicon) and learned
transitions, so code-switched texts get mixed labels. A document's language is
the label with the largest mean marginal over its words; that mean is its
score.

The lexicon counts the words of all training documents by language in a table
of fixed size. The weights are fitted to a bounded sample (``SAMPLE_DOCS``
rows of up to ``SAMPLE_BYTES`` bytes, by hash of doc_id); runs of sample words
in different languages follow each other, which is what transitions learn
from. Every whole text is labelled.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is every text when nothing is labelled; repeated rows get equal results;
equal marginals go to the first label in sorted order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegraph.llm import words

SAMPLE_DOCS, SAMPLE_BYTES = 800, 8_000
LEXICON, TABLE = 1 << 17, 1 << 16
RUN, RUNS, SEGMENT = 40, 6, 32
STEPS, RATE, DECAY = 40, 0.4, 1e-4
UND = "und"
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


class Words:
    """The distinct words of a flat batch with their features."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        data = words.LOWER[data]
        starts, ends, self.first = words.spans(data, offs, words.NOT_SPACE)
        hashes = words.word_hashes(data, starts, ends)
        unique, at, self.of = np.unique(hashes, return_index=True, return_inverse=True)
        s, e = starts[at], ends[at]
        self.bucket = (unique >> words.U64(20)) % words.U64(LEXICON)
        lens = e - s
        # byte trigrams with the word's edges as zero bytes
        self.begin = np.cumsum(lens + 4) - (lens + 4)
        place = np.arange(int(lens.sum()))
        word = np.repeat(np.arange(len(lens)), lens)
        i = s[word] + place - np.repeat(np.cumsum(lens) - lens, lens)
        here = data[i].astype(np.int64)
        left = np.where(i > s[word], data[np.maximum(i - 1, 0)], 0).astype(np.int64)
        right = np.where(i + 1 < e[word], data[np.minimum(i + 1, len(data) - 1)], 0).astype(np.int64)
        feats = np.empty(int(lens.sum()) + 4 * len(lens), dtype=np.int64)
        feats[place + 4 * (word + 1)] = left | here << 8 | right << 16 | 1 << 24
        last = len(data) - 1
        for k, n in enumerate((2, 3)):
            pre = sum(np.where(s + j < e, data[np.minimum(s + j, last)], 0).astype(np.int64) << (8 * j) for j in range(n))
            suf = sum(np.where(e - 1 - j >= s, data[np.maximum(e - 1 - j, 0)], 0).astype(np.int64) << (8 * j) for j in range(n))
            feats[self.begin + 2 * k] = pre | (2 + k) << 24
            feats[self.begin + 2 * k + 1] = suf | (4 + k) << 24
        self.feats = (words.mix(feats.astype(words.U64)) >> words.U64(30)) % words.U64(TABLE)
        self.word_of_feat = np.repeat(np.arange(len(lens)), lens + 4)

    def emissions(self, model: dict) -> np.ndarray:
        """Scores of each distinct word by label."""
        if not len(self.begin):
            return np.zeros((0, len(model["labels"])))
        return np.add.reduceat(model["table"][self.feats], self.begin, axis=0) + model["lexicon"][self.bucket] * model["weight"]


def chains(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut rows into segments of SEGMENT words: (word numbers by segment and
    step, -1 past the end; row of each segment; its number in the row)."""
    counts = np.diff(first)
    per_row = -(-counts // SEGMENT)
    row = np.repeat(np.arange(len(counts)), per_row)
    k = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    at = (first[:-1][row] + k * SEGMENT)[:, None] + np.arange(SEGMENT)
    return np.where(at < first[1:][row][:, None], at, -1), row, k


def marginals(scores: np.ndarray, first: np.ndarray, trans: np.ndarray, pairs: bool = False):
    """Posterior of each word's label (words x labels), all rows at once: the
    transfer matrix of each segment, then boundary vectors along the segments,
    then both passes inside all segments in step."""
    n_labels = trans.shape[0]
    at, row, k = chains(first)
    n = len(row)
    e = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
    a = np.exp(trans - trans.max())
    real = at >= 0
    # first words of a row have no transition before them
    start = (k == 0)
    em = np.where(real[:, :, None], e[np.maximum(at, 0)] if len(e) else np.ones((1, n_labels)), 1.0)
    through = np.tile(np.eye(n_labels), (n, 1, 1))
    for t in range(SEGMENT):
        go = real[:, t] & ~start if t == 0 else real[:, t]
        step = np.where(go[:, None, None], (through.reshape(-1, n_labels) @ a).reshape(n, n_labels, n_labels), through)
        through = step * em[:, t, None, :]
        through /= through.max(axis=(1, 2), keepdims=True)
    alpha_in = np.full((n, n_labels), 1.0 / n_labels)
    beta_out = np.full((n, n_labels), 1.0 / n_labels)
    by_k = np.argsort(k, kind="stable")
    edges = np.searchsorted(k[by_k], np.arange(int(k.max()) + 2 if n else 1))
    for j in range(1, len(edges) - 1):                     # segments j follow segments j - 1 of their rows
        now = by_k[edges[j]:edges[j + 1]]
        v = np.einsum("ni,nij->nj", alpha_in[now - 1], through[now - 1])
        alpha_in[now] = v / v.sum(axis=1, keepdims=True)
    for j in range(len(edges) - 2, 0, -1):
        now = by_k[edges[j]:edges[j + 1]]
        v = np.einsum("nij,nj->ni", through[now], beta_out[now])
        beta_out[now - 1] = v / v.sum(axis=1, keepdims=True)
    alpha = np.empty((SEGMENT, n, n_labels))
    v = alpha_in
    for t in range(SEGMENT):
        go = real[:, t] & ~start if t == 0 else real[:, t]
        v = np.where(go[:, None], v @ a, v) * em[:, t]
        v = v / v.sum(axis=1, keepdims=True)
        alpha[t] = v
    out = np.zeros((len(scores), n_labels))
    expected = np.zeros((n_labels, n_labels))
    b = beta_out
    for t in range(SEGMENT - 1, -1, -1):
        g = alpha[t] * b
        g /= g.sum(axis=1, keepdims=True)
        ok = real[:, t]
        out[at[ok, t]] = g[ok]
        go = ok & ~start if t == 0 else ok
        if pairs:
            before = alpha[t - 1] if t else alpha_in
            x = before[:, :, None] * a * (em[:, t] * b)[:, None, :]
            x /= x.sum(axis=(1, 2), keepdims=True)
            expected += x[go].sum(axis=0)
        b = np.where(go[:, None], (em[:, t] * b) @ a.T, em[:, t] * b)
        b = b / b.sum(axis=1, keepdims=True)
    return (out, expected) if pairs else out


def lexicon(labelled: DataFrame, labels: list[str]) -> np.ndarray:
    """Log share of each word bucket by label, centred, over all labelled
    documents; LEXICON x labels values whatever the corpus size."""
    code = {x: i for i, x in enumerate(labels)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((LEXICON, len(labels)), dtype=np.int64)
        for b in batches:
            lang = np.array([code[x] for x in b["lang"].to_pylist()], dtype=np.int64)
            for row, end, data, offs in words.chunks(b["text"]):
                data = words.LOWER[data]
                s, e, first = words.spans(data, offs, words.NOT_SPACE)
                bucket = ((words.word_hashes(data, s, e) >> words.U64(20)) % words.U64(LEXICON)).astype(np.int64)
                cell = bucket * len(labels) + np.repeat(lang[row:end], np.diff(first))
                table += np.bincount(cell, minlength=table.size).reshape(table.shape)
        cell = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(table.ravel()[cell])], names=["cell", "n"])

    counted = labelled.select("text", "lang").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    got = counted.toArrow()                                # at most LEXICON x labels rows
    table = np.zeros(LEXICON * len(labels))
    table[got["cell"].to_numpy()] = got["n"].to_numpy()
    table = table.reshape(LEXICON, len(labels))
    share = np.log((table + 0.5) / (table.sum(axis=0) + 0.5 * LEXICON))
    return (share - share.mean(axis=1, keepdims=True)).astype(np.float32)


def fit(sample: list[tuple[str, str]], labels: list[str], lex: np.ndarray) -> dict:
    """Weights by gradient ascent on the likelihood of mixed runs."""
    model = {"labels": labels, "lexicon": lex, "weight": 0.3, "trans": np.eye(len(labels)) * 2.0,
             "table": np.zeros((TABLE, len(labels)), dtype=np.float32)}
    data, offs = words.flat(pa.array([t for t, _ in sample], pa.string()))
    feats = Words(data, offs)
    lang = np.repeat([labels.index(x) for _, x in sample], np.diff(feats.first)).astype(np.int64)
    # cut into runs, mix the runs, join RUNS of them to one chain
    run_at = np.concatenate([np.arange(a, b, RUN) for a, b in zip(feats.first[:-1], feats.first[1:], strict=True)])
    run_end = np.minimum(run_at + RUN, feats.first[np.searchsorted(feats.first, run_at, side="right")])
    order = np.random.default_rng(7).permutation(len(run_at))
    picked = np.concatenate([np.arange(run_at[r], run_end[r]) for r in order])
    bounds = np.concatenate([[0], np.cumsum((run_end - run_at)[order])])
    first = np.unique(np.concatenate([bounds[::RUNS], bounds[-1:]]))
    of, y = feats.of[picked], lang[picked]
    inner = np.ones(len(y), dtype=bool)
    inner[first[:-1]] = False
    seen = np.zeros_like(model["trans"])
    np.add.at(seen, (y[:-1][inner[1:]], y[1:][inner[1:]]), 1)
    g_table, g_trans, g_weight = np.full(TABLE, 1e-8)[:, None], 1e-8, 1e-8
    n = len(y)
    for _ in range(STEPS):
        p, expected = marginals(feats.emissions(model)[of], first, model["trans"], pairs=True)
        miss = -p
        miss[np.arange(n), y] += 1.0
        by_word = np.stack([np.bincount(of, weights=miss[:, c], minlength=len(feats.begin)) for c in range(len(labels))], axis=1)
        d = np.stack([np.bincount(feats.feats.astype(np.int64), weights=by_word[feats.word_of_feat, c], minlength=TABLE)
                      for c in range(len(labels))], axis=1) / n - DECAY * model["table"] / 10
        d_weight = float((by_word * lex[feats.bucket]).sum() / n) - DECAY * model["weight"]
        d_trans = (seen - expected) / n - DECAY * model["trans"]
        g_table, g_trans, g_weight = g_table + (d * d).sum(axis=1, keepdims=True), g_trans + (d_trans ** 2).sum(), g_weight + d_weight ** 2
        model["table"] += (RATE * d / np.sqrt(g_table)).astype(np.float32)
        model["trans"] = model["trans"] + RATE * d_trans / np.sqrt(g_trans)
        model["weight"] += RATE * 0.2 * d_weight / np.sqrt(g_weight)
    return model


def train(labelled: DataFrame) -> dict | None:
    """A model of fixed size from (doc_id, text, lang) rows; None without any."""
    labelled = labelled.filter("text is not null and lang is not null")
    counts = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    labels = sorted(counts)
    if not labels:
        return None
    lex = lexicon(labelled, labels)
    # a share of the rows by hash first, about four times the sample, so that few
    # texts are sorted and sent however many tasks there are
    h = F.xxhash64("doc_id", "text")
    share = min(1.0, 4.0 * SAMPLE_DOCS / sum(counts.values()))
    rows = (labelled.filter(F.pmod(h, F.lit(1_000_000_007)) <= int(share * 1_000_000_007))
            .filter((F.octet_length("text") <= SAMPLE_BYTES) & F.col("text").rlike(r"\S"))
            .select("text", "lang", h.alias("h")).orderBy("h", "text").limit(SAMPLE_DOCS).collect())
    sample = [(r.text, r.lang) for r in rows]
    if not sample:
        return {"labels": labels, "lexicon": lex, "weight": 1.0, "trans": np.eye(len(labels)) * 2.0,
                "table": np.zeros((TABLE, len(labels)), dtype=np.float32)}
    return fit(sample, labels, lex)


def has_letter(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data], dtype=np.int64)])
    out = total[offs[1:]] > total[offs[:-1]]
    for i in np.flatnonzero(~out & (np.diff(offs) > 0)):
        out[i] = any(c.isalpha() for c in data[offs[i]:offs[i + 1]].tobytes().decode())
    return out


def predict_batch(model: dict, data: np.ndarray, offs: np.ndarray) -> tuple[list[str], np.ndarray]:
    w = Words(data, offs)
    ok = has_letter(data, offs)
    p = marginals(w.emissions(model)[w.of], w.first, model["trans"]) if len(w.of) else np.zeros((0, len(model["labels"])))
    total = np.concatenate([np.zeros((1, p.shape[1])), np.cumsum(p, axis=0)])
    mean = (total[w.first[1:]] - total[w.first[:-1]]) / np.maximum(np.diff(w.first), 1)[:, None]
    best = np.argmax(np.round(mean, 12), axis=1)
    score = np.where(ok, np.clip(mean[np.arange(len(best)), best], 0.0, 1.0), 0.0)
    return [model["labels"][b] if o else UND for b, o in zip(best, ok, strict=True)], score


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; docs has doc_id,
    text and held_out."""
    rows = docs.select("doc_id", "held_out", "text")
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, end, data, offs in words.chunks(b["text"]):
                lang, score = predict_batch(sent.value, data, offs)
                part = b.slice(row, end - row)
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["held_out"], pa.array(lang, pa.string()), pa.array(score)],
                                                 names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def fold(doc_id: F.Column, parts: int, part: int) -> F.Column:
    """True where crc32(doc_id as text) mod parts is part; a null id is in no
    such fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))
