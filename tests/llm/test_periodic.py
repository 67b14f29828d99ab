"""Periodic runs: grammar and runs against brute force."""

import hashlib
import random
import zlib

import brute
import numpy as np
import pytest

from lakegraph.llm import periodic, queries, repair

SF = "/root/testdata/sf0.001"


def brute_runs(w):
    """(start, length, period) of all runs, by comparing at every distance."""
    n, found = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(6, 4 * q):
                found.setdefault((s, i + q - s), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def turned(doc_id, text):
    w = brute.SPACE_WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def sequences(seed):
    rnd, out = random.Random(seed), []
    for _ in range(rnd.randint(1, 6)):
        k = rnd.choice([1, 2, 3, 5, 50])
        w = [rnd.randrange(k) for _ in range(rnd.randint(0, 40))]
        for _ in range(rnd.randint(0, 3) if w else 0):
            a = rnd.randrange(len(w))
            w[a:a + 9] = w[a:a + rnd.randint(1, 9)] * rnd.randint(1, 9)
        out.append(w * rnd.choice([1, 1, rnd.randint(2, 7)]))
    return out


def flat(seqs):
    first = np.cumsum([0] + [len(x) for x in seqs])
    ids = np.array([1000 * r + x for r, w in enumerate(seqs) for x in w], dtype=np.int64)
    return np.unique(ids, return_inverse=True)[1], first


def test_runs_equal_brute_force():
    for seed in range(400):
        seqs = sequences(seed)
        ids, first = flat(seqs)
        got = sorted((int(s), int(e - s), int(p)) for s, e, p in zip(*periodic.runs(ids, first), strict=True))
        assert got == sorted((int(f) + s, n, q) for f, w in zip(first, seqs, strict=False) for s, n, q in brute_runs(w)), seed


def test_grammar_expands_to_the_sequence():
    for seed in range(200):
        ids, _ = flat(sequences(seed))
        g = repair.grammar(ids)
        spans = {}
        for of, at in zip(g.of.tolist(), g.at.tolist(), strict=True):          # all positions of a nonterminal read the same
            spans.setdefault(of, set()).add(tuple(ids[at:at + g.size[of]].tolist()))
        assert all(len(x) == 1 for x in spans.values())
        assert all(n >= 2 for n in np.bincount(g.of)) if len(g.of) else True   # each is used twice at least


def test_repeats_are_compressed():
    rng = np.random.default_rng(4)
    ids = np.tile(np.unique(rng.integers(0, 300, 1000), return_inverse=True)[1], 64)
    g = repair.grammar(ids)
    assert len(g.starts) <= 200 and g.size.max() >= 1000        # 64 turns in a few symbols
    assert len(repair.grammar(np.arange(50)).size) == 0 and len(repair.grammar(ids[:0]).starts) == 0


def test_false_equalities_are_found_out(monkeypatch):
    """With a hash that calls much equal, the batch is worked again."""
    made = []

    class Weak(periodic._Equal):
        def __init__(self, ids, salt):
            super().__init__(ids if len(made) else ids % 2, salt)
            made.append(salt)

    monkeypatch.setattr(periodic, "_Equal", Weak)
    w = [0, 2, 0, 2, 0, 4] * 3 + [0, 2] * 5
    ids = np.array(w)
    got = [(int(s), int(e - s), int(p)) for s, e, p in zip(*periodic.runs(ids, np.array([0, len(w)])), strict=True)]
    assert len(made) == 2 and got == brute_runs(w)


def test_texts(spark):
    texts = [None, "", " \n", "a", "a a a a a a", "x " + "b c " * 4 + "b y", ("one two three " * 400).strip(), "é ß " * 9, "a\tb\na b\x0ba b a b",
             " ".join(f"w{i}" for i in range(300)), "q " * 30_000, "a a a a a a b a a a a a a b " * 5]
    rows = [(i if i != 5 else None, t, "clash", 7) for i, t in enumerate([*texts, texts[6]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_runs string, _text int").repartition(3)
    got = periodic.find_runs(df, ("doc_id", "_text", "text")).collect()
    assert len(got) == len(rows)
    by_text = {}
    for r in got:
        assert r._text == 7
        by_text.setdefault(r.text, []).append(r)
    for t in texts:
        w = brute.SPACE_WORD.findall(t or "")
        want = brute_runs(w) if len(w) < 5000 else [(0, len(w), 1)]
        for r in by_text[t]:
            assert [(x.start, x.length, x.period) for x in r.runs] == want
            assert (r.n_words, r.n_runs, r.collapsed) == (len(w), len(want), collapsed(w, want))
    assert len(by_text[texts[6]]) == 2
    assert periodic.find_runs(df.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [1 << 21, 1 << 10])
def test_query_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(periodic, "_TEXTS", chunk)
    docs = {r.doc_id: r.text for r in queries.read(spark, SF, "documents").collect()}
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert set(got) == set(docs)
    some = 0
    for d, text in docs.items():
        w = turned(d, text)
        if len(w) > 3000:
            continue
        r, want = got[d], brute_runs(w)
        some += bool(want)
        best = min(((-n, s, q) for s, n, q in want), default=None)
        assert (r.n_runs, r.start) == (len(want), best and best[1])
        assert (r.length, r.period, r.exponent_milli) == ((-best[0], best[2], 1000 * -best[0] // best[2]) if best else (None, None, None))
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in want).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, want).encode()).hexdigest()
    assert some >= 10
