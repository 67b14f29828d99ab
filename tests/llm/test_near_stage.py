"""The near-copy stage at five words and 0.8, and the join at other settings,
against brute force."""

import random

import corpus_pipeline
import pytest
from brute import near_components as components

from lakegraph.llm import jaccard_join


def test_stage_drops_copies_between_the_settings(spark):
    rows = []
    for n, edits in ((48, 1), (49, 1), (58, 1), (59, 1), (94, 2), (115, 2)):
        w = [f"w{n}_{i}" for i in range(n)]
        rows.append((len(rows), " ".join(w)))
        for k in range(edits):
            w[(k + 1) * n // (edits + 1)] = f"x{k}"
        rows.append((len(rows), " ".join(w)))
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id for r in corpus_pipeline.ngram_jaccard_join(spark, docs, "").collect()}
    assert left == {0, 1, 2, 4, 6, 8, 10}               # at 48 words one changed word is too much
    assert left == {d for d, (_, c) in components(rows, 5, 80).items() if d == c}
    assert {d for d, (_, c) in components(rows, 3, 90).items() if d == c} == {0, 1, 2, 3, 4, 5, 6, 8, 9, 10, 11}


@pytest.mark.parametrize(("size", "percent"), [(5, 80), (3, 80), (4, 67), (5, 95)])
def test_join_equals_brute_force_at_other_settings(spark, size, percent):
    rnd, rows = random.Random(size * percent), []
    for n in (1, 4, 5, 7, 8, 9, 10, 14, 30, 47, 60, 120, 400):
        base = [f"{n}_{i}" for i in range(n)]
        for _ in range(14):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, n // 20))):
                i = rnd.randrange(len(w)) if w else 0
                w[i:i + 1] = rnd.choice([[], [f"n{rnd.random()}"], [*w[i:i + 1] * 2]])
            rows.append((len(rows) * 3, " ".join(w)))
    rows += [(10_000 + i, " ".join([f"c{j}" for j in range(4 * i, 300)] + [f"d{j}" for j in range(4 * i)])) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = {d: (n, c if n else d) for d, (n, c) in components(rows, size, percent).items()}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar(df, size, percent).collect()} == want


def test_repeated_rows_and_shared_ids(spark):
    """One row of each component stays, whatever ids its rows carry."""
    base = [f"w{i}" for i in range(80)]
    a, other = " ".join(base), " ".join(f"o{i}" for i in range(60))
    near = " ".join(["x", *base[1:]])
    rows = [(1, a), (1, a), (1, a.upper()), (2, a), (2, other), (3, near), (None, near), (None, other), (None, "alone " * 9), (None, None), (2, ""),
            (5, "five six"), (5, "five  SIX"), (6, "five six"), (7, None), (7, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(d, t, "en", "s", i) for i, (d, t) in enumerate(rows)], schema).repartition(3)
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.ngram_jaccard_join(spark, docs, "").collect()), key=str)
    want = [(1, a.upper()), (2, other), (None, "alone " * 9), (None, None), (2, ""), (5, "five  SIX"), (7, None), (7, None)]
    assert got == sorted(want, key=str)
    two = spark.createDataFrame([(1, a), (1, a), (2, a), (2, other)], "doc_id long, text string")
    left = jaccard_join.keep_smallest(two, ("text", "doc_id")).collect()
    assert sorted((r.doc_id, r.text) for r in left) == [(1, a), (2, other)]
