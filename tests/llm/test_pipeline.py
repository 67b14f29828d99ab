"""The pipeline's rows against brute force, stage by stage."""

import hashlib
import zlib

import brute
import corpus_pipeline
import numpy as np
import pytest
from tokenizers import Tokenizer

from lakegraph.llm import decontaminate, queries, store

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = queries.read(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = store.saved(stage(spark, docs, SF), f"test-{name}")
        out.append((name, docs))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def clean(text, items):
    words = decontaminate.item_words(text)
    grams = {n: {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} for n in {len(x) for x in items}}
    return not any(x in grams[len(x)] for x in items)


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "suffix_array_dedup",
                                                      "benchmark_decontamination", "best_fit_packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_every_stage_equals_brute_force(spark, stages):
    docs = rows(queries.read(spark, SF, "documents"))
    for name, df in stages[:-1]:
        assert tuple(df.columns) == corpus_pipeline.COLUMNS, name
    kept = {r.doc_id for r in queries.op5_quality_rules(spark, SF).collect() if r.kept}
    one = rows(stages[0][1])
    assert set(one) == kept and all(one[d].text == docs[d].text for d in one)
    parts = brute.near_components([(d, r.text) for d, r in one.items()], 5, 80)
    two = rows(stages[1][1])
    assert set(two) == {d for d, (n, c) in parts.items() if n == 0 or c == d}
    cut = brute.suffix_dedup([(d, r.text) for d, r in two.items()])
    three = rows(stages[2][1])
    assert set(three) == set(two)
    for d, (n, removed, _, sha) in cut.items():
        if not removed:
            assert three[d].text == two[d].text
        else:
            assert len(three[d].text.encode()) <= n - removed and three[d].n_chars == len(three[d].text)
            if hashlib.sha256(three[d].text.encode()).hexdigest() != sha:      # a character was cut apart
                assert n - removed - len(three[d].text.encode()) <= 6 * cut[d][2]
    items = set()
    for r in queries.read(spark, SF, "benchmark").collect():
        w = decontaminate.item_words(r.text)
        size = min(10, len(w))
        items |= {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if size else set()
    four = rows(stages[3][1])
    assert set(four) == {d for d, r in three.items() if clean(r.text, items)}
    tokenizer = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    ids = {d: np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2], dtype="<u4") for d, r in four.items()}
    seen = {}
    for r in stages[4][1].collect():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length])
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
    assert seen == {d: len(x) for d, x in ids.items()}


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == stages[-1][1].columns
    key = lambda df: sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())
    assert key(got) == key(stages[-1][1])


def test_stages_take_empty_tables_and_extra_columns(spark):
    docs = queries.read(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
    from pyspark.sql import functions as F
    some = queries.read(spark, SF, "documents").limit(30).withColumn("n_words", F.lit("x")).withColumn("component_id", F.lit("y"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert tuple(stage(spark, some, SF).columns) == corpus_pipeline.COLUMNS, name


def test_null_rows_pass_through_every_stage(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (3, "", "en", "s", 0), (None, "word " * 20, None, None, 5),
                                  (4, " ".join(f"a{i}" for i in range(40)), None, None, None)],
                                 queries.read(spark, SF, "documents").schema)
    for name, stage in corpus_pipeline.STAGES:
        docs = store.saved(stage(spark, docs, SF), f"null-{name}")
    assert {r.doc_id for r in docs.collect()} == {4}
