"""How few sequences packing needs, and how many tasks read files back."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakegraph.llm import packing, queries, token_files, warc


def tasks(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


@pytest.mark.parametrize("seed", range(3))
def test_reopened_bins_hold_every_piece(seed):
    rng = np.random.default_rng(seed)
    sizes = np.concatenate([rng.integers(1, 1025, 3000), rng.integers(300, 700, 2000)])
    where, offset = packing.sum_of_squares(sizes)
    again, at = packing.reopened(sizes, where, offset)
    assert np.array_equal(np.unique(again), np.arange(again.max() + 1)) and again.max() <= where.max()
    order = np.lexsort((at, again))
    w, a, s = again[order], at[order], sizes[order]
    first = np.concatenate([[True], w[1:] != w[:-1]])
    assert (a[first] == 0).all() and (a[1:][~first[1:]] == (a + s)[:-1][~first[1:]]).all()     # gapless
    assert np.bincount(again, weights=sizes).max() <= 1024
    fit, _ = packing.best_gap(sizes)
    assert again.max() + 1 <= 1.01 * (fit.max() + 1)
    assert np.bincount(fit, weights=sizes).max() <= 1024
    assert packing.reopened(sizes[:0], where[:0], offset[:0])[0].size == 0


def test_as_few_sequences_as_best_fit(spark):
    """The whole of sf0.1: within one of best-fit decreasing (9,872)."""
    docs = queries.read(spark, "/root/testdata/sf0.1", "documents")
    got = packing.pack(packing.pieces(docs, queries.vocabulary("byte_bpe_50k.json")))
    r = got.agg(F.count_distinct("sequence_id").alias("n"), F.sum("length").alias("tokens")).first()
    assert r.tokens / 1024 <= r.n <= 9873


def test_archives_are_read_by_several_tasks(spark):
    pages = spark.range(600).select(F.col("id").alias("page_id"), F.lit("http://x.example/").alias("url"),
                                    F.array_join(F.transform(F.sequence(F.lit(0), F.lit(600)), lambda i: F.md5(F.concat(F.col("id"), i).cast("string"))), "").alias("html"))
    index = warc.write_archive(pages.repartition(16, "page_id"))
    old, warc.READ_BYTES = warc.READ_BYTES, 1 << 20
    try:
        got = warc.read_records(index)
        assert tasks(got) > 1 and {r.page_id: r.payload for r in got.collect()} == {r.page_id: bytearray(r.html.encode()) for r in pages.collect()}
        one = warc.write_archive(pages.coalesce(1))
        assert tasks(warc.read_records(one)) > 1         # a single long archive, too
    finally:
        warc.READ_BYTES = old
    assert warc.read_records(warc.write_archive(pages.limit(0))).count() == 0


def test_token_files_are_read_by_several_tasks(spark):
    docs = queries.read(spark, "/root/testdata/sf0.01", "documents")
    index = token_files.write_tokens(docs, queries.vocabulary("word_bpe_49k.json"))
    want = sorted(map(tuple, token_files.read_tokens(index).collect()))
    old, token_files.READ_IDS = token_files.READ_IDS, 1 << 15
    try:
        got = token_files.read_tokens(index)
        assert tasks(got) > 1 and sorted(map(tuple, got.collect())) == want
    finally:
        token_files.READ_IDS = old
