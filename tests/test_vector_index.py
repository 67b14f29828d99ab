"""The stored vector index: exact rows, recall, pruning, appended vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakegraph.operators import vector_index as vi
from lakegraph.operators import vectors

DIM = 16


def frame(spark, ids, mat):
    return spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, mat, strict=True)], "id long, v array<double>").repartition(3)


@pytest.fixture(scope="module")
def data(spark):
    """Clustered vectors, one cluster with a third of them, ties and bad rows."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, DIM))
    mat = np.concatenate([centres[i % 12] + 0.15 * rng.normal(size=DIM) for i in range(400)] +
                         [centres[0] + 0.15 * rng.normal(size=DIM) for _ in range(200)]).reshape(-1, DIM)
    mat[50] = mat[7]
    mat[51] = 3 * mat[7]
    df = frame(spark, range(600), mat)
    bad = spark.createDataFrame([(900, None), (901, [0.0] * DIM), (902, [1.0, 2.0])], "id long, v array<double>")
    q = frame(spark, range(70), np.concatenate([mat[:40], rng.normal(size=(30, DIM))])).toDF("qid", "qv")
    return df.unionByName(bad), q, mat


@pytest.fixture(scope="module")
def index(data):
    return vi.build(data[0], "id", "v", DIM, cells=12, parts=8, codes=16)


def rows(df):
    return {(r.query_id, r["rank"]): (r.id, round(r.score, 9)) for r in df.collect()}


@pytest.mark.parametrize(("block", "per_cell"), [(65_536, 4096), (40, 7)])
def test_exact_rows_equal_knn_exact(monkeypatch, data, index, block, per_cell):
    monkeypatch.setattr(vi, "BLOCK", block)
    monkeypatch.setattr(vi, "QUERIES", per_cell)
    df, q, _ = data
    hits, read = vi.search_exact(index, q, "qid", "qv", 5)
    assert rows(hits) == rows(vectors.knn_exact(df, "id", "v", q, "qid", "qv", 5, DIM))
    compared = read.agg(F.sum("n")).first()[0]
    assert compared < 0.7 * 600 * 70                     # clusters let cells be passed over
    assert {r.id for r in index.vectors.select("id").collect()} == set(range(600))


def test_exact_with_more_rows_asked_than_there_are(spark, data):
    df, q, _ = data
    few = df.filter("id < 9")
    index = vi.build(few, "id", "v", DIM, cells=4, parts=4, codes=8)
    hits, _ = vi.search_exact(index, q, "qid", "qv", 20)
    assert rows(hits) == rows(vectors.knn_exact(few, "id", "v", q, "qid", "qv", 20, DIM))


def test_codes_find_and_rerank(data, index):
    df, q, _ = data
    exact = {(r.query_id, r.id) for r in vectors.knn_exact(df, "id", "v", q, "qid", "qv", 5, DIM).collect()}
    hits = vi.search_codes(index, q, "qid", "qv", 5, probe=4, rerank=40).collect()
    assert len(hits) == 5 * 70
    assert len({(r.query_id, r.id) for r in hits} & exact) >= 0.9 * len(exact)
    true = {(r.query_id, r.id): r.score for r in vectors.knn_exact(df, "id", "v", q, "qid", "qv", 600, DIM).collect()}
    assert all(abs(true[r.query_id, r.id] - r.score) < 1e-9 for r in hits)
    assert vi.candidates(index, q, "qid", "qv", 1, 300).groupBy("query_id").count().filter("count < 300").count() == 0


def test_only_probed_cells_are_read(data, index):
    _, q, mat = data
    one = q.filter("qid = 3")
    asked = vi._cell_order(index, one, "qid", "qv").filter("i < 2")
    met = vi._met(index, asked, ["id"], lambda a, b: a.select(["id"]), vi.T.StructType.fromDDL("id long"))
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan and "cell#" in plan.split("PartitionFilters")[1][:80] and " IN (" in plan.split("PartitionFilters")[1][:120]
    cells = {r.cell for r in asked.collect()}
    assert met.count() == index.vectors.filter(F.col("cell").isin(list(cells))).count() < 600


def test_appended_vectors_are_found(spark, data):
    df, q, mat = data
    index = vi.build(df.filter("id < 500"), "id", "v", DIM, cells=12, parts=8, codes=16)
    files = set(index.vectors.inputFiles())
    rng = np.random.default_rng(9)
    far = frame(spark, [700, 701], 5 * rng.normal(size=(2, DIM)))
    vi.append(index, df.filter("id >= 500").unionByName(far), "v")
    assert files < set(index.vectors.inputFiles())       # nothing is written again
    more = q.unionByName(far.toDF("qid", "qv"))
    whole = df.unionByName(far)
    assert rows(vi.search_exact(index, more, "qid", "qv", 4)[0]) == rows(vectors.knn_exact(whole, "id", "v", more, "qid", "qv", 4, DIM))
    assert index.cells.agg(F.sum("n")).first()[0] == 602


def test_empty_tables(spark, data, index):
    df, q, _ = data
    empty = vi.build(df.limit(0), "id", "v", DIM, cells=4, parts=4, codes=8)
    assert vi.search_exact(empty, q, "qid", "qv", 3)[0].count() == 0
    assert vi.search_codes(index, q.limit(0), "qid", "qv", 3, 2, 10).count() == 0


def test_parts_must_divide(data):
    with pytest.raises(ValueError, match="divide"):
        vi.build(data[0], "id", "v", DIM, parts=5)
