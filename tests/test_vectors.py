"""Nearest-neighbour search against brute force, the vector audit, text vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakegraph.operators import vectors


def _brute(ids, mat, qids, qmat, k):
    out = {}
    mn = mat / np.linalg.norm(mat, axis=1, keepdims=True)
    for qi, q in zip(qids, qmat):
        s = mn @ (q / np.linalg.norm(q))
        order = sorted(range(len(ids)), key=lambda i: (-s[i], ids[i]))[:k]
        out[qi] = [(ids[i], round(float(s[i]), 9)) for i in order]
    return out


@pytest.fixture(scope="module")
def vecs(spark):
    rng = np.random.default_rng(5)
    mat = rng.normal(size=(300, 16))
    mat[10] = mat[20]          # exact ties
    mat[11] = mat[20]
    ids = list(range(300))
    rows = [(i, [float(x) for x in mat[i]]) for i in ids]
    rows.append((1000, [0.0] * 16))          # zero vector: skipped
    rows.append((1001, [1.0] * 8))           # wrong dimension: skipped
    rows.append((1002, None))                # null: skipped
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    qmat = rng.normal(size=(7, 16))
    qmat[0] = mat[20]
    qdf = spark.createDataFrame([(j, [float(x) for x in qmat[j]]) for j in range(7)],
                                "qid int, qv array<double>")
    return df, ids, mat, qdf, list(range(7)), qmat


def test_knn_exact_matches_brute_force_with_ties(vecs):
    df, ids, mat, qdf, qids, qmat = vecs
    got = vectors.knn_exact(df, "id", "v", qdf, "qid", "qv", k=5, dim=16).collect()
    want = _brute(ids, mat, qids, qmat, 5)
    by_q = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by_q.setdefault(r.query_id, []).append((r.id, round(r.score, 9)))
    assert by_q == want
    assert [i for i, _ in by_q[0][:3]] == [10, 11, 20]      # tie broken by id


@pytest.mark.parametrize("cells", [1, 2, 40])
def test_knn_exact_any_number_of_cells(vecs, cells):
    df, ids, mat, qdf, qids, qmat = vecs
    got = vectors.knn_exact(df, "id", "v", qdf, "qid", "qv", k=3, dim=16, cells=cells)
    want = _brute(ids, mat, qids, qmat, 3)
    assert {(r.query_id, r.id) for r in got.collect()} == {(q, i) for q, l in want.items() for i, _ in l}


def test_knn_exact_one_plan_for_few_and_many_queries(spark, vecs):
    import re
    df = vecs[0]

    def plan(n):
        q = spark.range(n).select(F.col("id").alias("qid"), F.array(*[(F.col("id") + i).cast("double") + 1 for i in range(16)]).alias("qv"))
        hits = vectors.knn_exact(df, "id", "v", q, "qid", "qv", k=2, dim=16)
        names = re.findall(r"[A-Z][A-Za-z]+", hits._jdf.queryExecution().executedPlan().toString())
        return hits, [x for x in names if x.endswith(("Exchange", "Arrow", "Window", "Limit", "Scan", "Join", "Range", "Sort"))]
    few, many = plan(10), plan(5000)
    assert few[1] == many[1]
    assert few[0].count() == 20 and many[0].count() == 10_000


def test_wrong_dimensions_take_no_part(spark, vecs):
    df, ids, mat, qdf, qids, qmat = vecs
    ragged = qdf.union(spark.createDataFrame([(90, [1.0, 2.0]), (91, None), (92, [0.0] * 16)], qdf.schema))
    got = vectors.knn_exact(df, "id", "v", ragged, "qid", "qv", k=3, dim=16)
    assert {r.query_id for r in got.collect()} == set(qids)
    assert vectors.knn_exact(df, "id", "v", qdf.limit(0), "qid", "qv", k=3, dim=16).count() == 0


def test_knn_cells_fills_every_query(vecs):
    df, ids, mat, qdf, qids, qmat = vecs
    got = vectors.knn_cells(df, "id", "v", qdf, "qid", "qv", k=40, dim=16, n_clusters=30, n_probe=1).collect()
    per_q = {}
    for r in got:
        per_q.setdefault(r.query_id, set()).add(r.id)
    assert all(len(per_q[q]) == 40 for q in qids) and set().union(*per_q.values()) <= set(ids)


def test_vector_audit(vecs):
    df = vecs[0]
    r = vectors.vector_audit(df, "v", 16).first()
    assert (r.n_vectors, r.n_null, r.n_wrong_dim, r.n_zero_norm) == (303, 1, 1, 1)


def test_centroids(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [3.0, 2.0]), (2, [0.0, 5.0])], "g int, v array<double>")
    got = {r.g: r.centroid for r in vectors.centroids(df, "g", "v").collect()}
    assert got == {1: [2.0, 1.0], 2: [0.0, 5.0]}


def test_text_vectors_unit_norm_whole_text(spark):
    long_text = " ".join(f"w{i}" for i in range(5000)) + " tailword"
    docs = spark.createDataFrame([(1, "alpha beta beta"), (2, "beta gamma"), (3, long_text), (4, None)],
                                 "doc_id long, text string")
    tv = vectors.text_vectors(docs, "doc_id", "text", num_features=1 << 16)
    rows = {r.doc_id: r.features for r in tv.collect()}
    assert len(rows) == 4
    assert abs(np.linalg.norm(rows[1].toArray()) - 1.0) < 1e-9
    # the whole text is hashed: the bucket of the very last word is set
    from pyspark.ml.feature import HashingTF
    tail = HashingTF(inputCol="t", outputCol="f", numFeatures=1 << 16).transform(
        spark.createDataFrame([(["tailword"],)], "t array<string>")).first().f.indices[0]
    assert tail in set(rows[3].indices)


def test_unit_interval_scores_keep_order(vecs):
    df, ids, mat, qdf, qids, qmat = vecs
    hits = vectors.knn_exact(df, "id", "v", qdf, "qid", "qv", k=3, dim=16)
    raw = {(r.query_id, r.id): (r.score, r["rank"]) for r in hits.collect()}
    scaled = {(r.query_id, r.id): (r.score, r["rank"]) for r in vectors.unit_interval(hits).collect()}
    assert raw.keys() == scaled.keys()
    for key, (s, rank) in raw.items():
        assert scaled[key][1] == rank and abs(scaled[key][0] - (1 + s) / 2) < 1e-12


def test_cells_prune_and_find(spark):
    """At sf0.1: every 50th vector asks all vectors; few pairs are compared and
    the true neighbours are found."""
    emb = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    n = emb.count()
    q = emb.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qv"))
    exact = {(r.query_id, r.vec_id) for r in vectors.knn_exact(emb, "vec_id", "embedding", q, "qid", "qv", 5, 64).collect()}
    hits = vectors.knn_cells(emb, "vec_id", "embedding", q, "qid", "qv", 5, 64)
    got = {(r.query_id, r.vec_id) for r in hits.collect()}
    assert len(got) == len(exact) == 5 * q.count()
    assert len(exact & got) / len(exact) >= 0.9
    probes = vectors.probes(emb, "vec_id", "embedding", q, "qid", "qv", 5, 64)
    assert probes.count() <= n * q.count() / 3


def test_words_of_any_script(spark):
    df = spark.createDataFrame([(1, "Qualität prüfen"), (2, "日本語 テキスト"), (3, None), (4, "it's A-1")], "id long, t string")
    got = {r.id: (r.n_tokens, r.n_terms) for r in vectors.text_tokens(df, "id", "t").collect()}
    assert got == {1: (2, 2), 2: (2, 2), 3: (0, 0), 4: (4, 4)}
    unit = {r.id: np.linalg.norm(r.features.toArray()) for r in vectors.text_vectors(df, "id", "t").collect()}
    assert abs(unit[1] - 1) < 1e-9 and abs(unit[2] - 1) < 1e-9


def test_nodes_keep_without_vector(spark):
    nodes = spark.createDataFrame([(1,), (2,)], "k long")
    vecs = spark.createDataFrame([(1, [1.0])], "id long, v array<double>")
    assert {r.k: r.v for r in vectors.attach_vectors(nodes, "k", vecs, "id").collect()} == {1: [1.0], 2: None}
