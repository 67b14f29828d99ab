"""Whitening against NumPy's eigenvectors and exact sums."""

import math

import numpy as np
import pytest

from lakegraph.llm import queries, whiten

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, n string, component string"


def check(spark, rows, usable, components=32):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)
    got = whiten.whiten(df, components=components).toPandas()
    ids = [rows[i][0] for i in usable]
    x = [[math.floor(64 * c) + 1_000_000 for c in rows[i][1]] for i in usable]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    a = np.array(x, dtype=np.float64) - np.array(sums) / n
    e, q = np.linalg.eigh(a.T @ a / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, int((np.sqrt(np.maximum(e, 0)) > 1e-6 * math.sqrt(e[0])).sum()))
    assert len(got) == n * k and sorted(set(got.component)) == list(range(1, k + 1))
    w = a @ q[:, :k] / np.sqrt(e[:k])
    mine = got.set_index(["vec_id", "component"]).whitened.unstack().loc[ids].to_numpy()
    return got, ids, x, n, sums, e, w, mine, k


def signed(mine, w):
    return mine * np.sign((mine * w).sum(axis=0))


@pytest.mark.parametrize(("n", "dim"), [(40, 6), (9, 20), (2000, 40)])
def test_components(spark, n, dim):
    rng = np.random.default_rng(n)
    v = rng.normal(size=(n, dim)) * np.linspace(1, 3, dim)
    rows = [(7 * i, x.tolist()) for i, x in enumerate(v)]
    got, ids, x, n, sums, e, w, mine, k = check(spark, rows, range(n))
    assert k == min(32, dim, n - 1)
    assert np.abs(signed(mine, w) - w).max() < 1e-6
    assert (got.n == n).all() and got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9
    deviation = {i: sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for i, row in zip(ids, x, strict=True)}
    assert (got.deviation == got.vec_id.map(deviation)).all()
    explained = got.groupby("component").explained.first().to_numpy()
    assert np.allclose(explained, e[:k] / e.sum(), rtol=1e-9)


def test_equal_eigenvalues(spark):
    """A scatter with the same variance along several axes: all are found."""
    rows = [(2 * i + s, [float(10 * (2 * s - 1)) if j == i else 0.0 for j in range(8)]) for i in range(8) for s in range(2)]
    got, *_, mine, k = check(spark, rows, range(16))
    assert k == 8 and got.identity_error.max() < 1e-12 and np.abs(mine.T @ mine / 16 - np.eye(8)).max() < 1e-12


def test_dropped_rows_and_large_entries(spark):
    rng = np.random.default_rng(2)
    good = [(i, (rng.normal(size=5) * 4).tolist()) for i in range(30)]
    bad = [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [float("nan")] * 5), (103, [float("inf")] + [0.0] * 4), (104, [1.0, 2.0]),
           (105, [1e300] * 5), (106, [])]
    got, ids, x, n, sums, e, w, mine, k = check(spark, good + bad, range(30))
    assert set(got.vec_id) == set(range(30)) and np.abs(signed(mine, w) - w).max() < 1e-9
    far = spark.createDataFrame([*good, (50, [2.0 ** 39] * 5)], "vec_id long, embedding array<double>")
    rows = {r.vec_id: r.deviation for r in whiten.whiten(far).collect()}
    assert rows[50] is None                                                    # does not fit a long


def test_repeated_rows_and_no_variance(spark):
    schema = "vec_id long, embedding array<double>"
    same = spark.createDataFrame([(None, [1.0, 2.0])] * 5, schema)
    assert whiten.whiten(same).count() == 0 and whiten.whiten(same.limit(0)).count() == 0 and whiten.whiten(same.limit(1)).count() == 0
    twice = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [0.0, 4.0]), (2, [3.0, 3.0])], schema)
    rows = whiten.whiten(twice).collect()
    assert len(rows) == 8 and sum(r.vec_id is None for r in rows) == 2 and {r.n for r in rows} == {4}


def test_query(spark):
    got = queries.op13_whitening(spark, SF).toPandas()
    v = queries.read(spark, SF, "embeddings").toPandas()
    x = np.floor(64 * np.array(v.embedding.tolist()).astype(np.float64)).astype(np.int64) + 1_000_000
    a = x - x.mean(axis=0)
    e, q = np.linalg.eigh(a.T @ a / len(x))
    w = a @ q[:, ::-1][:, :32] / np.sqrt(e[::-1][:32])
    mine = got.set_index(["vec_id", "component"]).whitened.unstack().loc[v.vec_id].to_numpy()
    assert np.abs(signed(mine, w) - w).max() < 1e-6 and got.identity_error.max() < 1e-9


def test_sums_by_slot(spark, monkeypatch):
    """More tasks than slots are added up before the driver."""
    df = queries.read(spark, SF, "embeddings").repartition(9)
    rows = whiten.fixed_point(df)
    rows.tasks = whiten._SLOTS + 1
    assert whiten._summed(rows, lambda x: np.array([len(x)])).tolist() == [rows.n]
