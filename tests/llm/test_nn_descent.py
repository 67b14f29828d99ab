"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest

from lakegraph.llm import nn_descent


def brute(rows, threshold=nn_descent.THRESHOLD):
    """{row: (links, component)} by all pairs; rows are (id, vector, label)."""
    usable = {}
    for i, (_, v, label) in enumerate(rows):
        if v is not None and label is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v):
            x = np.array(v, dtype=np.float64)
            usable[i] = x / np.linalg.norm(x)
    near = {i: set() for i in range(len(rows))}
    keys = sorted(usable)
    for a in keys:
        for b in keys:
            if a < b and rows[a][2] == rows[b][2] and len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= threshold:
                near[a].add(b)
                near[b].add(a)
    out = {}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            todo += (new := near[todo.pop()] - seen)
            seen |= new
        ids = [rows[x][0] for x in seen if rows[x][0] is not None]
        out[i] = (len(near[i]), min(ids, default=None))
    return out


def check(spark, rows, **more):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<float>, label int, g string, v int").repartition(3)
    got = nn_descent.near_duplicates(df, **more).collect()
    key = lambda x: tuple(-1 if c is None else c for c in x)
    want = brute(rows)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key) == \
        sorted(((rows[i][0], n, c) for i, (n, c) in want.items()), key=key)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert {r.audit_recall for r in got} == {1.0}


def test_hard_rows(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16)).astype(np.float32)
    rows = [(i, x.tolist(), i % 3) for i, x in enumerate(base)]
    rows += [(100 + i, (base[i] + 0.02 * rng.normal(size=16)).astype(np.float32).tolist(), i % 3) for i in range(0, 60, 2)]
    rows += [(200 + i, base[i].tolist(), (i + 1) % 3) for i in range(9)]        # equal vectors of another label
    rows += [(300, base[0].tolist(), 0), (301, (2 * base[0]).tolist(), 0), (301, (2 * base[0]).tolist(), 0), (0, base[0].tolist(), 0)]
    rows += [(None, base[1].tolist(), 1), (None, rng.normal(size=16).tolist(), 1), (None, base[5].tolist(), 2)]
    rows += [(400, None, 0), (401, [0.0] * 16, 0), (402, [0.0] * 16, 0), (403, [float("nan")] * 16, 0), (404, base[0].tolist(), None),
             (405, [None] + base[0].tolist()[1:], 0), (406, [float("inf")] * 16, 0), (407, [], 0), (408, base[0].tolist()[:8], 0),
             (409, base[0].tolist()[:8], 0), (410, [1e30] * 16, 0), (411, [1e-30] * 16, 0)]
    check(spark, [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v], g) for i, v, g in rows])


@pytest.mark.parametrize("tile", [64, 2048])
def test_saturated_lists_and_chains(spark, tile):
    """Groups larger than any list, next to a chain of links and a random rest;
    one label holds most rows."""
    rng = np.random.default_rng(8)
    rows, centre = [], rng.normal(size=(3, 24))
    for g, size in enumerate((150, 70, 40)):
        rows += [(centre[g] + 0.08 * np.linalg.norm(centre[g]) / 5 * rng.normal(size=24), 0) for _ in range(size)]
    a, b = np.linalg.qr(rng.normal(size=(24, 2)))[0].T
    rows += [(np.cos(t) * a + np.sin(t) * b, 1) for t in np.arange(0, 3, 0.3)]   # neighbours link, others do not
    rows += [(rng.normal(size=24), int(rng.integers(0, 2))) for _ in range(500)]
    rows += rows[:20]                                                           # exact copies
    order = rng.permutation(len(rows))
    check(spark, [(int(order[i]), [float(np.float32(c)) for c in v], g) for i, (v, g) in enumerate(rows)], tile=tile)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert nn_descent.near_duplicates(df).collect() == []


def test_recall_on_planted_pairs(spark):
    """Single near copies in a random rest, where nothing else is near."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 32))
    x[2000:2400] = x[:400] + 0.25 * rng.normal(size=(400, 32))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = ((u @ u.T) >= nn_descent.THRESHOLD).sum() - len(u)
    got = nn_descent.near_duplicates(df).toPandas()
    assert want >= 600 and got.n_links.sum() <= want and got.n_links.sum() >= 0.99 * want
