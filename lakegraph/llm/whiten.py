"""Whitening by Golub-Kahan-Lanczos bidiagonalisation.

A is the matrix of centred rows. From a unit vector v the steps alternate two
distributed products, u = A v and A'u, each without its part along all earlier
vectors (full reorthogonalisation), which gives orthonormal U and V with
A V = U B for a small upper bidiagonal B. Its singular value decomposition, of at
most the vectors' dimension, yields components (V times its right singular vectors)
and deviations (singular values over the root of the number of rows).

Rows are written once as blocks of 64-bit integers, the fixed-point form of the
vectors. Left vectors have as many entries as there are rows and are never
stored: u_k = A y_k for a short vector y_k that follows from the same recurrence,
so a task makes the entries it needs from its own rows, and one pass over the
blocks gives both products of a step: the left vector's entries, A'u, and U'u for a
second orthogonalisation. A task sends sums of at most a few thousand numbers;
of more than ``_SLOTS`` tasks they are added up by slot first.

Defined cases: rows whose vector is null, of another length than most vectors
have, or holds null or non-finite entries, or entries beyond 2^40, are dropped;
repeated rows count each time and null ids are kept; an empty table gives no rows.
Directions without variance (deviation below 1e-10 of the largest) are no
components, so equal rows or a single one give no rows. A deviation that does not
fit a long is null. Kept columns are the id only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lakegraph.llm import store

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
LARGEST = float(2 ** 40)
FLAT = 1e-10                            # deviations below this share of the largest are none
_BLOCK_ROWS, _SLOTS = 4096, 64


@dataclass
class Rows:
    """Vectors in fixed-point form, written in blocks (ids, x: row-major int64)."""
    blocks: DataFrame
    dim: int
    n: int
    sums: np.ndarray                    # per dimension, exact
    tasks: int                          # of a pass over the blocks

    @property
    def mean(self) -> np.ndarray:
        return self.sums / max(self.n, 1)


@dataclass
class Whitening:
    """Components (rows, by falling eigenvalue), eigenvalues of the covariance
    and its trace."""
    components: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def scale(self) -> np.ndarray:
        """Centred rows times this are whitened."""
        return self.components.T / np.sqrt(self.values)


def _matrix(x: pa.Scalar, dim: int) -> np.ndarray:
    return np.frombuffer(x.as_py(), dtype=np.int64).reshape(-1, dim)


def fixed_point(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> Rows:
    """The usable rows as x = floor(SCALE * c) + SHIFT."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).filter(
        F.col("v").isNotNull() & ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > F.lit(LARGEST))))
    common = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = common.dim if common else 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, _BLOCK_ROWS):
                part = b.slice(lo, _BLOCK_ROWS)
                c = part["v"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
                x = np.floor(SCALE * c).astype(np.int64) + SHIFT
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part["id"])
                yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes()], pa.binary())], names=["ids", "x"])
        store.release()

    kind = rows.schema["id"].dataType.simpleString()
    blocks = store.saved(rows.filter(F.size("v") == dim).mapInArrow(pack, f"ids array<{kind}>, x binary"), "fixed-point")
    found = Rows(blocks, dim, 0, np.zeros(dim, dtype=np.int64), blocks.select(F.spark_partition_id().alias("p")).distinct().count())
    total = _summed(found, lambda x: np.append(x.sum(axis=0), len(x)))
    if total is not None:
        found.n, found.sums = int(total[-1]), total[:-1]
    return found


def _summed(data: Rows, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """Sum over all blocks of an array of one shape and kind; None without any.
    More tasks than slots are added up by slot first."""
    dim = data.dim

    def added(arrays: Iterator[np.ndarray], slot: int) -> pa.RecordBatch | None:
        total = None
        for x in arrays:
            total = x if total is None else total + x
        return None if total is None else pa.RecordBatch.from_pydict({"slot": [slot], "kind": [total.dtype.str], "total": [total.tobytes()]})

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = added((of(_matrix(x, dim)) for b in batches for x in b["x"]), TaskContext.get().partitionId() % _SLOTS)
        if made is not None:
            yield made

    def add(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches([added((np.frombuffer(x.as_py(), dtype=k.as_py()) for k, x in zip(group["kind"], group["total"], strict=True)),
                                            group["slot"][0].as_py())])

    schema = "slot long, kind string, total binary"
    made = data.blocks.select("x").mapInArrow(part, schema)
    if data.tasks > _SLOTS:
        made = made.groupBy("slot").applyInArrow(add, schema)
    parts = [np.frombuffer(bytes(r.total), dtype=r.kind) for r in made.collect()]
    return sum(parts[1:], parts[0]) if parts else None


def _apart(w: np.ndarray, v: np.ndarray) -> np.ndarray:
    """w without its part along the columns of v (twice, to full precision)."""
    for _ in range(2):
        w = w - v @ (v.T @ w)
    return w


def _fresh(v: np.ndarray, turn: int) -> np.ndarray:
    """A unit vector across all columns of v."""
    w = _apart(np.random.default_rng(turn).normal(size=len(v)), v)
    return w / np.linalg.norm(w)


def bidiagonal(rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """(V, B) with A V = U B, V square: as many steps as there are dimensions.
    Where a new vector vanishes the bidiagonal gets a zero, and the steps go on
    from another direction, so equal singular values are all found."""
    dim, mean = rows.dim, rows.mean
    v, y, at_u = (np.zeros((dim, dim)) for _ in range(3))
    b = np.zeros((dim, dim))
    size = 0.0
    v[:, 0] = _fresh(v[:, :0], 0)
    for k in range(dim):
        t = v[:, k] - (b[k - 1, k] * y[:, k - 1] if k else 0.0)
        earlier = y[:, :k]

        t = t - earlier @ (at_u[:, :k].T @ t)           # U'(A t), from the products known so far

        def product(x: np.ndarray, t=t, earlier=earlier) -> np.ndarray:
            """A'u, U'u and u'u of a block, for u = A t."""
            a = x - mean
            u = a @ t
            return np.concatenate([a.T @ u, (a @ earlier).T @ u, [u @ u]])

        got = _summed(rows, product)
        back, rest, square = got[:dim], got[dim:-1], got[-1]
        t, back = t - earlier @ rest, back - at_u[:, :k] @ rest
        length = np.sqrt(max(square - rest @ rest, 0.0))
        size = max(size, length)
        if length > FLAT * size:
            b[k, k], y[:, k], at_u[:, k] = length, t / length, back / length
        w = _apart(at_u[:, k] - b[k, k] * v[:, k], v[:, :k + 1])
        if k + 1 < dim:
            step = np.linalg.norm(w)
            if b[k, k] and step > FLAT * size:
                b[k, k + 1], v[:, k + 1] = step, w / step
            else:
                v[:, k + 1] = _fresh(v[:, :k + 1], k + 1)
    return v, b


def fit(rows: Rows, components: int = COMPONENTS) -> Whitening:
    """The leading components with variance."""
    if not rows.n or not rows.dim:
        return Whitening(np.zeros((0, rows.dim)), np.zeros(0), 0.0)
    mean = rows.mean
    trace = float(_summed(rows, lambda x: ((x - mean) ** 2).sum(axis=0)).sum()) / rows.n
    v, b = bidiagonal(rows)
    _, size, right = np.linalg.svd(b)
    keep = min(components, int((size > FLAT * size[0]).sum()) if size[0] > 0 else 0)
    return Whitening((v @ right[:keep].T).T, size[:keep] ** 2 / rows.n, trace)


def identity_error(rows: Rows, found: Whitening) -> float:
    """Largest entry of |covariance of the whitened rows - identity|."""
    k = len(found.values)
    if not k:
        return 0.0
    mean, scale = rows.mean, found.scale
    centre = _summed(rows, lambda x: ((x - mean) @ scale).sum(axis=0)) / rows.n

    def products(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ scale - centre
        return (w.T @ w).ravel()

    cov = _summed(rows, products).reshape(k, k) / rows.n
    return float(np.abs(cov - np.eye(k)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of
    every usable row and component; deviation is the exact squared distance of
    n x from the sums."""
    rows = fixed_point(vectors, id_col, vec_col)
    found = fit(rows, components)
    error = identity_error(rows, found)
    k, dim, n, sums, mean, scale = len(found.values), rows.dim, rows.n, rows.sums, rows.mean, found.scale
    explained = found.values / found.trace if k else found.values
    out = StructType([StructField(id_col, vectors.schema[id_col].dataType), *StructType.fromDDL(
        "component int, n long, deviation long, whitened double, explained double, identity_error double").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, raw in zip(b["ids"], b["x"], strict=True):
                x = _matrix(raw, dim)
                scores = (x - mean) @ scale
                fits = (n * (x - mean)).astype(np.float64)
                fits = (fits ** 2).sum(axis=1) < 2.0 ** 62
                apart = n * x - sums                    # wraps, but what fits is small
                deviation = pa.array((apart * apart).sum(axis=1), mask=~fits)
                m = len(x) * k
                yield pa.RecordBatch.from_arrays(
                    [ids.values.take(pa.array(np.repeat(np.arange(len(x)), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(m, n, dtype=np.int64)), deviation.take(pa.array(np.repeat(np.arange(len(x)), k))),
                     pa.array(scores.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(m, error))], names=out.names)
        store.release()

    return rows.blocks.mapInArrow(run, out)
