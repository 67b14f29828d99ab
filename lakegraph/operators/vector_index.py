"""A stored index over a vector column: cells, compact codes, exact pruning.

``build`` learns cell centres and code books (both by Lloyd steps over all rows,
one pass per step), writes every valid vector once, partitioned by its nearest
centre, with a code of a few bytes, and keeps each cell's size and radius.
``append`` gives further vectors their cells and codes without learning again.

``search_codes`` is approximate: a query reads the codes of its nearest cells
only, scores them by table look-up, and re-ranks the best few with their whole
vectors. ``search_exact`` gives the rows of ``vectors.knn_exact``: the query's own
cells set its k-th score, and only cells that can still beat it (distance to the
centre less the radius) are read in a second round.

Both meet queries and vectors in blocks of bounded size (``BLOCK`` vectors times
``QUERIES`` queries of a cell), so neither a hot cell nor many queries of one cell
lands in one task; the probed cells, at most as many as there are centres,
reach the scan as a partition filter. Vectors that are null, of another length or
without a norm are not indexed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegraph.operators.vectors import DIGITS, _best, _hit_schema, _ranked, _unit, _valid
from lakegraph.session import shared_dir

CELLS, PARTS, CODES, STEPS = 64, 16, 64, 6
BLOCK, QUERIES = 65_536, 4096
_SLACK = 1e-9                           # covers rounding of cell radii and bounds


@dataclass
class VectorIndex:
    """``path`` holds vectors/ (by cell) and cells/; the model is small: centres
    (cells x dim) and books (parts x codes x dim / parts)."""
    spark: SparkSession
    path: str
    id_col: str
    dim: int
    centres: np.ndarray
    books: np.ndarray
    id_type: T.DataType

    @property
    def vectors(self) -> DataFrame:
        schema = T.StructType([T.StructField("id", self.id_type), *T.StructType.fromDDL(
            "v array<double>, code binary, away double, cell int").fields])
        return self.spark.read.schema(schema).parquet(f"{self.path}/vectors")

    @property
    def cells(self) -> DataFrame:
        """(cell, n, radius) of the cells that hold vectors."""
        rows = self.spark.read.schema("cell int, n long, radius double").parquet(f"{self.path}/cells")
        return rows.groupBy("cell").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"))


def _lloyd(units: DataFrame, dim: int, parts: int, codes: int, steps: int, seed: int) -> np.ndarray:
    """Code books (parts x codes x dim / parts) by Lloyd steps; each step is one
    pass that sends every part's sums and counts. A code without vectors keeps its
    place. Starts from the vectors with the smallest hashes."""
    width = dim // parts
    first = units.select("v", F.xxhash64("id", "v", F.lit(seed)).alias("h")).orderBy("h").limit(codes).collect()
    start = np.array([r.v for r in first], dtype=np.float64).reshape(-1, dim)
    books = np.zeros((parts, codes, width))
    for j in range(parts):
        books[j] = np.resize(start[:, j * width:(j + 1) * width], (codes, width)) if len(start) else 0.0
    for _ in range(steps):

        def sums(batches: Iterator[pa.RecordBatch], books=books) -> Iterator[pa.RecordBatch]:
            total = np.zeros((parts, codes, width + 1))
            for b in batches:
                x = b["v"].flatten().to_numpy(zero_copy_only=False).reshape(-1, parts, width)
                near = _codes(x, books)
                for j in range(parts):
                    total[j, :, width] += np.bincount(near[:, j], minlength=codes)
                    for c in range(width):
                        total[j, :, c] += np.bincount(near[:, j], weights=x[:, j, c], minlength=codes)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(parts)), pa.array([t.tobytes() for t in total], pa.binary())], names=["part", "total"])

        def add(group: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(t.as_py()) for t in group["total"])
            return pa.table({"part": [group["part"][0].as_py()], "total": pa.array([total.tobytes()], pa.binary())})

        found = units.select("v").mapInArrow(sums, "part long, total binary").groupBy("part").applyInArrow(add, "part long, total binary").collect()
        books = books.copy()
        for r in found:                                 # one row per part
            t = np.frombuffer(bytes(r.total)).reshape(codes, width + 1)
            some = t[:, width] > 0
            books[r.part][some] = t[some, :width] / t[some, width:]
    return books


def _codes(x: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Nearest code of each part (rows x parts)."""
    return np.stack([((books[j] ** 2).sum(axis=1) - 2 * x[:, j] @ books[j].T).argmin(axis=1) for j in range(len(books))], axis=1)


def _units(vectors: DataFrame, id_col: str, vec_col: str, dim: int) -> DataFrame:
    """(id, v): valid vectors at unit length."""
    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u = _unit(b["v"], dim)
            yield pa.RecordBatch.from_arrays([b["id"], pa.ListArray.from_arrays(pa.array(np.arange(len(u) + 1) * dim, pa.int32()), pa.array(u.ravel()))],
                                             names=["id", "v"])

    rows = vectors.filter(_valid(vec_col, dim)).select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    return rows.mapInArrow(unit, T.StructType([rows.schema["id"], T.StructField("v", T.ArrayType(T.DoubleType()))]))


def _place(index: VectorIndex, units: DataFrame) -> DataFrame:
    """(id, v, code, cell, away): code bytes, nearest centre and angle to it."""
    centres, books, parts = index.centres, index.books, len(index.books)
    norms = np.linalg.norm(centres, axis=1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b["v"].flatten().to_numpy(zero_copy_only=False).reshape(-1, index_dim)
            cell = ((centres ** 2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1).astype(np.int32)
            cos = np.einsum("ij,ij->i", x, centres[cell]) / np.maximum(norms[cell], 1e-300)
            code = _codes(x.reshape(len(x), parts, -1), books).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(cell),
                                              pa.array(np.arccos(np.clip(cos, -1, 1)))], names=["id", "v", "code", "cell", "away"])

    index_dim = index.dim
    return units.mapInArrow(place, T.StructType([*units.schema.fields, *T.StructType.fromDDL("code binary, cell int, away double").fields]))


def _write(index: VectorIndex, units: DataFrame) -> None:
    """Adds vectors and the sizes and radii of their cells. The cells follow
    the written files, so a failed write leaves no size without its vectors."""
    batch = shared_dir(index.spark, "index-batch")
    _place(index, units).write.parquet(batch)
    placed = index.spark.read.parquet(batch)
    placed.hint("rebalance", "cell").write.mode("append").partitionBy("cell").parquet(f"{index.path}/vectors")
    placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).coalesce(1).write.mode("append").parquet(f"{index.path}/cells")


def build(vectors: DataFrame, id_col: str, vec_col: str, dim: int, path: str | None = None, cells: int = CELLS,
          parts: int = PARTS, codes: int = CODES, steps: int = STEPS, seed: int = 17) -> VectorIndex:
    """Learn cells and code books from all vectors and store them all.
    ``parts`` divides ``dim``; a code takes one byte per part (codes <= 256)."""
    if dim % parts or not 0 < codes <= 256:
        raise ValueError("parts must divide dim, and codes be 1 to 256")
    spark = vectors.sparkSession
    units = _units(vectors, id_col, vec_col, dim)
    units.write.parquet(kept := shared_dir(spark, "index-units"))
    units = spark.read.schema(units.schema).parquet(kept)
    centres = _lloyd(units, dim, 1, cells, steps, seed)[0]
    books = _lloyd(units, dim, parts, codes, steps, seed)
    index = VectorIndex(spark, path or shared_dir(spark, "vector-index"), id_col, dim, centres, books, vectors.schema[id_col].dataType)
    _write(index, units)
    return index


def append(index: VectorIndex, vectors: DataFrame, vec_col: str) -> None:
    """Index further vectors with the cells and codes learned before."""
    _write(index, _units(vectors, index.id_col, vec_col, index.dim))


def _cell_order(index: VectorIndex, queries: DataFrame, qid_col: str, qvec_col: str) -> DataFrame:
    """(query_id, q, cell, i, away, n, radius, before): a query's cells by
    distance, with the vectors that nearer cells hold."""
    stats = index.cells.collect()                       # at most one row per centre
    cell = np.array([r.cell for r in stats], dtype=np.int32)
    centres = index.centres[cell] if len(cell) else np.zeros((0, index.dim))
    norms = np.maximum(np.linalg.norm(centres, axis=1), 1e-300)
    size = np.array([r.n for r in stats], dtype=np.int64)
    radius = np.array([r.radius for r in stats])
    dim, k = index.dim, len(cell)

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _unit(b["q"], dim)
            away = np.arccos(np.clip(x @ centres.T / norms, -1, 1))
            near = np.argsort(away, axis=1, kind="stable")
            held = size[near]
            row = np.repeat(np.arange(len(x)), k)
            flat = near.ravel()
            yield pa.RecordBatch.from_arrays(
                [b["query_id"].take(pa.array(row)), b["q"].take(pa.array(row)), pa.array(cell[flat]), pa.array(np.tile(np.arange(k, dtype=np.int32), len(x))),
                 pa.array(np.take_along_axis(away, near, axis=1).ravel()), pa.array(size[flat]), pa.array(radius[flat]),
                 pa.array((np.cumsum(held, axis=1) - held).ravel())], names=["query_id", "q", "cell", "i", "away", "n", "radius", "before"])

    q = queries.filter(_valid(qvec_col, dim)).select(F.col(qid_col).alias("query_id"), F.col(qvec_col).cast("array<double>").alias("q"))
    schema = T.StructType([*q.schema.fields, *T.StructType.fromDDL("cell int, i int, away double, n long, radius double, before long").fields])
    return q.mapInArrow(order, schema)


def _met(index: VectorIndex, asked: DataFrame, columns: list[str], score: Callable, schema: T.StructType) -> DataFrame:
    """``score(vectors, queries)`` over blocks of the asked (query_id, q, cell)
    rows and the named columns of their cells' vectors."""
    load = asked.groupBy("cell").agg(F.count(F.lit(1)).alias("asked"), F.max("n").alias("n")).collect()     # at most one row per centre
    rows = [(r.cell, int(-(-r.n // BLOCK)), int(-(-r.asked // QUERIES))) for r in load]
    blocks = index.spark.createDataFrame(rows, "cell int, parts int, qparts int")
    v = index.vectors.filter(F.col("cell").isin([r[0] for r in rows])).select("cell", *columns).join(blocks, "cell")
    v = v.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")) \
        .withColumn("qpart", F.explode(F.sequence(F.lit(0), F.col("qparts") - 1))).drop("parts", "qparts")
    q = asked.select("query_id", "q", "cell").join(blocks, "cell") \
        .withColumn("qpart", F.pmod(F.xxhash64("query_id"), F.col("qparts")).cast("int")) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "qparts")
    keys = ["cell", "part", "qpart"]
    return v.groupBy(*keys).cogroup(q.groupBy(*keys)).applyInArrow(score, schema)


def _top(ids: pa.Array, qids: pa.Array, scores: Iterator[tuple[int, np.ndarray]], k: int, schema: T.StructType) -> pa.Table:
    """The k best rows of each query: scores gives (first query, block)."""
    order = np.argsort(np.argsort(ids.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
    rows, qrows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for lo, s in scores:
        for j in range(len(s)):
            best = _best(s[j], order, k)
            rows.append(best)
            qrows.append(np.full(len(best), lo + j))
            found.append(s[j][best])
    return pa.table([qids.take(pa.array(np.concatenate(qrows))), ids.take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(found))],
                    names=schema.names)


def candidates(index: VectorIndex, queries: DataFrame, qid_col: str, qvec_col: str, probe: int, keep: int) -> DataFrame:
    """(query_id, id, score): the ``keep`` vectors with the best code scores
    of each query's ``probe`` nearest cells, and further cells while those hold fewer."""
    books, dim = index.books, index.dim
    asked = _cell_order(index, queries, qid_col, qvec_col).filter((F.col("i") < probe) | (F.col("before") < keep))
    schema = T.StructType([T.StructField("query_id", queries.schema[qid_col].dataType), T.StructField("id", index.id_type),
                           T.StructField("score", T.DoubleType())])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, qids = left["id"].combine_chunks(), right["query_id"].combine_chunks()

        def blocks() -> Iterator[tuple[int, np.ndarray]]:
            if not len(ids) or not len(qids):
                return
            code = np.frombuffer(b"".join(left["code"].to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
            q = _unit(right["q"], dim).reshape(len(qids), len(books), -1)
            table = np.einsum("qpw,pcw->qpc", q, books)         # of every query, part and code
            for lo in range(0, len(q), 64):
                s = np.zeros((min(64, len(q) - lo), len(ids)))
                for p in range(len(books)):
                    s += table[lo:lo + 64, p][:, code[:, p]]
                yield lo, s

        return _top(ids, qids, blocks(), keep, schema)

    found = _met(index, asked, ["id", "code"], score, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= keep).drop("place")


def _exact(pairs: DataFrame, dim: int, schema: T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                s = np.round(np.einsum("ij,ij->i", _unit(b["v"], dim), _unit(b["q"], dim)), DIGITS)
                yield pa.RecordBatch.from_arrays([b["query_id"], b["id"], pa.array(s)], names=schema.names)

    return pairs.select("query_id", "id", "v", "q").mapInArrow(run, schema)


def search_codes(index: VectorIndex, queries: DataFrame, qid_col: str, qvec_col: str, k: int, probe: int, rerank: int) -> DataFrame:
    """Approximate top-k (query_id, id, score, rank): ``rerank`` candidates of
    each query are compared at full precision."""
    schema = _hit_schema(index.vectors.select(F.col("id").alias(index.id_col)), index.id_col, queries, qid_col)
    found = candidates(index, queries, qid_col, qvec_col, probe, max(k, rerank))
    q = queries.filter(_valid(qvec_col, index.dim)).select(F.col(qid_col).alias("query_id"), F.col(qvec_col).cast("array<double>").alias("q"))
    pairs = found.select("query_id", "id").join(index.vectors.select("id", "v"), "id").join(q, "query_id")
    return _ranked(_exact(pairs, index.dim, schema), index.id_col, k)


def search_exact(index: VectorIndex, queries: DataFrame, qid_col: str, qvec_col: str, k: int) -> tuple[DataFrame, DataFrame]:
    """Exact top-k (query_id, id, score, rank), and (query_id, cell, n, round):
    the cells that were compared."""
    dim = index.dim
    schema = _hit_schema(index.vectors.select(F.col("id").alias(index.id_col)), index.id_col, queries, qid_col)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, qids = left["id"].combine_chunks(), right["query_id"].combine_chunks()

        def blocks() -> Iterator[tuple[int, np.ndarray]]:
            if len(ids) and len(qids):
                a, b = _unit(left["v"], dim), _unit(right["q"], dim)
                for lo in range(0, len(b), 64):
                    yield lo, np.round(b[lo:lo + 64] @ a.T, DIGITS)

        return _top(ids, qids, blocks(), k, schema)

    spark = index.spark
    _cell_order(index, queries, qid_col, qvec_col).write.parquet(kept := shared_dir(spark, "index-queries"))
    order = spark.read.parquet(kept)
    near = order.filter((F.col("i") < 1) | (F.col("before") < k))
    _met(index, near, ["id", "v"], score, schema).write.parquet(first := shared_dir(spark, "index-first"))
    hits = spark.read.parquet(first)
    kth = _ranked(hits, index.id_col, k).filter(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    # no vector of a cell is nearer than its centre less the radius; without k rows every cell is read
    bound = F.cos(F.greatest(F.col("away") - F.col("radius") - F.lit(_SLACK), F.lit(0.0))) + F.lit(_SLACK)
    further = order.filter(~((F.col("i") < 1) | (F.col("before") < k))).join(kth, "query_id", "left") \
        .filter(F.col("kth").isNull() | (bound >= F.col("kth")))
    further.select(order.columns).write.parquet(second := shared_dir(spark, "index-further"))
    further = spark.read.schema(order.schema).parquet(second)
    all_hits = hits.unionByName(_met(index, further, ["id", "v"], score, schema))
    read = near.select("query_id", "cell", "n", F.lit(1).alias("round")).unionByName(further.select("query_id", "cell", "n", F.lit(2).alias("round")))
    return _ranked(all_hits, index.id_col, k), read
