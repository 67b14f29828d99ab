"""Vector columns, their audit, and nearest-neighbour search.

Exact top-k (``knn_exact``) deals the vectors over cells, gives every cell all
queries, and multiplies the two blocks of each cell with NumPy; a cell sends k
rows per query to the ranking, never a score matrix.

Approximate top-k (``knn_cells``) clusters the vectors (Spark ML k-means over
the whole table) and compares a query only with the vectors of its nearest
clusters.

Both take the declared dimension; vectors of another length, null or of zero
norm take no part (``vector_audit`` reports them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegraph.functions.exprs import norm
from lakegraph.session import shared_dir

DIGITS = 12          # scores are rounded before ranking, so equal vectors tie


def attach_vectors(nodes: DataFrame, node_key: str, vectors: DataFrame, vec_key: str,
                   how: str = "left") -> DataFrame:
    """Set a vector property on nodes: one join by id (not one call per row).
    A node without a vector stays, with nulls."""
    return nodes.join(vectors.withColumnRenamed(vec_key, node_key), node_key, how)


def vector_audit(df: DataFrame, vec_col: str, dim: int) -> DataFrame:
    """What a vector index declared with ``dim`` dimensions would reject:
    null vectors, wrong dimension, zero norm; plus rows not of unit norm."""
    v = F.col(vec_col)
    n = norm(v)
    return df.agg(
        F.count(F.lit(1)).alias("n_vectors"),
        F.count_if(v.isNull()).alias("n_null"),
        F.count_if(v.isNotNull() & (F.size(v) != dim)).alias("n_wrong_dim"),
        F.count_if(v.isNotNull() & (n == 0)).alias("n_zero_norm"),
        F.count_if(v.isNotNull() & (F.abs(n - 1.0) > 1e-3)).alias("n_not_unit"),
        F.min(F.size(v)).alias("min_dim"), F.max(F.size(v)).alias("max_dim"))


def centroids(df: DataFrame, group_col: str, vec_col: str, out: str = "centroid") -> DataFrame:
    """Mean vector per group (element-wise), as array<double>.

    Spark ML's ``Summarizer.mean`` is a JVM aggregate with partial merge, so
    a group holding most rows is combined map-side, O(d) per row.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    src = df.filter(F.col(vec_col).isNotNull()).select(group_col, array_to_vector(vec_col).alias("__v"))
    return src.groupBy(group_col).agg(Summarizer.mean(F.col("__v")).alias("__m")) \
              .select(group_col, vector_to_array("__m").alias(out))


# fixed pattern: runs of characters that are no letter and no digit of any script
NOT_WORD = "[^\\p{L}\\p{N}]+"


def text_tokens(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_tokens, n_terms): lower-case words of each text, and distinct ones."""
    tok = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), NOT_WORD), lambda t: t != "")
    return df.select(id_col, F.size(tok).alias("n_tokens"), F.size(F.array_distinct(tok)).alias("n_terms"))


def text_vectors(df: DataFrame, id_col: str, text_col: str, num_features: int = 1 << 18,
                 min_doc_freq: int = 1) -> DataFrame:
    """Text -> unit-norm TF-IDF vectors with Spark ML (whole texts).

    Tokenizer -> HashingTF -> IDF -> Normalizer. Term counts are written once to
    the shared folder, so texts are split once; fitting IDF is one distributed
    pass of document frequencies over them, transform is per row. Words are
    runs of letters and digits of any script.
    """
    from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer

    src = df.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    words = RegexTokenizer(inputCol="__text", outputCol="__tok", pattern=NOT_WORD, toLowercase=True).transform(src)
    counts = HashingTF(inputCol="__tok", outputCol="__tf", numFeatures=num_features).transform(words).select(id_col, "__tf")
    spark = df.sparkSession
    path = shared_dir(spark, "text-vectors")
    counts.write.parquet(path)
    counts = spark.read.parquet(path)
    weighed = IDF(inputCol="__tf", outputCol="__idf", minDocFreq=min_doc_freq).fit(counts).transform(counts)
    return Normalizer(inputCol="__idf", outputCol="features", p=2.0).transform(weighed).select(id_col, "features")


def unit_interval(hits: DataFrame, col: str = "score") -> DataFrame:
    """Rescale cosine scores from [-1, 1] to [0, 1] as ``(1 + cos) / 2`` (the
    scale some vector indexes report); ranks are unchanged."""
    return hits.withColumn(col, (F.lit(1.0) + F.col(col)) / F.lit(2.0))


# ------------------------------------------------------------------ exact kNN

def _valid(c: str, dim: int) -> Column:
    """What an index of this dimension accepts."""
    return F.col(c).isNotNull() & (F.size(c) == dim) & (norm(c) > 0)


def _unit(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of a list column as unit vectors, from its flat value buffer."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    m = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _best(scores: np.ndarray, order_of_id: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k best scores, equal ones by id order."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= kth)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((order_of_id[keep], -scores[keep]))[:k]]


def _ranked(found: DataFrame, id_col: str, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(id_col).asc())
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _hit_schema(vectors: DataFrame, id_col: str, queries: DataFrame, qid_col: str) -> T.StructType:
    return T.StructType([T.StructField("query_id", queries.schema[qid_col].dataType),
                         T.StructField(id_col, vectors.schema[id_col].dataType), T.StructField("score", T.DoubleType())])


def knn_exact(vectors: DataFrame, id_col: str, vec_col: str, queries: DataFrame, qid_col: str,
              qvec_col: str, k: int, dim: int, cells: int | None = None) -> DataFrame:
    """Exact top-k by cosine for every query: (query_id, id, score, rank).

    Scores are raw cosine (see ``unit_interval`` for the [0, 1] scale).
    Ties are broken by the smaller id. Vectors are dealt over ``cells`` cells
    by hash (default: the session's shuffle partitions, which are sized to the
    data), each cell gets all queries: one plan whatever the number of
    queries. A cell holds its share of the vectors and all queries in memory;
    for very many queries use ``knn_cells`` or more cells.
    """
    cells = cells or int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = _hit_schema(vectors, id_col, queries, qid_col)
    names = schema.names
    v = vectors.filter(_valid(vec_col, dim)).select(
        F.col(id_col).alias("__id"), F.col(vec_col).alias("__v"),
        F.pmod(F.xxhash64(id_col, vec_col), F.lit(cells)).cast("int").alias("__cell"))
    q = queries.filter(_valid(qvec_col, dim)).select(
        F.col(qid_col).alias("__qid"), F.col(qvec_col).alias("__q"),
        F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("__cell"))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, qids = left["__id"].combine_chunks(), right["__qid"].combine_chunks()
        rows, qrows, found = [], [], []
        if len(ids) and len(qids):
            a, b = _unit(left["__v"], dim), _unit(right["__q"], dim)
            order = np.argsort(np.argsort(ids.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
            for lo in range(0, len(b), 256):            # bounds the score block
                s = np.round(a @ b[lo:lo + 256].T, DIGITS)
                for j in range(s.shape[1]):
                    best = _best(s[:, j], order, k)
                    rows.append(best)
                    qrows.append(np.full(len(best), lo + j))
                    found.append(s[best, j])
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        return pa.table([qids.take(pa.array(cat(qrows, np.int64))), ids.take(pa.array(cat(rows, np.int64))),
                         pa.array(cat(found, np.float64))], names=names)

    hits = v.groupBy("__cell").cogroup(q.groupBy("__cell")).applyInArrow(score, schema)
    return _ranked(hits, id_col, k)


# ------------------------------------------------------------ clustered kNN

def probes(vectors: DataFrame, id_col: str, vec_col: str, queries: DataFrame, qid_col: str,
           qvec_col: str, k: int, dim: int, n_clusters: int = 400, n_probe: int = 80, seed: int = 17) -> DataFrame:
    """The (query_id, id, vectors) pairs that ``knn_cells`` compares."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import Normalizer
    from pyspark.ml.functions import array_to_vector

    unit = Normalizer(inputCol="__a", outputCol="__u", p=2.0)
    v = unit.transform(vectors.filter(_valid(vec_col, dim)).select(
        id_col, F.col(vec_col).alias("__v"), array_to_vector(vec_col).alias("__a"))).drop("__a")
    model = KMeans(k=n_clusters, featuresCol="__u", predictionCol="__cell", seed=seed, maxIter=10).fit(v)
    centres = np.array(model.clusterCenters())
    placed = model.transform(v).select(id_col, "__v", "__cell")
    sizes = placed.groupBy("__cell").agg(F.count(F.lit(1)).alias("n"))
    # cluster sizes as one array, read inside the plan
    size_of = sizes.agg(F.map_from_entries(F.collect_list(F.struct("__cell", "n")))).scalar()
    q = queries.filter(_valid(qvec_col, dim)).select(F.col(qid_col).alias("query_id"), F.col(qvec_col).alias("__q"))
    qtype = queries.schema[qid_col].dataType

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                near = np.argsort(((_unit(b["__q"], dim)[:, None, :] - centres[None]) ** 2).sum(axis=2), axis=1, kind="stable")
                yield pa.RecordBatch.from_arrays([b["query_id"], b["__q"], pa.array(near.tolist(), pa.list_(pa.int32()))],
                                                 names=["query_id", "__q", "__near"])

    ordered = q.mapInArrow(order, T.StructType([T.StructField("query_id", qtype), q.schema["__q"],
                                                T.StructField("__near", T.ArrayType(T.IntegerType()))]))
    step = ordered.select("query_id", "__q", F.posexplode("__near").alias("i", "__cell")).withColumn(
        "n", F.coalesce(F.try_element_at(size_of, F.col("__cell")), F.lit(0)))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("query_id").orderBy("i")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = step.withColumn("before", before).filter((F.col("i") < n_probe) | (F.col("before") < k)) \
                 .select("query_id", "__q", "__cell")
    return placed.join(chosen, "__cell").select("query_id", id_col, "__v", "__q")


def knn_cells(vectors: DataFrame, id_col: str, vec_col: str, queries: DataFrame, qid_col: str,
              qvec_col: str, k: int, dim: int, n_clusters: int = 400, n_probe: int = 80,
              seed: int = 17) -> DataFrame:
    """Approximate top-k, same rows as ``knn_exact``.

    k-means over all unit vectors makes ``n_clusters`` clusters (a parameter;
    the centres are the only model). Every vector lies in one cluster. A query
    takes its clusters in order of distance: the first ``n_probe``, and further
    ones while those before hold fewer than k vectors, so each query gets k
    rows if there are that many. Ids and vectors meet their queries in one join
    on the cluster, which adaptive execution splits where a cluster is large.
    """
    pairs = probes(vectors, id_col, vec_col, queries, qid_col, qvec_col, k, dim, n_clusters, n_probe, seed)
    schema = _hit_schema(vectors, id_col, queries, qid_col)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                s = np.round(np.einsum("ij,ij->i", _unit(b["__v"], dim), _unit(b["__q"], dim)), DIGITS)
                yield pa.RecordBatch.from_arrays([b["query_id"], b[id_col], pa.array(s)], names=schema.names)

    return _ranked(pairs.mapInArrow(score, schema), id_col, k)
