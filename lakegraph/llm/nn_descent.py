"""Near-duplicate vectors by NN-descent.

Rows whose labels and vectors are equal are one vertex. Every vertex holds a list of its
nearest vertices of the same label, and the lists are refined until they rest:

1. Start: vertices are sorted by the signs of random projections, several times;
   runs of ``LEAF`` vertices of that order are compared among themselves.
2. A round joins every vertex' neighbours, and those whose lists it is in, with
   each other (neighbours of neighbours), where one of two is new to the list.
   Each member passes on its ``BEST`` nearest that would enter its list, and
   every one near enough for a link. Vectors travel in half precision here, and
   ``MARGIN`` covers what that may change.
3. Lists hold the ``K`` nearest. A list that is saturated, its K members all near enough,
   is enlarged up to ``FULL`` members. Where even that is saturated the list becomes the whole
   of what the graph reaches: the vertex' component, compared in tiles of
   bounded size that give counts, not pairs.
4. Pairs of the lists are decided by their cosine in double precision. An audit
   compares a bounded sample of vertices with all of their label; below the wished recall
   the descent goes on from further random orders.

The links of a component are found once it is reached; a link between two parts that both
have only saturated vertices there may be missed, which the audit would show.
Work inside a component with saturated lists grows with the square of its distinct vectors.

Defined cases: null labels, null, empty or zero vectors and vectors with null or
non-finite entries link with nothing; vectors of different length do not link;
equal vectors of one label link (a repeated row too); a null id is larger than any other
and a component of null ids has a null id; an empty table gives no rows. Only the id,
vector and label columns are read, whatever else the table holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakegraph.llm import store
from lakegraph.llm.components import components

THRESHOLD = 0.93
K, FULL, BEST = 8, 32, 2
ORDERS, BITS, LEAF = 4, 48, 256
MARGIN = 0.002                          # more than half precision changes a cosine of unit vectors
REST = 0.02                             # lists rest when fewer of their places are new
ROUNDS, PASSES = 8, 4
AUDIT, RECALL = 1024, 0.995
TILE = 2048
_BUCKET = 4096                          # vertices whose lists are worked together
_FLOATS = 1 << 22


def _rows(column: pa.Array, kind) -> np.ndarray:
    """Equally long binaries as a matrix."""
    raw = np.frombuffer(b"".join(column.to_pylist()), dtype=kind)
    return raw.reshape(len(column), -1)


def _binaries(matrix: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes() for x in matrix], pa.binary())


def vertices(rows: DataFrame) -> DataFrame:
    """(v, g, vec, first, copies, unit, half) of each distinct vector of a label,
    from (id, vec, g): smallest id, rows, unit vector in double and half precision."""
    same = rows.groupBy("g", "vec").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for c in b["vec"]:
                c = c.values.to_numpy(zero_copy_only=False).astype(np.float64)
                c = c / np.abs(c).max()
                made.append(c / np.sqrt(c @ c))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x.tobytes() for x in made], pa.binary()),
                                              pa.array([x.astype(np.float16).tobytes() for x in made], pa.binary())],
                                             names=[*b.schema.names, "unit", "half"])

    schema = StructType([*same.schema.fields, *StructType.fromDDL("unit binary, half binary").fields])
    return store.saved(same.mapInArrow(unit, schema).withColumn("v", F.monotonically_increasing_id()), "vertices")


_ENTRY = "u long, w long, sim float"


def _nearest(s: np.ndarray, low: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of what each row of a similarity matrix puts into its list."""
    take = min(FULL, s.shape[1])
    top = np.argpartition(-s, take - 1, axis=1)[:, :take]
    top = np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, axis=1), axis=1), axis=1)
    got = np.take_along_axis(s, top, axis=1)
    keep = ((np.arange(take) < K) | (got >= low)) & (got > -2)
    row, place = np.nonzero(keep)
    return row, top[row, place]


def _leaves(found: DataFrame, low: float, turn: int) -> DataFrame:
    """List entries from runs of the vertices in random orders."""

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = pc.binary_length(b["half"]).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                part = b.filter(pa.array(sizes == size))
                x = _rows(part["half"], np.float16).astype(np.float32)
                for o in range(ORDERS):
                    planes = np.random.default_rng((turn, o, int(size))).normal(size=(x.shape[1], BITS)).astype(np.float32)
                    code = ((x @ planes) > 0) @ (1 << np.arange(BITS, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), o, dtype=np.int32)), part["g"], pa.array(code), part["v"], part["half"]],
                                                     names=["o", "g", "code", "v", "half"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            g, o, v = b["g"].to_numpy(zero_copy_only=False), b["o"].to_numpy(), b["v"].to_numpy()
            heads = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (o[1:] != o[:-1])]))
            us, ws, sims = [], [], []
            for a, e in zip(heads, np.append(heads[1:], len(v)), strict=True):
                cuts = np.linspace(a, e, -(-(e - a) // LEAF) + 1).astype(int)
                for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                    x = _rows(b["half"].slice(lo, hi - lo), np.float16).astype(np.float32)
                    s = x @ x.T
                    np.fill_diagonal(s, -3)
                    row, col = _nearest(s, low)
                    us.append(v[lo + row])
                    ws.append(v[lo + col])
                    sims.append(s[row, col])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (us, ws, sims)], names=["u", "w", "sim"])

    coded = found.select("g", "v", "half").mapInArrow(codes, "o int, g string, code long, v long, half binary")
    return coded.repartitionByRange("o", "g", "code", "v").sortWithinPartitions("o", "g", "code", "v").mapInArrow(compare, _ENTRY)


_LISTS = "u long, w array<long>, sim array<float>, fresh array<boolean>, least float, full boolean"


def _lists(entries: DataFrame, buckets: int, low: float) -> DataFrame:
    """One row per vertex: its list by falling similarity, which members are
    new, the K-th similarity (-1 before that many), and whether it is saturated
    at full length. entries has u, w, sim, old."""

    def merge(group: pa.Table) -> pa.Table:
        u, w, sim = (group[c].to_numpy() for c in ("u", "w", "sim"))
        old = group["old"].to_numpy()
        order = np.lexsort((~old, w, u))
        u, w, sim, old = u[order], w[order], sim[order], old[order]
        one = np.concatenate([[True], (u[1:] != u[:-1]) | (w[1:] != w[:-1])])
        u, w, sim, old = u[one], w[one], sim[one], old[one]
        order = np.lexsort((w, -sim, u))
        u, w, sim, old = u[order], w[order], sim[order], old[order]
        head = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
        place = np.arange(len(u)) - np.repeat(head, np.diff(np.append(head, len(u))))
        keep = (place < K) | ((place < FULL) & (sim >= low))
        u, w, sim, old, place = u[keep], w[keep], sim[keep], old[keep], place[keep]
        head = np.flatnonzero(place == 0)
        cut = pa.array(np.append(head, len(u)), pa.int32())
        many = np.diff(np.append(head, len(u)))
        least = np.where(many >= K, sim[np.minimum(head + K, len(u)) - 1], -1).astype(np.float32)
        return pa.table([pa.array(u[head]), *(pa.ListArray.from_arrays(cut, pa.array(x)) for x in (w, sim, ~old)), pa.array(least),
                         pa.array((many == FULL) & (sim[head + many - 1] >= low))], names=["u", "w", "sim", "fresh", "least", "full"])

    made = entries.withColumn("bucket", F.pmod(F.xxhash64("u"), F.lit(buckets))).groupBy("bucket").applyInArrow(
        merge, _LISTS)
    return store.saved(made, "neighbours")


def _entries(lists: DataFrame) -> DataFrame:
    return lists.select("u", F.inline(F.arrays_zip("w", "sim", "fresh")))


def _round(found: DataFrame, lists: DataFrame, buckets: int, low: float) -> DataFrame:
    """List entries from the neighbours of neighbours."""
    ahead = _entries(lists).select(F.col("u").alias("p"), F.col("w").alias("m"), "sim", "fresh")
    near = Window.partitionBy("p").orderBy(F.desc("sim"), "m")
    back = ahead.select(F.col("m").alias("p"), F.col("p").alias("m"), "sim", "fresh") \
        .withColumn("place", F.row_number().over(near)).filter(F.col("place") <= K).drop("place")
    members = ahead.unionByName(back).withColumn("some", F.max("fresh").over(Window.partitionBy("p"))).filter("some").drop("some")
    nodes = found.select("v", "half").join(lists.select(F.col("u").alias("v"), "least", "full"), "v")
    members = members.join(nodes.withColumnRenamed("v", "m"), "m")

    def join(group: pa.Table) -> pa.Table:
        p, m, sim = (group[c].to_numpy() for c in ("p", "m", "sim"))
        fresh = group["fresh"].to_numpy()
        order = np.lexsort((~fresh, m, p))
        one = np.concatenate([[True], (p[order][1:] != p[order][:-1]) | (m[order][1:] != m[order][:-1])])
        at = order[one]
        p, m, sim, fresh = p[at], m[at], sim[at], fresh[at]
        least, full = group["least"].to_numpy()[at], group["full"].to_numpy()[at]
        half = group["half"].combine_chunks()
        head = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        many = np.diff(np.append(head, len(p)))
        dims = pc.binary_length(half).to_numpy()[at][head] // 2     # one length in each group
        by_size = np.lexsort((many, dims))
        us, ws, sims = [], [], []
        k = 0
        while k < len(by_size):                         # groups of about one size, as one block
            width, dim = int(many[by_size[k]]), int(dims[by_size[k]])
            some = by_size[k:k + max(1, _FLOATS // (width * (dim + width)))]
            some = some[(many[some] <= width + 4) & (dims[some] == dim)]
            k += len(some)
            width = int(many[some].max())
            if width < 2:
                continue
            grid = head[some][:, None] + np.arange(width)
            inside = np.arange(width) < many[some][:, None]
            grid = np.where(inside, grid, head[some][:, None])
            x = _rows(half.take(pa.array(at[grid].ravel())), np.float16).astype(np.float32).reshape(len(some), width, dim)
            s = x @ x.transpose(0, 2, 1)
            new = fresh[grid] & inside
            allowed = inside[:, :, None] & inside[:, None, :] & (new[:, :, None] | new[:, None, :])
            allowed &= ~np.eye(width, dtype=bool)
            s = np.where(allowed, s, -3)
            linked = sim[grid] >= low
            settled = full[grid] & linked               # one component already, compared in tiles
            emit = (s >= low) & ~(settled[:, :, None] & settled[:, None, :])
            take = min(BEST, width - 1)
            top = np.argpartition(-s, take - 1, axis=2)[:, :, :take]
            best = np.zeros_like(emit)
            np.put_along_axis(best, top, True, axis=2)
            emit |= best & (s > least[grid][:, :, None]) & ~full[grid][:, :, None]
            a, i, j = np.nonzero(emit & (s > -2))
            us.append(m[grid[a, i]])
            ws.append(m[grid[a, j]])
            sims.append(s[a, i, j])
        if not us:
            return pa.table({"u": pa.array([], pa.int64()), "w": pa.array([], pa.int64()), "sim": pa.array([], pa.float32())})
        u, w, s = (np.concatenate(x) for x in (us, ws, sims))
        order = np.lexsort((w, u))
        u, w, s = u[order], w[order], s[order]
        one = np.concatenate([[True], (u[1:] != u[:-1]) | (w[1:] != w[:-1])]) if len(u) else np.zeros(0, bool)
        return pa.table({"u": u[one], "w": w[one], "sim": s[one]})

    return members.withColumn("bucket", F.pmod(F.xxhash64("p"), F.lit(buckets))).groupBy("bucket").applyInArrow(join, _ENTRY)


def descend(found: DataFrame, lists: DataFrame | None, n: int, low: float, turn: int) -> DataFrame:
    """Neighbour lists after a start from new random orders and rounds to rest."""
    buckets = max(1, -(-n // _BUCKET))
    entries = _leaves(found, low, turn).withColumn("old", F.lit(False))
    if lists is not None:
        entries = entries.unionByName(_entries(lists).select("u", "w", "sim", F.lit(True).alias("old")))
    lists = _lists(entries, buckets, low)
    for _ in range(ROUNDS):
        old = _entries(lists).select("u", "w", "sim", F.lit(True).alias("old"))
        lists = _lists(_round(found, lists, buckets, low).withColumn("old", F.lit(False)).unionByName(old), buckets, low)
        new = lists.agg(F.sum(F.size(F.filter("fresh", lambda x: x))).alias("new")).first().new or 0
        if new <= REST * K * n:
            break
    return lists


def links(found: DataFrame, lists: DataFrame, threshold: float, low: float) -> DataFrame:
    """(a, b), a < b, of the listed pairs that link."""
    pairs = _entries(lists).filter(F.col("sim") >= low).select(F.least("u", "w").alias("a"), F.greatest("u", "w").alias("b")).distinct()
    both = pairs.join(found.select(F.col("v").alias("a"), F.col("unit").alias("x")), "a").join(
        found.select(F.col("v").alias("b"), F.col("unit").alias("y")), "b").select("a", "b", "x", "y")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [np.frombuffer(x, np.float64) @ np.frombuffer(y, np.float64) >= threshold
                    for x, y in zip(b["x"].to_pylist(), b["y"].to_pylist(), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return store.saved(both.mapInArrow(check, "a long, b long"), "vector-links")


def _tiles(members: DataFrame, threshold: float, tile: int) -> DataFrame:
    """(v, partners): rows that each member links to within its component, all
    compared; members has label, n (members of the component), v, copies, unit."""
    dealt = members.withColumn("parts", F.ceil(F.col("n") / F.lit(tile)).cast("int")).withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"))
    dealt = dealt.select("label", "v", "copies", "unit", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")) \
        .select("label", "v", "copies", "unit", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))

    def compare(group: pa.Table) -> pa.Table:
        v, copies, part = (group[c].to_numpy() for c in ("v", "copies", "part"))
        x = _rows(group["unit"].combine_chunks(), np.float64)
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        one, two = np.flatnonzero(part == i), np.flatnonzero(part == j)
        total = np.zeros(len(v), dtype=np.int64)
        for lo in range(0, len(one), 256):
            rows = one[lo:lo + 256]
            near = x[rows] @ x[two].T >= threshold
            near &= v[rows][:, None] != v[two][None, :]
            total[rows] += near @ copies[two]
            if i != j:
                total[two] += copies[rows] @ near
        return pa.table({"v": v, "partners": total})

    return dealt.groupBy("label", "i", "j").applyInArrow(compare, "v long, partners long") \
        .groupBy("v").agg(F.sum("partners").alias("partners"))


def _counted(found: DataFrame, lists: DataFrame, threshold: float, low: float, tile: int) -> DataFrame:
    """(v, partners, label): rows of other vertices that link, component."""
    pairs = links(found, lists, threshold, low)
    label = store.saved(components(pairs), "vector-components")
    weight = found.select(F.col("v").alias("b"), "copies")
    own = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(weight, "b") \
        .groupBy(F.col("a").alias("v")).agg(F.sum("copies").alias("partners"))
    wide = lists.filter("full").select(F.col("u").alias("v")).join(label, "v").select("label").distinct()
    # written, so that the join deals its own rows by label and may split a hot one
    sizes = store.saved(label.groupBy("label").agg(F.count(F.lit(1)).alias("n")).join(wide, "label"), "component-sizes")
    members = label.join(sizes, "label").join(found.select("v", "copies", "unit"), "v")
    tiled = _tiles(members, threshold, tile)
    counts = own.join(tiled, "v", "left_anti").unionByName(tiled)
    return store.saved(counts.join(label, "v"), "vector-counts")


def audit(found: DataFrame, counts: DataFrame, threshold: float, sample: int = AUDIT) -> float:
    """Share of the links of a bounded sample of vertices that were found, by
    comparing the sample with all vertices of the same label."""
    asked = found.select("v", "g", "unit", F.xxhash64("v").alias("h")).orderBy("h", "v").limit(sample).collect()
    by_label: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for g in {r.g for r in asked}:
        rows = [r for r in asked if r.g == g]
        by_label[g] = (np.array([r.v for r in rows]), np.array([np.frombuffer(bytes(r.unit), np.float64) for r in rows]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g, v, copies = b["g"].to_numpy(zero_copy_only=False), b["v"].to_numpy(), b["copies"].to_numpy()
            for label in set(g.tolist()) & by_label.keys():
                at = np.flatnonzero(g == label)
                q, x = by_label[label]
                near = x @ _rows(b["unit"].take(pa.array(at)), np.float64).T >= threshold
                near &= q[:, None] != v[at][None, :]
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(near @ copies[at])], names=["v", "partners"])

    real = found.select("g", "v", "copies", "unit").mapInArrow(compare, "v long, partners long") \
        .groupBy("v").agg(F.sum("partners").alias("real")).filter("real > 0")
    r = real.join(counts.select("v", "partners"), "v", "left").agg(
        F.sum("real").alias("real"), F.sum(F.coalesce("partners", F.lit(0))).alias("got")).first()
    return r.got / r.real if r.real else 1.0


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(id, n_links, component_id, kept, audit_recall) of every row."""
    low = threshold - MARGIN
    bad = F.exists("vec", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    good = F.col("label").isNotNull() & F.coalesce(F.exists("vec", lambda c: c != 0), F.lit(False)) & ~bad
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label"))
    rows = rows.withColumn("g", F.when(good, F.concat(F.col("label").cast("string"), F.lit("/"), F.size("vec").cast("string")))).drop("label")
    found = vertices(rows.filter("g is not null"))
    n = found.count()
    lists, recall = None, 0.0
    for turn in range(PASSES):
        lists = descend(found, lists, n, low, turn)
        counts = _counted(found, lists, threshold, low, tile)
        recall = audit(found, counts, threshold)
        if recall >= RECALL:
            break
    smallest = counts.join(found.select("v", "first"), "v").groupBy("label").agg(F.min("first").alias("smallest"))
    known = found.select("v", "g", "vec", "first", "copies").join(counts.join(smallest, "label"), "v", "left").select(
        "g", "vec", (F.col("copies") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"),
        F.when(F.col("label").isNull(), F.col("first")).otherwise(F.col("smallest")).alias("component"))
    out = rows.join(known, ["g", "vec"], "left")
    component = F.when(F.col("n_links") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"), F.lit(recall).alias("audit_recall"))
