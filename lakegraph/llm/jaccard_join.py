"""Similarity join of documents on word shingles: Jaccard >= percent / 100 (0.9
unless given), by a size-aware heavy-light join.

A document is its set of distinct word shingles. Equal sets are one vertex.
Shingles are ordered rare first by a count sketch over the whole corpus (a
table of fixed size; the order decides only how much work is done). A set of
size s shares at least o = ceil(percent / 100 s) shingles with any partner, so
two partners have c common shingles among their first s - o + c:

* light sets (up to the boundary size) enumerate all pairs (c = 2) of those
  first shingles; equal pairs make candidates;
* heavy sets go into the inverted lists of their first shingles (c = 1), which
  also hold the light sets close enough to the boundary to have a heavy
  partner.

The boundary is the size with the smallest cost over the corpus' histogram of
set sizes; a list entry costs ``SCAN`` subset keys.

Every entry knows how many rarer shingles its set has in front. The smaller set
of a pair needs fewer of its first shingles (at 0.9, overlap at least 18/19 of
its size), so lists pair these index entries with all others, and the shingles in
front bound the overlap that is still possible.

Candidates of a list are first the pairs with its foremost member (the one with
the fewest rarer shingles, as the least edited of a group of copies). Links
found by them are joined to components, and only lists that still hold several
components give their other pairs, across components, so a large group of near
copies costs about one pair per member and list, and no link between
components is lost. Where all links are asked for, the lists then give their
pairs inside components too. Pairs are cut by a bound on the symmetric difference
(parity bitmaps, exact), and the rest is decided by intersecting whole sets.

Shingles and sets are told apart by 64-bit hashes.

Defined cases: null, empty or wordless texts have the empty set and no link;
fewer words than a shingle has are one shingle; a null doc_id is larger than any
other; repeated rows are copies; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakegraph.llm import store, words
from lakegraph.llm.components import components

SIZE, PERCENT = 3, 90
SKETCH, BLOCKS = 1 << 22, 64
SCAN = 4
BITS = 1024
BLOOM = 1 << 23


def need(n, percent: int = PERCENT):
    """Smallest overlap of a set of n with any partner."""
    return -(-percent * n // 100)


def overlap(total, percent: int = PERCENT):
    """Smallest overlap of two linked sets whose sizes add up to ``total``;
    a Column or a number."""
    if isinstance(total, Column):
        return F.ceil(F.lit(percent) * total / F.lit(100.0 + percent) - F.lit(1e-9))
    return -(-percent * total // (100 + percent))


def linkable(percent: int = PERCENT) -> int:
    """Smallest set that may link to a different one: n of n + 1 in common."""
    return -(-percent // (100 - percent))


class Sets:
    """Distinct shingles of each row of a flat batch, sorted by row and hash."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, size: int = SIZE):
        data = words.LOWER[data]
        s, e, first = words.spans(data, offs, words.NOT_SPACE)
        h = words.word_hashes(data, s, e)
        counts = np.diff(first)
        at, row = words.runs_in_rows(first, size)
        found, rows = [words.joined(h, size)[at]], [row]
        for k in range(1, size):                        # short rows: the whole sequence
            own = np.flatnonzero(counts == k)
            if len(own):
                found.append(words.mix(words.joined(h, k)[first[own]] + words.U64(k)))
                rows.append(own)
        h, row = np.concatenate(found), np.concatenate(rows)
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        keep = np.ones(len(h), dtype=bool)
        keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        self.h, self.row = h[keep], row[keep]
        self.n = np.bincount(self.row, minlength=len(offs) - 1)
        self.first = np.concatenate([[0], np.cumsum(self.n)])

    def fingerprints(self) -> np.ndarray:
        """One hash per row's set."""
        total = np.concatenate([np.zeros(1, words.U64), np.cumsum(words.mix(self.h + words.U64(0x51ED2701)), dtype=words.U64)])
        return words.mix(total[self.first[1:]] - total[self.first[:-1]] + self.n.astype(words.U64)).view(np.int64)

    def bitmaps(self) -> np.ndarray:
        """Parity bitmap of each row's set (rows x BITS / 8 bytes)."""
        rows = len(self.n)
        cell = self.row * BITS + (self.h >> words.U64(54)).astype(np.int64) % BITS
        return np.packbits((np.bincount(cell, minlength=rows * BITS) & 1).astype(np.uint8).reshape(rows, BITS), axis=1)

    def keys(self, sketch: np.ndarray, light: int, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, key, place) of all subset keys and list keys; place is the
        number of the set's shingles that come before the key's last one,
        without the key's own."""
        rank_key = (np.minimum(sketch[(self.h % words.U64(SKETCH)).astype(np.int64)], (1 << 20) - 1).astype(words.U64) << words.U64(44)) \
            | (words.mix(self.h) >> words.U64(20))
        order = np.lexsort((rank_key, self.row))        # stable: equal keys stay in hash order
        token, row = self.h[order], self.row[order]
        place = np.arange(len(token)) - self.first[:-1][row]
        n = self.n[row]
        least = linkable(percent)                       # smaller sets only have equal partners
        lists = (n >= least) & (n >= need(light, percent)) & (place < n - need(n, percent) + 1)
        keys, rows, places = [words.mix(token[lists] + words.U64(1))], [row[lists]], [place[lists]]
        start, take = self.first[:-1], self.n - need(self.n, percent) + 2
        small = (self.n >= least) & (self.n <= light)
        depth = int(take[small].max()) if small.any() else 0
        for i in range(depth):
            for j in range(i + 1, depth):
                own = np.flatnonzero(small & (take > j))
                x, y = token[start[own] + i], token[start[own] + j]
                keys.append(words.mix(np.minimum(x, y) * words.U64(0x9FB21C651E98DF25) + np.maximum(x, y)))
                rows.append(own)
                places.append(np.full(len(own), j - 1))
        row, key, place = np.concatenate(rows), np.concatenate(keys), np.concatenate(places)
        order = np.argsort(row, kind="stable")
        return row[order], key[order].view(np.int64), place[order]


_MADE = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("v", pa.int64()), ("block", pa.int32()), ("counts", pa.binary())])


def _measure(docs: DataFrame, size: int) -> DataFrame:
    """One row per document (doc_id, n, v) and each task's sketch blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(SKETCH, dtype=np.int32)
        for b in batches:
            for row, end, data, offs in words.chunks(b["text"]):
                s = Sets(data, offs, size)
                np.add.at(table, (s.h % words.U64(SKETCH)).astype(np.int64), 1)
                k = end - row
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"].slice(row, k), pa.array(s.n, pa.int64()), pa.array(s.fingerprints()),
                     pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], schema=_MADE)
        blocks = np.split(table, BLOCKS)
        used = [i for i, x in enumerate(blocks) if x.any()]
        packed = [pa.compress(blocks[i].tobytes(), codec="zstd", asbytes=True) for i in used]
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, pa.array(used, pa.int32()), pa.array(packed, pa.binary())], schema=_MADE)
        del table, blocks, packed
        store.release()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, v long, block int, counts binary")


def _sketch(made: DataFrame) -> np.ndarray:
    """The corpus sketch: SKETCH counts, a fixed 4 MB at most."""
    part = SKETCH // BLOCKS

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(part, dtype=np.int64)
        for x in group["counts"]:
            total += np.frombuffer(pa.decompress(x.as_py(), part * 4, codec="zstd", asbytes=True), dtype=np.int32)
        return pa.table({"block": [group["block"][0].as_py()], "counts": [np.minimum(total, 2 ** 31 - 1).astype(np.int32).tobytes()]},
                        schema=pa.schema([("block", pa.int32()), ("counts", pa.binary())]))

    out = np.zeros(SKETCH, dtype=np.int32)
    rows = made.filter("block is not null").select("block", "counts").groupBy("block").applyInArrow(add, "block int, counts binary")
    for r in rows.collect():
        out[r.block * part:(r.block + 1) * part] = np.frombuffer(bytes(r.counts), dtype=np.int32)
    return out


def boundary(sizes: list[tuple[int, int]], percent: int = PERCENT) -> int:
    """Largest light size, by cost over (size, sets) pairs of the histogram."""
    n = np.array([s for s, _ in sizes] or [0], dtype=np.int64)
    many = np.array([c for _, c in sizes] or [0], dtype=np.float64)
    slack, least = n - need(n, percent), linkable(percent)
    light_cost = many * (slack + 2) * (slack + 1) / 2
    list_cost = many * (slack + 1) * SCAN
    best = min(range(least - 1, 400), key=lambda x: (light_cost[(n >= least) & (n <= x)].sum()
                                                     + list_cost[(n >= least) & (n >= need(x, percent))].sum(), x))
    return best


def _vertices(docs: DataFrame, sketch: np.ndarray, light: int, size: int, percent: int) -> DataFrame:
    """(v, n, doc, bitmap, keys, places) of each distinct set that may have
    partners."""
    sent = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, end, data, offs in words.chunks(b["text"]):
                s = Sets(data, offs, size)
                rows, keys, places = s.keys(sent.value, light, percent)
                at = pa.array(np.searchsorted(rows, np.arange(end - row + 1)), pa.int32())
                out = pa.RecordBatch.from_arrays(
                    [pa.array(s.fingerprints()), pa.array(s.n, pa.int64()), b["doc_id"].slice(row, end - row),
                     pa.array([x.tobytes() for x in s.bitmaps()], pa.binary()),
                     pa.ListArray.from_arrays(at, pa.array(keys)), pa.ListArray.from_arrays(at, pa.array(places, pa.int32()))],
                    names=["v", "n", "doc", "bitmap", "keys", "places"])
                yield out.filter(pa.array(s.n >= linkable(percent)))
        store.release()

    made = docs.select("doc_id", "text").mapInArrow(run, "v long, n long, doc long, bitmap binary, keys array<long>, places array<int>")
    return made.groupBy("v").agg(F.min("doc").alias("doc"), *[F.first(c).alias(c) for c in ("n", "bitmap", "keys", "places")])


def _near(pairs: DataFrame, vertices: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and parity bitmaps do not rule out."""
    side = vertices.select("v", "n", "bitmap")
    x = pairs.join(side.select(F.col("v").alias("a"), F.col("n").alias("na"), F.col("bitmap").alias("ma")), "a")
    x = x.join(side.select(F.col("v").alias("b"), F.col("n").alias("nb"), F.col("bitmap").alias("mb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            total = b["na"].to_numpy() + b["nb"].to_numpy()
            ma, mb = (words.flat(b[c])[0].reshape(b.num_rows, -1) for c in ("ma", "mb"))
            apart = np.bitwise_count(ma ^ mb).sum(axis=1, dtype=np.int64)
            most = total - 2 * overlap(total, percent)
            yield b.select(["a", "b"]).filter(pa.array(apart <= most))

    return x.filter(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").select("a", "b", "na", "nb", "ma", "mb") \
        .mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, vertices: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose whole sets link. Only documents that may stand for a
    paired vertex have their sets made again: a Bloom filter of fixed size
    over their doc_ids spares the others, the join decides."""
    spark = docs.sparkSession
    used = pairs.select(F.col("a").alias("v")).union(pairs.select("b")).distinct()
    wanted = used.join(vertices.select("v", "doc"), "v").select("doc")

    def slots(ids: pa.Array) -> np.ndarray:
        h = words.mix(ids.fill_null(-(2 ** 63)).to_numpy(zero_copy_only=False).view(words.U64) + words.U64(77))
        return np.stack([(h >> words.U64(s)) % words.U64(BLOOM) for s in (0, 20, 40)]).astype(np.int64)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BLOOM, dtype=bool)
        for b in batches:
            bits[slots(b["doc"]).ravel()] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bits"])

    bloom = np.zeros(BLOOM // 8, dtype=np.uint8)
    for r in wanted.coalesce(8).mapInArrow(fill, "bits binary").collect():      # at most 8 MB
        bloom |= np.frombuffer(bytes(r.bits), dtype=np.uint8)
    sent = spark.sparkContext.broadcast(bloom)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(sent.value).astype(bool)
        for b in batches:
            b = b.filter(pa.array(bits[slots(b["doc_id"])].all(axis=0)))
            for _, _, data, offs in words.chunks(b["text"]):
                s = Sets(data, offs, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.fingerprints()), pa.ListArray.from_arrays(pa.array(s.first, pa.int32()), pa.array(s.h.view(np.int64)))],
                    names=["v", "h"])
        store.release()

    made = docs.select("doc_id", "text").mapInArrow(sets, "v long, h array<long>")
    both = pairs.join(made.select(F.col("v").alias("a"), F.col("h").alias("ha")), "a") \
                .join(made.select(F.col("v").alias("b"), F.col("h").alias("hb")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b["ha"], b["hb"], strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append((100 + percent) * common >= percent * (len(x) + len(y)))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        store.release()

    return both.select("a", "b", "ha", "hb").mapInArrow(check, "a long, b long").distinct()


def _others(members: DataFrame, on: list[str], percent: int) -> DataFrame:
    """(a, b, label_a, label_b) of list members that agree in ``on`` and whose
    sizes and places do not rule a link out; a is the smaller set."""
    x = members.filter("index").select(*on, *[F.col(c).alias(f"{c}_a") for c in ("v", "n", "place", "label") if c not in on])
    y = members.select(*on, *[F.col(c).alias(f"{c}_b") for c in ("v", "n", "place", "label") if c not in on])
    front = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    return x.join(y, on).filter((F.struct("n_a", "v_a") < F.struct("n_b", "v_b")) & (100 * F.col("n_a") >= percent * F.col("n_b"))
                                & (front >= overlap(F.col("n_a") + F.col("n_b"), percent))) \
        .withColumnsRenamed({"v_a": "a", "v_b": "b"})


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _joined(docs: DataFrame, size: int, percent: int, whole: bool) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The measured documents, the vertices, links (a, b) and the components
    (v, label). The links make the components; ``whole`` gives all of them,
    each once."""
    made = store.saved(_measure(docs, size), "shingle-sets")
    sizes = [(r.n, r["count"]) for r in made.filter("n <= 400").groupBy("n").count().collect()]     # at most 401 rows
    light = boundary(sizes, percent)
    vertices = store.saved(_vertices(docs, _sketch(made), light, size, percent), "vertices")
    entries = vertices.select("v", "n", F.explode(F.arrays_zip("keys", "places")).alias("e")) \
        .select("v", "n", F.col("e.keys").alias("key"), F.col("e.places").alias("place")) \
        .withColumn("index", F.col("place") <= F.col("n") - overlap(F.col("n") * 2, percent))
    # lists of two or more, with their foremost member
    heads = entries.groupBy("key").agg(F.min(F.struct("place", "n", "v")).alias("head"), F.count(F.lit(1)).alias("many"),
                                       F.max("index").alias("some")).filter("many > 1 and some")
    lists = store.saved(entries.join(heads, "key").select("key", "v", "n", "place", "index", "many", F.col("head.v").alias("head")), "lists")
    stars = store.saved(_near(lists.filter("v != head").select(F.col("head").alias("a"), F.col("v").alias("b")).distinct(), vertices, percent), "pairs")
    links = store.saved(_verified(stars, docs, vertices, size, percent), "links")
    label = components(links)
    # lists of three or more that hold several components give their other pairs
    rest = lists.filter("many > 2").drop("many").join(label, "v", "left").withColumn("label", F.coalesce("label", "v"))
    mixed = rest.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("key")
    rest = store.saved(rest.join(mixed, "key", "left_semi").filter("v != head").drop("head"), "mixed")
    others = _others(rest, ["key"], percent).filter("label_a != label_b").select("a", "b").distinct()
    more = store.saved(_near(others, vertices, percent), "pairs")
    if more.limit(1).count():
        links = store.saved(links.unionByName(_verified(more, docs, vertices, size, percent)).distinct(), "links")
        label = components(links)
    if whole:
        # what is left are the pairs inside a component that no pass has checked
        members = lists.filter("many > 2 and v != head").join(label, "v").select("key", "v", "n", "place", "index", "label")
        inside = _near(_ordered(_others(members, ["key", "label"], percent)), vertices, percent)
        inside = store.saved(inside.join(_ordered(stars.unionByName(more)), ["a", "b"], "left_anti"), "pairs")
        links = store.saved(_ordered(links.unionByName(_verified(inside, docs, vertices, size, percent))), "links")
    return made, vertices, links, label


def links(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(a, b) of every two different sets that link, each pair once, a below b;
    a set goes by the smallest doc_id that has it."""
    _, vertices, found, _ = _joined(docs, size, percent, whole=True)
    ends = [vertices.select(F.col("v").alias(c), F.col("doc").alias(f"doc_{c}")) for c in "ab"]
    x, y = F.struct(F.col("doc_a").isNull(), "doc_a"), F.struct(F.col("doc_b").isNull(), "doc_b")      # null is larger
    return found.join(ends[0], "a").join(ends[1], "b").select(F.when(x <= y, F.col("doc_a")).otherwise(F.col("doc_b")).alias("a"),
                                                              F.when(x <= y, F.col("doc_b")).otherwise(F.col("doc_a")).alias("b"))


def similar(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, counted: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; percent is above
    50 and below 100. ``counted`` adds n_links, the other documents it links
    to, copies of its own set included."""
    made, vertices, found, label = _joined(docs, size, percent, whole=counted)
    grouped = vertices.select("v", "doc").join(label, "v")
    smallest = grouped.groupBy("label").agg(F.min("doc").alias("component"))
    of_vertex = grouped.join(smallest, "label").select("v", "component")
    # sets too small for links: equal sets only
    own = made.filter("block is null").select("doc_id", "n", "v")
    equal = own.filter("n > 0").groupBy("v").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    ids = equal.join(of_vertex, "v", "left").select("v", F.least("least", "component").alias("component"), "copies")
    if counted:
        ends = found.union(found.select("b", "a")).toDF("v", "to").join(equal.select(F.col("v").alias("to"), "copies"), "to")
        ids = ids.join(ends.groupBy("v").agg(F.sum("copies").alias("partners")), "v", "left") \
            .withColumn("n_links", F.col("copies") - 1 + F.coalesce("partners", F.lit(0)))
    return own.join(ids, "v", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        *[F.coalesce("n_links", F.lit(0)).alias("n_links")] * counted)


def keep_smallest(docs: DataFrame, columns: tuple[str, ...], size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The given columns of one row of each component: the smallest doc_id's
    (null is larger than any other), of several sets that this doc_id has the one
    with the smaller hash, of several rows with that set the smallest text. Rows
    with an empty set stay.

    A doc_id that stands in one row is decided by itself; rows that share their
    doc_id, or have none, are decided by their set as well."""
    made, _, _, label = _joined(docs, size, percent, whole=False)
    own = made.filter("block is null").select("doc_id", "n", "v")
    sets = own.filter("n > 0").groupBy("v").agg(F.min("doc_id").alias("least"))
    first = sets.join(label, "v", "left").groupBy(F.coalesce("label", "v").alias("label")).agg(
        F.min(F.struct(F.col("least").isNull().alias("none"), "least", "v")).alias("first"))
    first = store.saved(first.select(F.col("first.v").alias("v"), F.col("first.least").alias("best")), "first-of-component")
    stays = (F.col("n") == 0) | F.coalesce(F.col("v") == F.col("w"), F.lit(False))
    wins = own.join(first.withColumnRenamed("v", "w"), (F.col("v") == F.col("w")) & F.col("doc_id").eqNullSafe(F.col("best")), "left")
    ids = wins.groupBy("doc_id").agg((F.col("doc_id").isNull() | (F.count(F.lit(1)) > 1)).alias("several"), F.max(stays).alias("stays"))
    ids = store.saved(ids.filter("several or not stays"), "undecided")
    clear = docs.filter("doc_id is not null").join(ids.select("doc_id"), "doc_id", "left_anti").select(*columns)
    several = ids.filter("several").select("doc_id")
    if not several.limit(1).count():
        return clear

    names = list(dict.fromkeys([*columns, "doc_id", "text"]))
    n_col, v_col = (store.free_name(names, x) for x in ("_n", "_v"))
    rows = docs.filter("doc_id is null").select(*names).unionByName(docs.join(several, "doc_id", "left_semi").select(*names))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, end, data, offs in words.chunks(b["text"]):
                s = Sets(data, offs, size)
                yield pa.RecordBatch.from_arrays([*b.slice(row, end - row).columns, pa.array(s.n, pa.int64()), pa.array(s.fingerprints())],
                                                 names=[*names, n_col, v_col])
        store.release()

    rows = rows.mapInArrow(marked, StructType([*(docs.schema[c] for c in names), *StructType.fromDDL(f"{n_col} long, {v_col} long").fields]))
    best, place = (store.free_name(rows.columns, x) for x in ("_best", "_place"))
    found = rows.filter(F.col(n_col) > 0).join(first.select(F.col("v").alias(v_col), F.col("best").alias(best)), v_col) \
        .filter(F.col("doc_id").eqNullSafe(F.col(best)))
    one = found.withColumn(place, F.row_number().over(Window.partitionBy(v_col).orderBy("text"))).filter(F.col(place) == 1)
    return clear.unionByName(one.select(*columns)).unionByName(rows.filter(F.col(n_col) == 0).select(*columns))
