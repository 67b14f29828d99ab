"""Property-graph jobs: rows become labelled node tables and typed edge tables.

A graph here is plain DataFrames: one node frame per label (key columns +
properties) and one edge frame per type (source key columns + target key
columns, at most one row per pair). Loading, key checks, reference checks,
upserts and structure reports are joins and aggregations over those frames,
so they run distributed instead of one statement per row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class EdgeType:
    src_label: str
    dst_label: str
    frame: DataFrame
    src_cols: list[str]
    dst_cols: list[str]


@dataclass
class PropertyGraph:
    nodes: dict[str, DataFrame] = field(default_factory=dict)
    keys: dict[str, list[str]] = field(default_factory=dict)
    edges: dict[str, EdgeType] = field(default_factory=dict)
    # optional key-only frames, used where properties are not needed
    key_frames: dict[str, DataFrame] = field(default_factory=dict)

    def add_nodes(self, label: str, frame: DataFrame, key: list[str],
                  key_frame: DataFrame | None = None) -> None:
        self.nodes[label] = frame
        self.keys[label] = list(key)
        if key_frame is not None:
            self.key_frames[label] = key_frame

    def add_edges(self, etype: str, edge: EdgeType) -> None:
        self.edges[etype] = edge


def project_nodes(df: DataFrame, key: list[str], props: dict[str, Column | str]) -> DataFrame:
    """One node per key: key columns plus the listed properties (renamed).

    Rows that share a key are one node (``MERGE`` on the key). Rows have no
    order, so where they differ the largest property tuple wins, column by
    column from the left, any value over null. A null key makes no node.
    """
    made = [(F.col(v) if isinstance(v, str) else v).alias(n) for n, v in props.items()]
    rows = df.select(*[F.col(k) for k in key], F.struct(*made).alias("__p")).dropna(subset=key)
    return rows.groupBy(*key).agg(F.max("__p").alias("__p")).select(*key, *[F.col(f"__p.{n}").alias(n) for n in props])


def build_edges(src_rows: DataFrame, src_cols: list[str], fk_cols: list[str],
                targets: DataFrame, target_key: list[str],
                dst_names: list[str] | None = None, dedupe: bool = True) -> DataFrame:
    """Edges from a foreign key to an existing target node, at most one per pair.

    A reference whose target is missing yields no edge (it is reported by
    ``dangling_refs``); a null reference never matches. The target side is
    only used for its keys (semi join), so its properties are not shuffled.
    ``dedupe=False`` skips the de-duplication when the source rows are
    already unique per (source, target).
    """
    dst_names = dst_names or fk_cols
    edges = src_rows.select(*[F.col(c) for c in src_cols],
                            *[F.col(f).alias(d) for f, d in zip(fk_cols, dst_names)])
    tk = targets.select(*[F.col(k).alias(d) for k, d in zip(target_key, dst_names)])
    out = edges.join(tk, on=dst_names, how="left_semi")
    return out.distinct() if dedupe else out


def node_counts(g: PropertyGraph) -> DataFrame:
    """Nodes per label, ordered by label (``labels(n)[0], count(n)``)."""
    parts = [g.key_frames.get(label, frame).agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(label).alias("label"), "n")
             for label, frame in g.nodes.items()]
    return _union(parts).orderBy("label")


def edge_counts(g: PropertyGraph) -> DataFrame:
    """Edges per type, ordered by type (``type(r), count(r)``)."""
    parts = [e.frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("edge_type"), "n")
             for t, e in g.edges.items()]
    return _union(parts).orderBy("edge_type")


def key_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once (what a uniqueness constraint rejects).

    The count is a partial + final aggregation, so a key held by a third of
    all rows still collapses map-side before the shuffle.
    """
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def label_key_report(sources: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """One row per label: rows of its source, distinct keys, repeated keys and
    null keys, counted before any rows are merged."""
    parts = []
    for label, (df, key) in sources.items():
        null = F.lit(False)
        for k in key:
            null = null | F.col(k).isNull()
        per_key = df.select(*key, null.alias("__null")).groupBy(*key, "__null").agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"), F.count_if(~F.col("__null")).alias("n_keys"),
            F.count_if(~F.col("__null") & (F.col("n") > 1)).alias("n_repeated"),
            F.coalesce(F.sum(F.when(F.col("__null"), F.col("n"))), F.lit(0)).cast("long").alias("n_null"))
            .select(F.lit(label).alias("label"), "n_rows", "n_keys", "n_repeated", "n_null"))
    return _union(parts)


def drop_duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Enforce uniqueness: keep one row per key."""
    return df.dropDuplicates(key)


def dangling_refs(df: DataFrame, fk_cols: list[str], targets: DataFrame,
                  target_key: list[str]) -> DataFrame:
    """Rows whose reference has no target (what ``MATCH`` silently skips)."""
    tk = targets.select(*[F.col(k).alias(f) for k, f in zip(target_key, fk_cols)])
    return df.join(tk, on=fk_cols, how="left_anti")


def dangling_summary(checks: dict[str, tuple[DataFrame, list[str], DataFrame, list[str]]]) -> DataFrame:
    """One row per reference: how many referencing rows, how many dangle.

    The referencing rows are first counted per key value (partial + final
    aggregation: a key held by a third of the rows collapses map-side), so
    only distinct key values are shuffled and joined to the target keys.
    """
    parts = []
    for name, (df, fk, tgt, tkey) in checks.items():
        per_key = df.groupBy(*fk).agg(F.count(F.lit(1)).alias("__c"))
        tk = tgt.select(*[F.col(k).alias(f) for k, f in zip(tkey, fk)]).distinct() \
                .withColumn("__hit", F.lit(True))
        j = per_key.join(tk, on=fk, how="left")
        parts.append(j.agg(
            F.coalesce(F.sum("__c"), F.lit(0)).cast("long").alias("n_refs"),
            F.coalesce(F.sum(F.when(F.col("__hit").isNull(), F.col("__c"))), F.lit(0))
             .cast("long").alias("n_dangling"))
            .select(F.lit(name).alias("reference"), "n_refs", "n_dangling"))
    return _union(parts)


def upsert(base: DataFrame, updates: DataFrame, key: list[str],
           columns: list[str] | None = None, change_col: str | None = "change",
           check_unique: bool = False) -> DataFrame:
    """Merge ``updates`` into ``base`` by key (``MERGE ... SET``).

    Where an update row exists its listed columns win, even when null; all
    other base columns, and base rows without an update, stay as they are;
    update rows without a base row are inserted. Update rows that share a key
    are one update first (the largest tuple, as in ``project_nodes``), in the
    partitioning the join uses. One full outer join on the key; adaptive
    execution splits a skewed partition. ``check_unique`` makes repeated
    update keys an error instead.
    """
    if check_unique and key_violations(updates, key).limit(1).count() > 0:
        raise ValueError(f"updates repeat a key {key}: the merge would be ambiguous")
    columns = columns or [c for c in base.columns if c not in key]
    b = base.select(*key, F.struct(*[c for c in base.columns if c not in key]).alias("__b"))
    u = updates.select(*key, F.struct(*columns).alias("__u")).groupBy(*key).agg(F.max("__u").alias("__u"))
    j = b.join(u, on=key, how="full_outer")
    has_u = F.col("__u").isNotNull()
    out = [F.col(k) for k in key]
    for c in base.columns:
        if c in columns:
            out.append(F.when(has_u, F.col(f"__u.{c}")).otherwise(F.col(f"__b.{c}")).alias(c))
        elif c not in key:
            out.append(F.col(f"__b.{c}").alias(c))
    out += [F.col(f"__u.{c}").alias(c) for c in columns if c not in base.columns]
    if change_col:
        out.append(F.when(F.col("__b").isNull(), "insert")
                    .when(has_u, "update").otherwise("keep").alias(change_col))
    return j.select(*out)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
