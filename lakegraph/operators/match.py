"""Pattern matches over the supply-chain graph, written as join plans.

Roles and column names (any loader that produces these frames works):

* orders:     order_id, customer, status, priority, order_date
* batches:    <batch key>, product, quality_status, description
* suppliers:  supplier_id, name, risk_tier, ...
* warehouses: warehouse_id, location, ...
* contains:   order_id, <batch key>           (Order)-[:CONTAINS]->(Batch)
* made_by:    <batch key>, supplier_id        (Batch)-[:MANUFACTURED_BY]->(Supplier)
* stored_in:  <batch key>, warehouse_id       (Batch)-[:STORED_IN]->(Warehouse)

The batch key is one column for the demo rows and two (part, supplier) for
the warehouse-scale tables, so every join takes the key as a list.

Plans filter each side before any join, walk edges with ids only, and
attach the wide node properties last.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class SupplyGraph:
    orders: DataFrame
    batches: DataFrame
    suppliers: DataFrame
    warehouses: DataFrame
    contains: DataFrame
    made_by: DataFrame
    stored_in: DataFrame
    batch_key: list[str]
    # CONTAINS before de-duplication (a fact table can repeat a pair); when
    # given, a match de-duplicates the key columns of the rows it needs
    contains_rows: DataFrame | None = None
    # the same rows with the stored columns a batch predicate can be written on
    # (see ``any_row_pred`` of pattern_3hop)
    batch_rows: DataFrame | None = None
    # suppliers without joined properties, with their stored columns
    supplier_rows: DataFrame | None = None
    # the batch keys (optionally with their to-one references supplier_id /
    # warehouse_id), when cheaper to produce than the node frame
    batch_keys: DataFrame | None = None
    order_keys: DataFrame | None = None
    # the order rows without joined properties: a filter on them is a plain
    # filtered scan, which lets Spark build a runtime Bloom filter from it
    # and prune the CONTAINS rows before they are shuffled
    order_rows: DataFrame | None = None
    # product by (a part of) the batch key
    products: DataFrame | None = None

    def property_graph(self):
        from lakegraph.operators.graph import EdgeType, PropertyGraph
        g = PropertyGraph()
        g.add_nodes("Order", self.orders, ["order_id"], self.order_keys)
        g.add_nodes("Batch", self.batches, self.batch_key, self.batch_keys)
        g.add_nodes("Supplier", self.suppliers, ["supplier_id"])
        g.add_nodes("Warehouse", self.warehouses, ["warehouse_id"])
        g.add_edges("CONTAINS", EdgeType("Order", "Batch", self.contains, ["order_id"], self.batch_key))
        g.add_edges("MANUFACTURED_BY", EdgeType("Batch", "Supplier", self.made_by, self.batch_key, ["supplier_id"]))
        g.add_edges("STORED_IN", EdgeType("Batch", "Warehouse", self.stored_in, self.batch_key, ["warehouse_id"]))
        return g


def _true() -> Column:
    return F.lit(True)


def _to_one(g: SupplyGraph, fk: str) -> DataFrame:
    """(batch key, fk) pairs of a to-one batch edge.

    When the batch frame carries the foreign key itself (as the source
    batch table does), read it there: joining the target on it is the same
    as walking the edge built from it, and saves a pass over the edge source.
    """
    if g.batch_keys is not None and fk in g.batch_keys.columns:
        return g.batch_keys.select(*g.batch_key, fk)
    if fk in g.batches.columns:
        return g.batches.select(*g.batch_key, fk)
    return g.made_by if fk == "supplier_id" else g.stored_in


def pattern_3hop(g: SupplyGraph, order_pred: Column | None = None,
                 batch_pred: Column | None = None, supplier_pred: Column | None = None,
                 warehouse_pred: Column | None = None, any_row_pred: Column | None = None,
                 supplier_row_pred: Column | None = None) -> DataFrame:
    """``(o)-[:CONTAINS]->(b)-[:MANUFACTURED_BY]->(sup), (b)-[:STORED_IN]->(w) WHERE ...``

    Returns one row per matching path: oid, cust, <batch key>, prod,
    sup_name, risk, warehouse.

    ``any_row_pred`` (with ``g.batch_rows``) says the same as ``batch_pred`` on
    the stored rows of a batch: the batch matches when any of its rows does.
    Then matching batches are the distinct keys of the filtered rows, and the
    filter, like ``supplier_row_pred`` on the stored supplier columns, reaches
    the scan; no aggregate over all rows is needed.
    """
    bk = g.batch_key
    op = order_pred if order_pred is not None else _true()
    o_src = g.order_rows if g.order_rows is not None else g.orders
    o_ids = o_src.filter(op).select(F.col("order_id").alias("oid"))
    o_names = g.orders.filter(op).select(F.col("order_id").alias("oid"), F.col("customer").alias("cust"))
    refs = ["supplier_id", "warehouse_id"]
    suppliers = g.suppliers.filter(supplier_pred if supplier_pred is not None else _true())
    s = suppliers.select("supplier_id", F.col("name").alias("sup_name"), F.col("risk_tier").alias("risk"))
    w = g.warehouses.filter(warehouse_pred if warehouse_pred is not None else _true()) \
        .select("warehouse_id", F.col("location").alias("warehouse"))

    # batch side first: batches that pass their own and their supplier's test
    if any_row_pred is not None and g.batch_rows is not None:
        rows = g.batch_rows.filter(any_row_pred)
        if supplier_row_pred is not None and g.supplier_rows is not None:
            rows = rows.join(g.supplier_rows.filter(supplier_row_pred).select("supplier_id"), "supplier_id", "left_semi")
        keys = rows.select(*bk, *refs).distinct()
        bsw = keys.join(s, "supplier_id").join(w, "warehouse_id").drop(*refs)
        edges = g.contains_rows.withColumnRenamed("order_id", "oid").join(bsw.select(*bk), bk, "left_semi")
        pairs = edges.join(o_ids, "oid", "left_semi").distinct()
        products = g.products if g.products is not None else g.batches.select(*bk, "product")
        on = [c for c in bk if c in products.columns]
        paths = pairs.join(bsw, bk).join(products.withColumnRenamed("product", "prod"), on, "left")
    else:
        refs_on_batch = all(c in g.batches.columns for c in refs)
        b = g.batches.filter(batch_pred if batch_pred is not None else _true()) \
            .select(*bk, F.col("product").alias("prod"), *(refs if refs_on_batch else []))
        if refs_on_batch:
            bsw = b.join(s, "supplier_id").join(w, "warehouse_id")
        else:
            bs = b.join(g.made_by, bk).join(s, "supplier_id")
            bsw = bs.join(g.stored_in, bk).join(w, "warehouse_id")
        paths = _edges_of(g).withColumnRenamed("order_id", "oid").join(o_ids.distinct(), "oid").join(bsw, bk)
    # customer names only for the matched paths
    paths = paths.join(o_names, "oid")
    return paths.select("oid", "cust", *bk, "prod", "sup_name", "risk", "warehouse")


def pattern_paths(g: SupplyGraph, order_pred: Column | None = None, batch_pred: Column | None = None,
                  supplier_pred: Column | None = None, warehouse_pred: Column | None = None) -> DataFrame:
    """The rows of ``pattern_3hop`` over a graph whose frames are stored, one row
    per node and edge: filters and inner joins only, so that the planner may order
    the legs by the tables' statistics (``session.cbo_conf``)."""
    bk = g.batch_key
    legs = [(g.orders, order_pred), (g.batches, batch_pred), (g.suppliers, supplier_pred), (g.warehouses, warehouse_pred)]
    o, b, s, w = (frame if pred is None else frame.filter(pred) for frame, pred in legs)
    return (g.contains.join(o, "order_id").join(b, bk).join(s, "supplier_id").join(w, "warehouse_id")
            .select(F.col("order_id").alias("oid"), F.col("customer").alias("cust"), *bk, F.col("product").alias("prod"),
                    F.col("name").alias("sup_name"), F.col("risk_tier").alias("risk"), F.col("location").alias("warehouse")))


def expand_inner(seeds: DataFrame, g: SupplyGraph) -> DataFrame:
    """``MATCH (o:Order)-[:CONTAINS]->(node)``: seeds with no order vanish; 1:n."""
    return _seed_edges(seeds, g).join(g.orders, "order_id")


def _edges_of(g: SupplyGraph) -> DataFrame:
    """CONTAINS with one row per (order, batch), key columns only."""
    return g.contains if g.contains_rows is None else g.contains_rows.distinct()


def _seed_edges(seeds: DataFrame, g: SupplyGraph, whole: bool = False) -> DataFrame:
    """Seeds joined to their CONTAINS edges: one row per (seed row, order).

    Edge pairs are made distinct on their keys first (map-side partial), for
    the seeds' batches only (``whole`` says that the seeds are all batches);
    equal seed rows stay as many rows, in every input form.
    """
    bk = g.batch_key
    if g.contains_rows is None:
        return seeds.join(g.contains, bk)
    if whole:
        return seeds.join(g.contains_rows.distinct(), bk)
    near = g.contains_rows.join(seeds.select(*bk), bk, "left_semi").distinct()
    return seeds.join(near, bk)


def expand_optional(seeds: DataFrame, g: SupplyGraph) -> DataFrame:
    """``OPTIONAL MATCH (node)-[:MANUFACTURED_BY]->(sup)`` and
    ``OPTIONAL MATCH (node)-[:STORED_IN]->(w)``: left outer joins, so a seed
    without supplier or warehouse keeps a row with nulls.

    Seeds that already carry ``supplier_id`` / ``warehouse_id`` are joined
    to the targets directly; otherwise the edge frames supply the ids.
    """
    bk = g.batch_key
    targets = {
        "supplier_id": g.suppliers.select("supplier_id", F.col("name").alias("supplier_name"),
                                          F.col("risk_tier").alias("supplier_risk")),
        "warehouse_id": g.warehouses.select("warehouse_id",
                                            F.col("location").alias("warehouse_location")),
    }
    out = seeds
    for fk, tgt in targets.items():
        if fk not in out.columns:
            out = out.join(_to_one(g, fk), bk, "left")
        out = out.join(tgt, fk, "left").drop(fk)
    return out


SEEDED_COLUMNS = ["order_id", "customer", "status", "priority", "product", "quality_status",
                  "supplier_name", "supplier_risk", "warehouse_location"]


def seeded_expand(seeds: DataFrame, g: SupplyGraph, order_pred: Column | None = None,
                  keep: list[str] | None = None, whole: bool = False) -> DataFrame:
    """Seed batches -> their orders (inner) -> supplier and warehouse (optional).

    ``seeds`` holds the batch key (plus any columns to carry, e.g. query id
    and score, listed in ``keep``); ``whole`` says that they are all batches.
    Output: the carried columns, the batch key and the ten RETURN columns of
    the retrieval query.
    """
    bk = g.batch_key
    keep = keep or []
    # seeds taken from the batch node frame already carry the batch
    # properties (and references); then there is nothing to join back
    props = ["product", "quality_status"]
    refs = [c for c in ("supplier_id", "warehouse_id") if c in seeds.columns]
    carried = all(c in seeds.columns for c in props)
    s = seeds.select(*keep, *bk, *(props + refs if carried else []))
    orders = g.orders
    if order_pred is not None:
        orders = orders.filter(order_pred)
    inner = (_seed_edges(s, g, whole)
              .join(orders.select("order_id", "customer", "status", "priority"), "order_id"))
    if carried:
        with_b = inner
    else:
        fks = [c for c in ("supplier_id", "warehouse_id") if c in g.batches.columns]
        with_b = inner.join(g.batches.select(*bk, *props, *fks), bk)
    full = expand_optional(with_b, g)
    return full.select(*keep, *bk, *SEEDED_COLUMNS)
