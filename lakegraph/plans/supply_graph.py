"""Supply-chain graphs from the two kinds of input.

``fixture_graph``: the demo's four tables (string ids, one FK per row).

``tables_graph``: the same roles over the warehouse-scale tables:

* Order     = orders (+ customer name); status DELAYED/SHIPPED/PENDING from
              o_orderstatus P/F/O; priority HIGH for 1-URGENT and 2-HIGH,
              MEDIUM for 3-MEDIUM, LOW otherwise.
* Batch     = distinct (l_partkey, l_suppkey) of lineitem; product = p_name;
              FAILED when any of its lines has l_returnflag 'R', else PASSED.
* Supplier  = supplier (+ nation name as country); risk HIGH below an
              account balance of 1000, MEDIUM below 5000, else LOW.
* Warehouse = nation; a batch is stored in nation (l_partkey mod 25).
* CONTAINS  = distinct (l_orderkey, l_partkey, l_suppkey).

All joins are left to the planner and adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegraph.functions.exprs import py_str
from lakegraph.operators.graph import build_edges, project_nodes
from lakegraph.operators.match import SupplyGraph, pattern_3hop
from lakegraph.session import shared_dir
from lakegraph.sources.fixtures import supply_tables
from lakegraph.sources.testdata import Tables

BATCH_KEY = ["batch_part", "batch_supp"]
N_WAREHOUSES = 25
BUCKET_ROWS = 1 << 20                   # edges a bucket of a stored graph holds, about


def fixture_graph(spark: SparkSession, tables: dict[str, DataFrame] | None = None,
                  chained: bool = False) -> SupplyGraph:
    """The demo graph. Edge types are built independently; ``chained=True``
    instead drops the supplier edge of a batch whose warehouse is missing, as
    a load statement that matches the warehouse before the supplier does."""
    t = tables or supply_tables(spark)
    sup, wh, bat, ords = t["suppliers"], t["warehouses"], t["batches"], t["orders"]
    suppliers = project_nodes(sup, ["supplier_id"], {"name": "name", "country": "country",
                                                     "risk_tier": "risk_tier",
                                                     "active_deliveries": "active_deliveries"})
    warehouses = project_nodes(wh, ["warehouse_id"], {"location": "location", "region": "region",
                                                      "capacity": "capacity"})
    batches = project_nodes(bat, ["batch_id"], {
        "product": "product", "quality_status": "quality_status",
        "description": description(F.col("product"), F.col("batch_id"), F.col("quality_status"), F.col("supplier_id"))})
    orders = project_nodes(ords, ["order_id"], {"customer": "customer", "status": "status",
                                                "priority": "priority", "order_date": "order_date"})
    return SupplyGraph(
        orders=orders, batches=batches, suppliers=suppliers, warehouses=warehouses,
        contains=build_edges(ords, ["order_id"], ["batch_id"], batches, ["batch_id"]),
        made_by=build_edges(bat.join(warehouses.select("warehouse_id"), "warehouse_id", "left_semi")
                            if chained else bat,
                            ["batch_id"], ["supplier_id"], suppliers, ["supplier_id"]),
        stored_in=build_edges(bat, ["batch_id"], ["warehouse_id"], warehouses, ["warehouse_id"]),
        batch_key=["batch_id"])


def description(product, batch_id, status, supplier_id):
    """The stored batch text; a missing part prints ``None``."""
    return F.concat(py_str(product), F.lit(" batch "), py_str(batch_id), F.lit(" quality "), py_str(status),
                    F.lit(" supplier "), py_str(supplier_id))


def order_status(c):
    return (F.when(c == "P", "DELAYED").when(c == "F", "SHIPPED")
             .when(c == "O", "PENDING").otherwise(c))


def order_priority(c):
    return (F.when(c.isin("1-URGENT", "2-HIGH"), "HIGH").when(c == "3-MEDIUM", "MEDIUM")
             .otherwise("LOW"))


def risk_tier(acctbal, high_below: float = 1000.0, medium_below: float = 5000.0):
    return (F.when(acctbal < high_below, "HIGH").when(acctbal < medium_below, "MEDIUM")
             .otherwise("LOW"))


def batch_id_text(part, supp):
    return F.concat_ws("-", part.cast("string"), supp.cast("string"))


def tables_graph(spark: SparkSession, sf_dir: str) -> SupplyGraph:
    t = Tables(spark, sf_dir)
    li = t.lineitem

    # the order columns, raw codes kept next to the derived values so that a
    # filter can be written on the stored column (and pushed to the scan)
    order_rows = t.orders.select(F.col("o_orderkey").alias("order_id"), "o_custkey",
                                 order_status(F.col("o_orderstatus")).alias("status"),
                                 order_priority(F.col("o_orderpriority")).alias("priority"),
                                 F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
                                 "o_orderstatus", "o_orderpriority")
    orders = (order_rows.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
              .select("order_id", F.col("c_name").alias("customer"), "status", "priority",
                      "order_date", "o_orderstatus", "o_orderpriority"))

    # one row per batch; partial aggregation collapses hot batches map-side
    batch_agg = (li.groupBy(F.col("l_partkey").alias("batch_part"),
                            F.col("l_suppkey").alias("batch_supp"))
                   .agg(F.max(F.col("l_returnflag") == "R").alias("failed")))
    part = t.part.select(F.col("p_partkey").alias("batch_part"), F.col("p_name").alias("product"))
    qs = F.when(F.col("failed"), "FAILED").otherwise("PASSED")
    # batch nodes carry their one-to-one references (like the source batch
    # table), so the MANUFACTURED_BY / STORED_IN edges need no second pass
    batches = (batch_agg.join(part, "batch_part", "left")
               .select(*BATCH_KEY, "product", qs.alias("quality_status"),
                       description(F.col("product"), batch_id_text(F.col("batch_part"), F.col("batch_supp")), qs,
                                   F.col("batch_supp")).alias("description"),
                       F.col("batch_supp").alias("supplier_id"),
                       F.pmod(F.col("batch_part"), F.lit(N_WAREHOUSES)).alias("warehouse_id")))

    suppliers = (t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
                 .select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("name"),
                         F.col("n_name").alias("country"),
                         risk_tier(F.col("s_acctbal")).alias("risk_tier")))
    warehouses = (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
                  .select(F.col("n_nationkey").cast("long").alias("warehouse_id"),
                          F.col("n_name").alias("location"), F.col("r_name").alias("region")))

    contains_rows = li.select(F.col("l_orderkey").alias("order_id"),
                              F.col("l_partkey").alias("batch_part"),
                              F.col("l_suppkey").alias("batch_supp"))
    # every batch is derived from lineitem, so the target always exists; the
    # edge set only needs de-duplication (MERGE creates one edge per pair)
    contains = contains_rows.distinct()
    # the to-one edges and the batch count only need the keys, not the part
    # join that names the product
    batch_refs = batch_agg.select(*BATCH_KEY, F.col("batch_supp").alias("supplier_id"),
                                  F.pmod(F.col("batch_part"), F.lit(N_WAREHOUSES)).alias("warehouse_id"),
                                  qs.alias("quality_status"))
    made_by = build_edges(batch_refs, BATCH_KEY, ["supplier_id"], suppliers, ["supplier_id"],
                          dedupe=False)
    stored_in = build_edges(batch_refs, BATCH_KEY, ["warehouse_id"], warehouses,
                            ["warehouse_id"], dedupe=False)
    return SupplyGraph(orders=orders, batches=batches, suppliers=suppliers,
                       warehouses=warehouses, contains=contains, made_by=made_by,
                       stored_in=stored_in, batch_key=list(BATCH_KEY),
                       contains_rows=contains_rows, batch_keys=batch_refs,
                       batch_rows=li.select(F.col("l_partkey").alias("batch_part"), F.col("l_suppkey").alias("batch_supp"),
                                            F.col("l_suppkey").alias("supplier_id"),
                                            F.pmod(F.col("l_partkey"), F.lit(N_WAREHOUSES)).alias("warehouse_id"), "l_returnflag"),
                       supplier_rows=t.supplier.select(F.col("s_suppkey").alias("supplier_id"), "s_acctbal"),
                       products=part,
                       order_keys=t.orders.select(F.col("o_orderkey").alias("order_id")),
                       order_rows=order_rows)


def high_delayed():
    return (F.col("priority") == "HIGH") & (F.col("status") == "DELAYED")


def high_delayed_codes():
    """``high_delayed`` on the stored order codes of the tables (status P,
    priority 1-URGENT or 2-HIGH): the same rows, as a filter Parquet can
    push down and Spark can turn into a runtime Bloom filter."""
    return (F.col("o_orderstatus") == "P") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")


def failed():
    return F.col("quality_status") == "FAILED"


def high_risk():
    return F.col("risk_tier") == "HIGH"


def exact_answer(g: SupplyGraph) -> DataFrame:
    """The flagship question over the tables: its predicates on the derived
    values, and the same ones on the stored columns, which reach the scans."""
    return pattern_3hop(g, high_delayed_codes(), failed(), high_risk(),
                        any_row_pred=F.col("l_returnflag") == "R", supplier_row_pred=F.col("s_acctbal") < 1000.0)


def node_sources(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, list[str]]]:
    """The rows each label's nodes come from, and their key, before merging."""
    t = Tables(spark, sf_dir)
    return {"Batch": (t.lineitem, ["l_partkey", "l_suppkey"]), "Order": (t.orders, ["o_orderkey"]),
            "Supplier": (t.supplier, ["s_suppkey"]), "Warehouse": (t.nation, ["n_nationkey"])}


def demo_sources(spark: SparkSession) -> dict[str, tuple[DataFrame, list[str]]]:
    t = supply_tables(spark)
    return {"Batch": (t["batches"], ["batch_id"]), "Order": (t["orders"], ["order_id"]),
            "Supplier": (t["suppliers"], ["supplier_id"]), "Warehouse": (t["warehouses"], ["warehouse_id"])}


def stored_graph(spark: SparkSession, paths: dict[str, str], batch_key: list[str]) -> SupplyGraph:
    """The graph over saved node and edge tables (``nodes_<label>``,
    ``edges_<type>``)."""
    read = lambda name: spark.read.parquet(paths[name])
    batches = read("nodes_Batch")
    return SupplyGraph(orders=read("nodes_Order"), batches=batches, suppliers=read("nodes_Supplier"),
                       warehouses=read("nodes_Warehouse"), contains=read("edges_CONTAINS"),
                       made_by=read("edges_MANUFACTURED_BY"), stored_in=read("edges_STORED_IN"),
                       batch_key=batch_key, batch_keys=batches)


def bucketed_graph(g: SupplyGraph, name: str, buckets: int) -> SupplyGraph:
    """The graph over catalog tables in the shared folder. Orders and their
    CONTAINS edges are bucketed and sorted by order, so walking from an order to
    its batches needs no shuffle; an order has few lines, while a batch may be in a
    third of all orders, so edges are not bucketed by batch: that join deals the
    rows anew, and adaptive execution may split a hot batch. ``buckets`` is the least
    number: it grows with the edges, so that writing and walking sort a bucket in
    memory at any size. Edges are dealt by order once and made distinct there, unless
    the session wants all keys hashed for that. Column statistics are collected for
    the planner."""
    spark = g.orders.sparkSession
    lines = g.contains if g.contains_rows is None else g.contains_rows
    buckets = max(buckets, -(-lines.count() // BUCKET_ROWS))
    all_keys = spark.conf.get("spark.sql.requireAllClusterKeysForDistribution", "false").lower() == "true"
    frames = {"orders": g.orders, "contains": g.contains, "batches": g.batches, "suppliers": g.suppliers, "warehouses": g.warehouses}
    made = {}
    for part, frame in frames.items():
        table = f"{name}_{part}"
        if part in ("orders", "contains"):              # one file per bucket: the shuffle deals like the buckets
            if part == "contains" and g.contains_rows is not None and not all_keys:
                dealt = g.contains_rows.repartition(buckets, "order_id").distinct()
            else:
                dealt = frame.repartition(buckets, "order_id")
            writer = dealt.write.bucketBy(buckets, "order_id").sortBy("order_id")
        else:
            writer = frame.write
        writer.mode("overwrite").option("path", shared_dir(spark, table)).saveAsTable(table)
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
        made[part] = spark.table(table)
    return SupplyGraph(**made, made_by=made["batches"].select(*g.batch_key, "supplier_id"), stored_in=made["batches"].select(*g.batch_key, "warehouse_id"),
                       batch_key=g.batch_key, batch_keys=made["batches"])


def merged_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four labels merged by key from rows that repeat it (every line
    names its order, batch, supplier and warehouse): label, id, properties."""
    t = Tables(spark, sf_dir)
    g = tables_graph(spark, sf_dir)
    lines = t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("supplier_id"),
                              F.pmod(F.col("l_partkey"), F.lit(N_WAREHOUSES)).alias("warehouse_id"))
    # a line's keys are made distinct before they meet the wide rows
    def of(nodes, key):
        return nodes.join(lines.select(key).distinct(), key, "left_semi")

    sources = {"Order": (of(g.orders, "order_id"), ["order_id"], ["customer", "status", "priority", "order_date"]),
               "Supplier": (of(g.suppliers, "supplier_id"), ["supplier_id"], ["name", "country", "risk_tier"]),
               "Warehouse": (of(g.warehouses, "warehouse_id"), ["warehouse_id"], ["location", "region"]),
               "Batch": (g.batches.withColumn("batch", batch_id_text(F.col("batch_part"), F.col("batch_supp"))), ["batch"],
                         ["product", "quality_status", "description"])}
    out = None
    for label, (rows, key, props) in sources.items():
        nodes = project_nodes(rows, key, {p: p for p in props})
        text = F.concat_ws("|", *[F.concat(F.lit(f"{p}="), py_str(p)) for p in props])
        part = nodes.select(F.lit(label).alias("label"), F.col(key[0]).cast("string").alias("id"), text.alias("properties"))
        out = part if out is None else out.unionByName(part)
    return out


def edge_list(g: SupplyGraph) -> DataFrame:
    """All edges as (edge_type, src_id, dst_id) text ids; a batch id is 'part-supplier'."""
    bid = batch_id_text(F.col("batch_part"), F.col("batch_supp"))
    return (g.contains.select(F.lit("CONTAINS").alias("edge_type"),
                              F.col("order_id").cast("string").alias("src_id"), bid.alias("dst_id"))
            .unionByName(g.made_by.select(F.lit("MANUFACTURED_BY").alias("edge_type"),
                                          bid.alias("src_id"),
                                          F.col("supplier_id").cast("string").alias("dst_id")))
            .unionByName(g.stored_in.select(F.lit("STORED_IN").alias("edge_type"),
                                            bid.alias("src_id"),
                                            F.col("warehouse_id").cast("string").alias("dst_id"))))
