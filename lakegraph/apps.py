"""The two end-to-end runs, as Spark applications writing their tables.

    python -m lakegraph.apps trips --tables DIR --out DIR
    python -m lakegraph.apps graph --tables DIR --out DIR [--demo]

``trips``: ingest the raw trips, write them; reload, count rejects, cleanse,
write; profile (counts, coverage, statistics, quantiles, histogram, density,
correlation); monthly average; per-location average joined to the zone lookup
CSV, the feature table and the zone average. ``graph``: node and edge tables
(full replace), key and reference reports, structure counts, vector audit,
vector-only context and prompts, vector-seeded graph expansion items, the
exact 3-hop answer, and the evaluation of both retrievals against it.

Every output is a Parquet table under ``--out`` (one folder per table); all
profiles are small result tables, never values fetched to the driver.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegraph.operators import aggregate as agg
from lakegraph.operators import cleanse, evaluate, graph, match, profile, retrieve, vectors
from lakegraph.plans import supply_graph as sg
from lakegraph.plans import trips as tr
from lakegraph.session import get_spark
from lakegraph.sources import io
from lakegraph.sources.testdata import Tables


def _save(df: DataFrame, out: str, name: str) -> str:
    path = os.path.join(out, name)
    io.write_table(df, path=path)
    return path


def run_trips(spark: SparkSession, tables: str, out: str, lookup_csv: str | None = None) -> dict:
    written = {}
    raw = tr.trips(spark, tables)
    written["trips_raw"] = _save(raw, out, "trips_raw")
    trips = spark.read.parquet(written["trips_raw"])
    written["rejected"] = _save(cleanse.rejected_count(trips, tr.VALID), out, "rejected")
    clean = cleanse.cleanse(trips, tr.VALID, flag_col=tr.FLAG, flag_true=tr.FLAG_TRUE,
                            timestamp_cols=[tr.PICKUP, tr.DROPOFF])
    written["trips_cleansed"] = _save(clean, out, "trips_cleansed")
    c = spark.read.parquet(written["trips_cleansed"])
    prof = {
        "profile_rows": profile.row_count(c),
        "profile_schema": profile.schema_profile(c, approx_distinct=True),
        "profile_vendor_counts": profile.group_count(c, F.col(tr.VENDOR)),
        "profile_coverage": profile.min_max(c, tr.PICKUP, "oldest_day", "latest_day"),
        "profile_daily": profile.daily_counts(c, tr.PICKUP),
        "profile_fare_range": profile.min_max(c, tr.FARE),
        "profile_fare_stats": profile.describe_typed(c, tr.FARE),
        "profile_fare_quantiles": profile.quantiles_approx(c, tr.FARE, [0.1, 0.25, 0.5, 0.75, 0.9]),
        "profile_fare_histogram": profile.histogram(c, tr.FARE, 50),
        "profile_distance_fare_density": profile.density_2d(c, tr.DIST, tr.FARE, 20),
        "profile_distance_fare_corr": profile.correlation(c, tr.DIST, tr.FARE),
    }
    for name, df in prof.items():
        written[name] = _save(df, out, name)
    written["average_fare_per_month"] = _save(agg.monthly_average(c, tr.PICKUP, tr.FARE), out,
                                              "average_fare_per_month")
    if lookup_csv is None:                    # derive the lookup file from the tables
        lookup_csv = os.path.join(out, "zone_lookup_csv")
        io.write_csv(tr.zone_lookup(spark, tables), lookup_csv)
    lookup = io.read_csv_strings(spark, lookup_csv, ["LocationID", "Borough", "Zone", "service_zone"])
    by_loc = agg.avg_by_key(c, tr.LOC, tr.FARE)
    joined = agg.join_lookup(by_loc, tr.LOC, lookup, "LocationID")
    written["fare_by_location"] = _save(joined, out, "fare_by_location")
    feats = agg.feature_table(spark.read.parquet(written["fare_by_location"]))
    written["features"] = _save(feats, out, "features")
    written["fare_by_zone"] = _save(agg.avg_of_avg(feats), out, "fare_by_zone")
    return written


def run_graph(spark: SparkSession, tables: str | None, out: str, k: int = 5,
              k_context: int = 3) -> dict:
    written = {}
    g = sg.fixture_graph(spark) if tables is None else sg.tables_graph(spark, tables)
    pg = g.property_graph()
    for label, frame in pg.nodes.items():
        written[f"nodes_{label}"] = _save(frame, out, f"nodes_{label}")
    for etype, e in pg.edges.items():
        written[f"edges_{etype}"] = _save(e.frame, out, f"edges_{etype}")
    g = sg.stored_graph(spark, written, g.batch_key)        # from here on the saved tables are read
    pg = g.property_graph()
    written["node_counts"] = _save(graph.node_counts(pg), out, "node_counts")
    written["edge_counts"] = _save(graph.edge_counts(pg), out, "edge_counts")
    sources = sg.demo_sources(spark) if tables is None else sg.node_sources(spark, tables)
    written["key_report"] = _save(graph.label_key_report(sources), out, "key_report")
    truth = match.pattern_3hop(g, sg.high_delayed(), sg.failed(), sg.high_risk())
    written["exact_answer"] = _save(truth.orderBy("oid"), out, "exact_answer")
    if tables is None:
        return written
    t = Tables(spark, tables)
    emb = t.embeddings
    written["vector_audit"] = _save(vectors.vector_audit(emb, "embedding", 64), out, "vector_audit")
    questions = vectors.centroids(emb, "label", "embedding")
    hits = vectors.knn_exact(emb, "vec_id", "embedding", questions, "label", "centroid", k, 64)
    written["hits"] = _save(hits, out, "hits")
    hits = spark.read.parquet(written["hits"])
    part = t.part.select(F.col("p_partkey").alias("vec_id"), "p_name", "p_type")
    lines = (hits.filter(F.col("rank") <= k_context).join(part, "vec_id", "left")
                 .withColumn("ctx", retrieve.hit_line("vec_id", "p_name", "type", "p_type")))
    ctx = retrieve.vector_context(lines)
    written["prompts"] = _save(retrieve.prompt_table(ctx), out, "prompts")
    seeds = (hits.select("query_id", F.col("rank").alias("seed_rank"), F.col("vec_id").alias("batch_part"))
                 .join(g.batches, "batch_part"))
    expanded = retrieve.vector_graph_retrieve(seeds, g, carry=["seed_rank"])
    items = retrieve.retrieval_items(expanded, sg.batch_id_text(F.col("batch_part"), F.col("batch_supp")),
                                     keep=["query_id", "seed_rank"])
    written["retrieval_items"] = _save(items, out, "retrieval_items")
    answer = spark.read.parquet(written["exact_answer"])
    items = spark.read.parquet(written["retrieval_items"])
    retrieved = (hits.select("query_id", F.lit("vector").alias("method"), F.col("vec_id").alias("item_id"))
                 .unionByName(items.select("query_id", F.lit("graph").alias("method"),
                                           F.col("metadata")["order_id"].cast("long").alias("item_id"))))
    truth_ids = answer.select(F.inline(F.array(
        F.struct(F.lit("vector").alias("method"), F.col("batch_part").alias("item_id")),
        F.struct(F.lit("graph").alias("method"), F.col("oid").alias("item_id")))))
    asked = questions.select(F.col("label").alias("query_id"), F.explode(F.array(F.lit("vector"), F.lit("graph"))).alias("method"))
    written["retrieval_eval"] = _save(evaluate.retrieval_eval(retrieved, truth_ids, asked), out, "retrieval_eval")
    written["retrieval_missing"] = _save(evaluate.missing_items(retrieved, truth_ids, asked), out, "retrieval_missing")
    return written


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="lakegraph.apps")
    ap.add_argument("app", choices=["trips", "graph"])
    ap.add_argument("--tables", help="folder of <table>.parquet")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--lookup-csv", help="zone lookup CSV (trips); derived from the tables if absent")
    ap.add_argument("--demo", action="store_true", help="graph: use the demo rows instead of tables")
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    spark = get_spark(a.master, app=f"lakegraph-{a.app}")
    if a.app == "trips":
        out = run_trips(spark, a.tables, a.out, a.lookup_csv)
    else:
        out = run_graph(spark, None if a.demo else a.tables, a.out)
    for name, path in out.items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
