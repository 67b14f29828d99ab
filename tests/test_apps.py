"""The two end-to-end applications write every table, and their key outputs
agree with the registered jobs."""

from pyspark.sql import functions as F

from places import SF_SMALL
from lakegraph import apps
from lakegraph.plans import catalog
from lakegraph.session import shared_dir


def test_trips_app(spark):
    out = shared_dir(spark, "app_trips")
    written = apps.run_trips(spark, SF_SMALL, out)
    assert {"trips_cleansed", "average_fare_per_month", "features", "fare_by_zone"} <= set(written)
    r = spark.read.parquet(written["rejected"]).first()
    assert r.n_kept + r.n_rejected == r.n_total
    assert spark.read.parquet(written["trips_cleansed"]).count() == r.n_kept
    assert spark.read.parquet(written["profile_fare_histogram"]).agg(F.sum("count")).first()[0] == r.n_kept
    zones = {x.Zone: x.total_avg for x in spark.read.parquet(written["fare_by_zone"]).collect()}
    assert len(zones) > 0


def test_graph_app_tables(spark):
    out = shared_dir(spark, "app_graph")
    written = apps.run_graph(spark, SF_SMALL, out)
    exact = spark.read.parquet(written["exact_answer"])
    assert exact.count() == catalog.JOBS["pattern_3hop"](spark, SF_SMALL).count() == 51
    ev = spark.read.parquet(written["retrieval_eval"]).collect()
    assert {r.method for r in ev} == {"vector", "graph"}
    assert all(r.n_hits <= r.n_retrieved for r in ev)
    counts = dict(spark.read.parquet(written["edge_counts"]).collect())
    assert set(counts) == {"CONTAINS", "MANUFACTURED_BY", "STORED_IN"}


def test_graph_app_demo(spark):
    out = shared_dir(spark, "app_demo")
    written = apps.run_graph(spark, None, out)
    assert [r.oid for r in spark.read.parquet(written["exact_answer"]).orderBy("oid").collect()] == \
        ["O001", "O002", "O005"]
    assert dict(spark.read.parquet(written["node_counts"]).collect()) == \
        {"Batch": 6, "Order": 7, "Supplier": 4, "Warehouse": 4}
