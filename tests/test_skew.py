"""Hot keys: one (order, part, supplier) triple holds a third of all lineitem
rows. Jobs run with the cluster settings of ``scale_conf`` (AQE skew split
forced, all clustering keys hashed) scaled down so that skew handling really
triggers on small files, and must still equal the SQL twins."""

import os
import shutil

import duckdb
import pytest

from places import SF_SMALL
from lakegraph.plans import catalog
from oracle_compare import compare, duck
from lakegraph.session import scale_conf, shared_dir

SKEW_JOBS = ["pattern_3hop", "seeded_expand", "expand_inner", "graph_edge_counts", "build_edges",
             "key_violations", "group_count", "quantiles_exact", "dangling_refs", "avg_of_avg",
             "multi_filter", "retrieval_eval"]


@pytest.fixture(scope="module")
def skewed_dir(spark):
    d = shared_dir(spark, "skewed_tables")
    os.makedirs(d)
    for f in os.listdir(SF_SMALL):
        if f != "lineitem.parquet":
            shutil.copy(os.path.join(SF_SMALL, f), os.path.join(d, f))
    con = duckdb.connect()
    src = os.path.join(SF_SMALL, "lineitem.parquet")
    n = con.execute(f"SELECT count(*) FROM '{src}'").fetchone()[0]
    # the hot row: an urgent pending order, a failed batch, a high-risk supplier
    con.execute(f"""
        COPY (
          SELECT * FROM '{src}'
          UNION ALL
          SELECT h.* FROM (
            SELECT l.* FROM '{src}' l
            JOIN '{SF_SMALL}/orders.parquet' o ON o.o_orderkey = l.l_orderkey
            JOIN '{SF_SMALL}/supplier.parquet' s ON s.s_suppkey = l.l_suppkey
            WHERE o.o_orderstatus = 'P' AND o.o_orderpriority = '1-URGENT'
              AND l.l_returnflag = 'R' AND s.s_acctbal < 1000
            ORDER BY l.l_orderkey, l.l_linenumber LIMIT 1) h, range({n // 2})
        ) TO '{d}/lineitem.parquet' (FORMAT PARQUET, ROW_GROUP_SIZE 2048)""")
    return d


@pytest.fixture(scope="module")
def skew_session(spark):
    conf = scale_conf(10 ** 9)
    conf.update({"spark.sql.shuffle.partitions": "16",
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
                 "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.autoBroadcastJoinThreshold": "-1"})
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_skewed_input_is_skewed(skewed_dir):
    con = duckdb.connect()
    top, total = con.execute(f"""
        SELECT max(c), sum(c) FROM (SELECT count(*) c FROM '{skewed_dir}/lineitem.parquet'
                                    GROUP BY l_orderkey, l_partkey, l_suppkey)""").fetchone()
    assert top * 3 >= total


@pytest.mark.parametrize("name", SKEW_JOBS)
def test_job_correct_under_skew(skew_session, skewed_dir, name):
    df = catalog.JOBS[name](skew_session, skewed_dir)
    r = compare(df, duck(skewed_dir), catalog.SQL[name])
    assert r["ok"], r


@pytest.mark.parametrize("name", ["seeded_expand", "pattern_3hop", "merged_nodes"])
def test_hot_batch_with_default_settings(spark, skewed_dir, name):
    r = compare(catalog.JOBS[name](spark, skewed_dir), duck(skewed_dir), catalog.SQL[name])
    assert r["ok"], r
