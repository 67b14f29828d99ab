"""Plan shape: no cartesian products anywhere, no Python in the plans
except the vector search's Arrow batches, filters and pruning at the scan."""

import pytest

from places import SF_SMALL
from lakegraph.plans import catalog

JOBS = catalog.JOBS
PYTHON_OK = {"knn_exact", "knn_lsh", "knn_approx_facts", "vector_context", "prompt_table", "vector_graph_retrieve",
             "retrieval_items", "graph_prompts", "retrieval_eval", "knn_index_exact", "knn_index_recall"}
# driver fetches whose size a parameter bounds: code books, cells and their sizes; key buckets; one row of bounds
BOUNDED_FETCHES = {"vector_index.py": 4, "stored.py": 2, "profile.py": 1}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(JOBS))
def test_no_cartesian_no_row_udf(spark, name):
    p = _plan(JOBS[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p                  # never row-at-a-time Python
    if name not in PYTHON_OK:
        assert "MapInPandas" not in p and "ArrowEvalPython" not in p and "InArrow" not in p


def test_pushdown_and_pruning(spark):
    p = _plan(JOBS["multi_filter"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_returnflag:string>" in p
    p2 = _plan(JOBS["project_columns"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double>" in p2


def test_flagship_filters_reach_the_scans(spark):
    p = _plan(JOBS["pattern_3hop"](spark, SF_SMALL))
    assert "EqualTo(l_returnflag,R)" in p and "LessThan(s_acctbal,1000.0)" in p
    assert "bool_or" not in p and "max((l_returnflag" not in p        # no aggregate over all lines


def test_no_driver_fetch_in_operators():
    import pathlib
    import lakegraph.operators
    for f in pathlib.Path(lakegraph.operators.__file__).parent.glob("*.py"):
        text = f.read_text()
        assert text.count(".collect(") + text.count(".first(") == BOUNDED_FETCHES.get(f.name, 0), f.name
        assert "broadcast(" not in text, f.name


def test_knn_top_k_is_limited_before_the_shuffle(spark):
    p = _plan(JOBS["knn_exact"](spark, SF_SMALL))
    assert p.count("WindowGroupLimit") >= 2          # partial (map side) + final


def test_flagship_gets_runtime_bloom_filter_under_cluster_settings(spark):
    from lakegraph.session import scale_conf
    conf = scale_conf(10 ** 9)
    conf.update({"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1KB",
                 "spark.sql.autoBroadcastJoinThreshold": "-1"})
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = JOBS["pattern_3hop"](spark, SF_SMALL)
        opt = df._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in opt and "l_orderkey" in opt.split("might_contain", 1)[1][:200]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
