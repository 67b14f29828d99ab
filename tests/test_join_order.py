"""Join order from statistics: over analysed tables the planner walks the
selective leg first, whatever the order in which the joins are written."""

import re

import pytest
from pyspark.sql import functions as F

from lakegraph.operators import match
from lakegraph.plans import supply_graph as sg
from lakegraph.session import cbo_conf
from places import SF_SMALL


@pytest.fixture(scope="module")
def stored(spark):
    return sg.bucketed_graph(sg.tables_graph(spark, SF_SMALL), "join_order", 4)


@pytest.fixture
def cbo(spark):
    old = {k: spark.conf.get(k, None) for k in cbo_conf()}
    for k, v in cbo_conf().items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _legs(df):
    """Tables in the order in which the optimised plan joins them."""
    return re.findall(r"Relation \S*join_order_(\w+)", df._jdf.queryExecution().optimizedPlan().toString())


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()))


def test_selective_leg_comes_first(spark, stored, cbo):
    by_order = match.pattern_paths(stored, order_pred=F.col("order_id") <= 5)
    by_batch = match.pattern_paths(stored, batch_pred=F.col("batch_part") <= 2)
    order_first, batch_first = _legs(by_order), _legs(by_batch)
    assert order_first.index("orders") < order_first.index("batches")
    assert batch_first[0] == "batches" and batch_first[-1] == "orders"


def test_same_rows_in_any_order(spark, stored, cbo):
    preds = (F.col("priority") == "HIGH", sg.failed(), sg.high_risk())
    got = _rows(match.pattern_paths(stored, *preds))
    assert got and got == _rows(match.pattern_3hop(stored, *preds))


def test_no_match_and_no_predicate(spark, stored, cbo):
    assert match.pattern_paths(stored, order_pred=F.lit(False)).count() == 0
    assert match.pattern_paths(stored).count() == match.pattern_3hop(stored).count()
