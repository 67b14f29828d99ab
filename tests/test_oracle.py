"""Every registered job against its SQL twin on the smallest table folder."""

import pytest

import __spark_entry__ as entry
from places import SF_SMALL
from lakegraph.plans import catalog
from oracle_compare import compare, duck

JOBS = catalog.JOBS
SQLS = catalog.SQL
# approximate by design; each has a checked twin of its exact facts
FACTS = {"quantiles_approx": "quantiles_approx_ranks", "knn_lsh": "knn_approx_facts", "text_vectors": "text_tokens"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_job_has_a_twin_or_a_checked_fact():
    assert set(JOBS) - set(SQLS) == set(FACTS) and set(FACTS.values()) <= set(SQLS) <= set(JOBS)
    assert set(JOBS) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(JOBS))
def test_job(spark, con, name):
    df = JOBS[name](spark, SF_SMALL)
    if name not in SQLS:
        fact = FACTS[name]
        df, name = JOBS[fact](spark, SF_SMALL), fact
    r = compare(df, con, SQLS[name])
    assert r["ok"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 51
    assert df.columns == ["oid", "cust", "batch_part", "batch_supp", "prod", "sup_name", "risk", "warehouse"]
