import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from lakegraph.session import get_spark
    # tests run without a cluster, so they name their own checkpoint folder
    ckpt = tempfile.mkdtemp(prefix="lakegraph-test-ckpt-")
    s = get_spark("local[4]", app="lakegraph-tests", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fixture_graph(spark):
    from lakegraph.plans.supply_graph import fixture_graph as fg
    return fg(spark)
