"""Session defaults and the cluster-facing helpers every job shares.

* ``get_spark`` builds a session with the settings the jobs assume: UTC,
  adaptive execution, guards against hot keys, ANSI mode, Arrow transfer.
* ``shared_dir`` returns a folder on the storage the cluster names in
  ``spark.checkpoint.dir``; intermediate tables are written there so that a
  lost executor never loses state that lives only on its local disk.
* ``scale_conf`` sizes partitions to the input.

Join strategies are left to the planner and to adaptive execution, which
broadcast by measured size only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a key holding a third of the rows: split skewed joins even where that costs
    # a shuffle, and never reuse a partitioning on a subset of the grouping keys
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
# one machine only: executors elsewhere could not reach a loopback driver
LOCAL_CONF = {
    "spark.driver.host": "127.0.0.1",
    "spark.driver.bindAddress": "127.0.0.1",
}


def get_spark(master: str | None = None, app: str = "lakegraph",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the job defaults.

    On a cluster, leave ``master`` as None so spark-submit decides; the
    shuffle partition count should then be sized to the data (roughly
    input bytes / 128 MB) and AQE coalesces what turns out too small.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if master and is_single_machine(master):
        conf.update(LOCAL_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_single_machine(master: str) -> bool:
    """``local`` and ``local[...]``; ``local-cluster[...]`` has executors with
    disks of their own."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    The location is read from the session (``spark.checkpoint.dir``, or the
    SparkContext checkpoint dir). Only a single-machine session without one
    gets its own temporary folder; elsewhere that is an error, because a
    machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not is_single_machine(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="lakegraph-ckpt-")
        sc.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, *parts, uuid.uuid4().hex)


def cbo_conf() -> dict[str, str]:
    """Settings under which the planner orders inner joins by the statistics of
    analysed tables (``supply_graph.bucketed_graph``)."""
    return {"spark.sql.cbo.enabled": "true", "spark.sql.cbo.joinReorder.enabled": "true"}


MB = 1 << 20


def scale_conf(input_bytes: int, shuffle_fraction: float = 0.25,
               partition_bytes: int = 256 * MB) -> dict[str, str]:
    """Settings sized to the data, for ``get_spark(extra=...)`` on a cluster.

    * scan splits of ``partition_bytes`` (so a 100 TB scan is ~400k tasks);
    * initial shuffle partitions from the expected shuffle volume (the jobs
      shuffle pruned columns, partially aggregated: ``shuffle_fraction`` of
      the input), which AQE then coalesces to ``partition_bytes`` each;
    * skewed partitions (a key with a third of all rows) are split by AQE
      once they exceed 3x the median and ``partition_bytes``;
    * broadcast joins chosen at plan or run time only below 64 MB;
    * an aggregate or de-duplication on (a, b, c) never reuses a partitioning
      on a subset such as (a): a key holding a third of the rows would put
      them all in one task. All keys are hashed instead (partial aggregation
      first), and AQE may split a skewed join even where that costs a shuffle.
    """
    shuffle_parts = int(max(200, input_bytes * shuffle_fraction // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.requireAllClusterKeysForDistribution": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
