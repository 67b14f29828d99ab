"""Tables that are kept and brought up to date instead of being made anew.

``StoredNodes`` holds one row per key, partitioned by a bucket of the key. A
merge reads and writes only the buckets that its updates fall into: the merged
rows are staged first, then the buckets in which something changed are replaced
(dynamic partition overwrite). Files of other buckets keep their names, and a
merge that is run again, after a failure too, changes nothing more.

``KeptAverages`` holds sums and counts per group and load. A new load adds its own
states only; loading the same load again replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegraph.operators.graph import upsert
from lakegraph.session import shared_dir

BUCKET = "key_bucket"


@dataclass
class StoredNodes:
    spark: SparkSession
    path: str
    key: list[str]
    buckets: int
    columns: list[str]

    @classmethod
    def create(cls, df: DataFrame, key: list[str], path: str, buckets: int) -> StoredNodes:
        """Write ``df`` (one row per key). A bucket should hold some hundred
        megabytes; ``buckets`` bounds what the driver ever sees of the table."""
        made = cls(df.sparkSession, path, key, buckets, df.columns)
        made._bucketed(df).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
        return made

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))

    @property
    def rows(self) -> DataFrame:
        return self._stored().drop(BUCKET)

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def merge(self, updates: DataFrame, columns: list[str] | None = None) -> list[int]:
        """Merge by key (``graph.upsert``) and return the buckets replaced. A
        null key makes no node."""
        updates = updates.filter(~F.greatest(*[F.col(k).isNull() for k in self.key], F.lit(False)))
        touched = [r[0] for r in self._bucketed(updates).select(BUCKET).distinct().collect()]      # at most ``buckets`` numbers
        if not touched:
            return []
        base = self._stored().filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
        own = [c for c in self.columns if c not in self.key]
        merged = upsert(base.withColumn("__old", F.struct(*own)), updates, self.key, columns or own, change_col="__change")
        changed = (F.col("__change") == "insert") | ~F.struct(*own).eqNullSafe(F.col("__old"))
        staged = shared_dir(self.spark, "merge")
        self._bucketed(merged.withColumn("__changed", changed).drop("__old", "__change")).write.partitionBy(BUCKET).parquet(staged)
        made = self.spark.read.parquet(staged)
        replaced = sorted(r[0] for r in made.filter("__changed").select(BUCKET).distinct().collect())
        if replaced:
            made.filter(F.col(BUCKET).isin(replaced)).drop("__changed").select(*self.columns, BUCKET).hint("rebalance", BUCKET) \
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)
        return replaced


@dataclass
class KeptAverages:
    """States (group columns, total, n) by load, under ``path``."""
    spark: SparkSession
    path: str
    groups: dict[str, Column]
    value: str

    def load(self, name: str, rows: DataFrame) -> None:
        """Add the states of these rows, or replace those of an earlier load of
        that name. Rows without a value count in no average."""
        states = rows.filter(F.col(self.value).isNotNull()).groupBy(*[c.alias(n) for n, c in self.groups.items()]) \
            .agg(F.sum(self.value).alias("total"), F.count(F.lit(1)).alias("n"))
        states.withColumn("load", F.lit(name)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("load").parquet(self.path)

    def averages(self, name: str = "average") -> DataFrame:
        """The average of each group over all loads, from the states alone."""
        return self.spark.read.parquet(self.path).groupBy(*self.groups).agg((F.sum("total") / F.sum("n")).alias(name))
