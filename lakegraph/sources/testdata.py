"""Loader for the driver's Parquet tables (``<sf_dir>/<name>.parquet``)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a DataFrame; the resolved scan is reused per session, so
    file listing and footer reads happen once, not once per job."""
    cache = spark.__dict__.setdefault("_lakegraph_scans", {})
    path = table_path(sf_dir, name)
    if path not in cache:
        cache[path] = spark.read.parquet(path)
    return cache[path]


class Tables:
    """Attribute access to the testdata tables: ``Tables(spark, d).lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return table(self.spark, self.sf_dir, name)
