"""Connected components of a link table, by rounds of label exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegraph.llm import store


def components(links: DataFrame) -> DataFrame:
    """(v, label) of every linked vertex; label is the component's smallest
    vertex. links has columns a and b. Each round takes the smallest label of
    the neighbours, then that label's own label, and is written to the shared
    folder; rounds go on until none changes."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = store.saved(both.filter("a != b").distinct(), "edges")
    labels = store.saved(edges.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("v")).alias("label")), "labels")
    while True:
        near = (edges.join(labels, F.col("b") == F.col("v")).groupBy("a").agg(F.min("label").alias("near")))
        step = labels.join(near, F.col("v") == F.col("a"), "left").select(
            "v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = step.alias("s").join(labels.select(F.col("v").alias("w"), F.col("label").alias("far")), F.col("label") == F.col("w"), "left")
        new = store.saved(jump.select("v", "old", F.least("label", "far").alias("label")), "labels")
        if not new.filter("old != label").limit(1).count():
            return new.select("v", "label")
        labels = new.select("v", "label")
