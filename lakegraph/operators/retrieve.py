"""Retrieval outputs: hit lines and context text, vector-seeded graph
expansion, formatted result items, and prompt rows.

Group-level text (the context of one question) is only ever built from the
k hits of that question, so no group grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakegraph.functions.exprs import fixed3, ordered_join, py_str
from lakegraph.operators.match import SupplyGraph, seeded_expand
from lakegraph.session import shared_dir

# The prompt texts of the demo.
SYSTEM_PROMPT = ("Pharma supply chain analyst. Answer ONLY from context provided. "
                 "Never invent data.")
QUESTION = ("Which HIGH-priority orders are DELAYED because their batch FAILED quality checks "
            "AND was manufactured by a HIGH-risk supplier? Which warehouse holds the batch?")


def hit_line(id_col: str | Column, name_col: str | Column, attr_label: str,
             attr_col: str | Column) -> Column:
    """``id + ' | ' + name + ' | <attr_label>: ' + attr`` (null if any part is null)."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.concat(c(id_col).cast("string"), F.lit(" | "), c(name_col),
                    F.lit(f" | {attr_label}: "), c(attr_col))


def vector_context(hits: DataFrame, line_col: str = "ctx", score_col: str = "score",
                   rank_col: str = "rank", qid_col: str = "query_id") -> DataFrame:
    """One context text per query: ``- <line> (score: 0.123)`` per hit, in
    rank order, joined by newlines. Groups hold the k hits of a query."""
    item = F.concat(F.lit("- "), py_str(line_col), F.lit(" (score: "), fixed3(score_col),
                    F.lit(")"))
    return hits.groupBy(qid_col).agg(ordered_join(item, rank_col).alias("context"),
                                     F.count(F.lit(1)).alias("n_hits"))


def vector_graph_retrieve(seeds: DataFrame, g: SupplyGraph, qid_col: str = "query_id",
                          carry: list[str] | None = None) -> DataFrame:
    """Vector hits as seed batches, expanded through the graph (no WHERE:
    every order of a seed, with optional supplier and warehouse)."""
    keep = [qid_col] + (carry or [])
    return seeded_expand(seeds, g, keep=keep)


def item_content(batch_id: Column) -> Column:
    """The formatted item text; nulls print as ``None`` as in an f-string."""
    s = py_str
    return F.concat(
        F.lit("Order "), s("order_id"), F.lit(" ("), s("customer"), F.lit(", "), s("status"),
        F.lit(", priority:"), s("priority"), F.lit(") | Batch "), s(batch_id), F.lit(" ("),
        s("product"), F.lit(") | quality: "), s("quality_status"), F.lit(" | supplier: "),
        s("supplier_name"), F.lit(" [risk:"), s("supplier_risk"), F.lit("] | warehouse: "),
        s("warehouse_location"))


def retrieval_items(expanded: DataFrame, batch_id: Column, keep: list[str] | None = None) -> DataFrame:
    """Result items: ``content`` text and ``metadata`` map {'order_id': ...}."""
    return expanded.select(*(keep or []), item_content(batch_id).alias("content"),
                           F.create_map(F.lit("order_id"),
                                        F.col("order_id").cast("string")).alias("metadata"))


def prompt_table(contexts: DataFrame, question: Column | str = QUESTION,
                 qid_col: str = "query_id") -> DataFrame:
    """One prompt row per question: system text and user text."""
    q = F.lit(question) if isinstance(question, str) else question
    return contexts.select(qid_col, F.lit(SYSTEM_PROMPT).alias("system_prompt"),
                           F.concat(F.lit("Context:\n"), F.col("context"), F.lit("\n\nQuestion: "),
                                    q).alias("user_prompt"))


def prompt_parts(items: DataFrame, order: list[str], content: str, most: int, question: str = QUESTION, qid_col: str = "query_id") -> DataFrame:
    """(question id, part, n_items, system_prompt, user_prompt): a question's
    items, in order, cut into parts of about ``most`` characters; every item is
    in one part.

    A part is the item's place in the question's text, so running sums are needed.
    They are taken in two levels: rows are dealt by range of question and order,
    summed within a range, and the ranges' totals are summed per question, so a
    question with most of the items is worked by many tasks."""
    spark = items.sparkSession
    dealt = items.select(qid_col, *order, F.col(content).alias("__text")).repartitionByRange(qid_col, *order).withColumn("__range", F.spark_partition_id())
    dealt.write.parquet(path := shared_dir(spark, "prompt-items"))
    dealt = spark.read.schema(dealt.schema).parquet(path).withColumn("__n", F.length("__text").cast("long"))
    inner = Window.partitionBy(qid_col, "__range").orderBy(*order)
    outer = Window.partitionBy(qid_col).orderBy("__range")
    before = dealt.groupBy(qid_col, "__range").agg(F.sum("__n").alias("__all")) \
        .select(qid_col, "__range", (F.sum("__all").over(outer) - F.col("__all")).alias("__before"))
    placed = dealt.withColumn("__at", F.sum("__n").over(inner) - F.col("__n")).join(before, [qid_col, "__range"]) \
        .withColumn("part", F.floor((F.col("__before") + F.col("__at")) / F.lit(most)))
    lines = F.sort_array(F.collect_list(F.struct(*order, F.concat(F.lit("- "), F.col("__text")).alias("line"))))
    return placed.groupBy(qid_col, "part").agg(lines.alias("__lines"), F.count(F.lit(1)).alias("n_items")).select(
        qid_col, "part", "n_items", F.lit(SYSTEM_PROMPT).alias("system_prompt"),
        F.concat(F.lit("Context:\n"), F.array_join("__lines.line", "\n"), F.lit("\n\nQuestion: "), F.lit(question)).alias("user_prompt"))
