"""Score retrieved id sets against the exact answer, per question and method."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def retrieval_eval(retrieved: DataFrame, truth: DataFrame, questions: DataFrame, qid_col: str = "query_id",
                   method_col: str = "method", id_col: str = "item_id") -> DataFrame:
    """Precision, recall and missed count of each retrieved set.

    ``retrieved``: (query id, method, item id); ``truth``: (method, item id),
    the exact answer's ids in that method's unit; ``questions``: (query id,
    method), every question asked of every method, so one that retrieved
    nothing keeps its row with recall 0. Both sides are de-duplicated; hits
    are an equi-join on (method, id), relevant counts join back on method.
    """
    r = retrieved.select(qid_col, method_col, id_col).distinct()
    t = truth.select(method_col, id_col).distinct()
    n_rel = t.groupBy(method_col).agg(F.count(F.lit(1)).alias("n_relevant"))
    flagged = r.join(t.withColumn("__hit", F.lit(1)), [method_col, id_col], "left")
    per_q = flagged.groupBy(qid_col, method_col).agg(
        F.count(F.lit(1)).alias("n_retrieved"),
        F.count(F.col("__hit")).alias("n_hits"))
    asked = questions.select(qid_col, method_col).distinct()
    out = asked.join(per_q, [qid_col, method_col], "left").join(n_rel, method_col, "left") \
               .fillna(0, ["n_retrieved", "n_hits", "n_relevant"])
    return out.select(
        qid_col, method_col, "n_retrieved", "n_relevant", "n_hits",
        (F.col("n_relevant") - F.col("n_hits")).alias("n_missing"),
        F.when(F.col("n_retrieved") > 0, F.col("n_hits") / F.col("n_retrieved")).alias("precision"),
        F.when(F.col("n_relevant") > 0, F.col("n_hits") / F.col("n_relevant")).alias("recall"))


def missing_items(retrieved: DataFrame, truth: DataFrame, questions: DataFrame, qid_col: str = "query_id",
                  method_col: str = "method", id_col: str = "item_id") -> DataFrame:
    """(query id, method, item id) of every exact answer a question's
    retrieval left out. The rows are the result; they number questions times
    answers at most."""
    wanted = questions.select(qid_col, method_col).distinct().join(truth.select(method_col, id_col).distinct(), method_col)
    return wanted.join(retrieved.select(qid_col, method_col, id_col).distinct(), [qid_col, method_col, id_col], "left_anti") \
                 .select(qid_col, method_col, id_col)
