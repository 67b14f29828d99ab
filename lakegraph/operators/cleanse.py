"""Row validity filters and in-place column normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def validity(cols_gt: dict[str, float]) -> Column:
    """Conjunction ``c1 > t1 AND c2 > t2 ...``.

    A null makes the predicate null, so ``filter`` drops the row; NaN compares
    greater than every number in Spark, so NaN rows are kept.
    """
    pred = None
    for c, t in cols_gt.items():
        p = F.col(c) > F.lit(t)
        pred = p if pred is None else (pred & p)
    return pred


def filter_valid(df: DataFrame, cols_gt: dict[str, float]) -> DataFrame:
    return df.filter(validity(cols_gt))


def rejected_count(df: DataFrame, cols_gt: dict[str, float]) -> DataFrame:
    """Total, kept and rejected rows in one pass (kept + rejected = total)."""
    kept = F.coalesce(validity(cols_gt), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("n_total"),
                  F.count_if(kept).alias("n_kept"),
                  F.count_if(~kept).alias("n_rejected"))


def flag_to_boolean(col: str, true_value: str = "Y") -> Column:
    """``when(c == true_value, True).otherwise(False)``: anything else, null
    included, becomes False."""
    return F.when(F.col(col) == true_value, True).otherwise(False)


def to_timestamp_col(col: str | Column, lenient: bool = False) -> Column:
    """Cast to timestamp; ``lenient`` uses ``try_cast`` so a malformed string
    gives null instead of failing the job under ANSI mode."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("timestamp") if lenient else c.cast("timestamp")


def cleanse(df: DataFrame, valid_gt: dict[str, float], flag_col: str | None = None,
            flag_true: str = "Y", timestamp_cols: list[str] | None = None) -> DataFrame:
    """Filter invalid rows, then replace columns in place (one projection)."""
    out = filter_valid(df, valid_gt)
    repl: dict[str, Column] = {}
    if flag_col:
        repl[flag_col] = flag_to_boolean(flag_col, flag_true)
    for c in timestamp_cols or []:
        repl[c] = to_timestamp_col(c)
    return out.withColumns(repl) if repl else out


def with_reason(df: DataFrame, casts: dict[str, str], rules: dict[str, Column], malformed: str | None = None,
                out: str = "reason") -> DataFrame:
    """Text columns cast to their types, and why a row is rejected (null: kept),
    from one pass: ``malformed line`` where that column is set, else the first
    cast that fails on a non-null text, else the first rule that does not hold
    (a rule without an answer does not hold either)."""
    tests = []
    if malformed:
        tests.append((F.col(malformed).isNotNull(), "malformed line"))
    made = {c: F.col(c).try_cast(kind) for c, kind in casts.items()}
    tests += [(F.col(c).isNotNull() & v.isNull(), f"{c} is no {casts[c]}") for c, v in made.items()]
    typed = df.withColumn(out, _first_of(tests)).withColumns(made)
    return typed.withColumn(out, F.coalesce(F.col(out), _first_of([(~F.coalesce(r, F.lit(False)), name) for name, r in rules.items()])))


def _first_of(tests: list[tuple[Column, str]]) -> Column:
    out = F.lit(None).cast("string")
    for condition, name in reversed(tests):
        out = F.when(condition, F.lit(name)).otherwise(out)
    return out
