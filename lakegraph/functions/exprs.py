"""Column expressions shared by the jobs (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(a: str | Column) -> Column:
    return F.sqrt(F.aggregate(col(a), F.lit(0.0).cast("double"),
                              lambda acc, x: acc + x.cast("double") * x.cast("double")))


def py_str(c: str | Column) -> Column:
    """Text of a value as a Python f-string prints it: null becomes 'None'."""
    return F.coalesce(col(c).cast("string"), F.lit("None"))


def fixed3(c: str | Column) -> Column:
    """``f"{x:.3f}"``."""
    return F.format_string("%.3f", col(c))


def ordered_join(line: str | Column, order: str | Column, sep: str = "\n") -> Column:
    """Aggregate: join the lines of a (bounded) group in ``order``."""
    pairs = F.sort_array(F.collect_list(F.struct(col(order).alias("o"), col(line).alias("l"))))
    return F.array_join(F.transform(pairs, lambda s: s["l"]), sep)
