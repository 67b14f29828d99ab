"""Profiles of a table: counts, coverage, summary statistics, quantiles,
histograms and 2-D densities, each a distributed aggregation.

Bin edges and brackets are scalar subqueries of the same plan; no value is
fetched to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def group_count(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).count()


def daily_counts(df: DataFrame, ts_col: str, fmt: str = "yyyy-MM-dd",
                 name: str = "pickup_date") -> DataFrame:
    return df.groupBy(F.date_format(ts_col, fmt).alias(name)).count()


def min_max(df: DataFrame, col: str, lo: str = "min", hi: str = "max") -> DataFrame:
    """Minimum and maximum in one job (not one job each)."""
    return df.agg(F.min(col).alias(lo), F.max(col).alias(hi))


def describe_typed(df: DataFrame, col: str) -> DataFrame:
    """The statistics of ``describe()`` as typed columns: count, mean,
    sample standard deviation, min, max."""
    c = F.col(col)
    return df.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("stddev"),
                  F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"))


def describe_rows(df: DataFrame, *cols: str) -> DataFrame:
    """Spark's own ``describe()``: one row per statistic, values as strings."""
    return df.select(*cols).describe()


def schema_profile(df: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """One row per column: position, Spark type, null and non-null counts.

    All counts come from a single aggregation pass; with ``approx_distinct``
    a HyperLogLog++ distinct estimate is added per column (exact distinct
    counts of every column would need a shuffle per column).
    """
    aggs = []
    for c in df.columns:
        aggs.append(F.count(F.col(c)).alias(f"nn__{c}"))
        if approx_distinct:
            aggs.append(F.approx_count_distinct(F.col(c)).alias(f"nd__{c}"))
    totals = df.agg(F.count(F.lit(1)).alias("__n"), *aggs)
    entries = []
    for i, f in enumerate(df.schema.fields):
        fields = [F.lit(f.name).alias("column_name"), F.lit(i + 1).alias("ordinal"),
                  F.lit(f.dataType.simpleString()).alias("data_type"),
                  (F.col("__n") - F.col(f"nn__{f.name}")).alias("null_count"),
                  F.col(f"nn__{f.name}").alias("non_null_count")]
        if approx_distinct:
            fields.append(F.col(f"nd__{f.name}").alias("approx_distinct"))
        entries.append(F.struct(*fields))
    return totals.select(F.inline(F.array(*entries)))


def distinct_counts(df: DataFrame) -> DataFrame:
    """(column_name, n_distinct): exact distinct counts of every column. Values
    are collapsed per column first, so repeated values are few rows."""
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v"))
                                          for c in df.columns])).alias("p")).select("p.*").distinct()
    return pairs.groupBy("column_name").agg(F.count("v").alias("n_distinct"))


# ---------------------------------------------------------------- quantiles

def _numbers(df: DataFrame, col: str) -> DataFrame:
    """The column as doubles ``v``, without null and NaN."""
    v = F.col(col).cast("double")
    return df.select(v.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))


def quantiles_approx(df: DataFrame, col: str, probs: list[float],
                     relative_error: float = 0.01) -> DataFrame:
    """``approxQuantile`` as a frame: one (quantile, value) row per probability.

    ``percentile_approx`` keeps a bounded sketch per partition (accuracy =
    1 / relative error) and merges sketches, so memory does not grow with N.
    Null and NaN are left out, as ``approxQuantile`` does.
    """
    acc = max(1, int(round(1.0 / relative_error)))
    arr = _numbers(df, col).agg(F.percentile_approx("v", list(probs), acc).alias("v"))
    return arr.select(F.posexplode("v").alias("i", "value")).select(
        F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("i") + 1).alias("quantile"),
        "value")


def rank_errors(df: DataFrame, col: str, quantiles: DataFrame) -> DataFrame:
    """(quantile, rank_error): how far each value's rank is from its target,
    as a share of the rows; 0 when the target lies within the value's ties.
    ``quantiles`` holds a few (quantile, value) rows, read as one array."""
    pairs = quantiles.agg(F.sort_array(F.collect_list(F.struct("quantile", "value")))).scalar()
    rows = _numbers(df, col).select("v", F.explode(pairs).alias("t"))
    per = rows.groupBy(F.col("t.quantile").alias("quantile")).agg(
        F.count_if(F.col("v") < F.col("t.value")).alias("below"),
        F.count_if(F.col("v") <= F.col("t.value")).alias("upto"), F.count(F.lit(1)).alias("n"))
    target = F.col("quantile") * F.col("n")
    return per.select("quantile", (F.greatest(F.lit(0.0), F.col("below") - target, target - F.col("upto")) / F.col("n"))
                      .alias("rank_error"))


def quantiles_exact(df: DataFrame, col: str, probs: list[float], accuracy: int = 10_000) -> DataFrame:
    """Exact discrete quantiles: for each p the smallest value v with
    ``count(x <= v) >= ceil(p * n)`` (first value when that rank is < 1).

    Pass 1 brackets each target with a sketch of known rank error
    (1 / ``accuracy`` of the rows, bracket twice as wide on both sides). Pass 2
    counts the rows below and inside each bracket; the target must lie inside.
    Only values inside a bracket are collapsed to (value, count) and ranked,
    about 4 / ``accuracy`` of the rows per target, so nothing depends on how
    rows are partitioned. Null and NaN are left out.
    """
    vals = _numbers(df, col)
    margin = 2.0 / accuracy
    edges = [e for p in probs for e in (max(0.0, p - margin), min(1.0, p + margin))]
    sketch = vals.agg(F.percentile_approx("v", edges, accuracy)).scalar()
    v = F.col("v")
    below, inside = [], []
    for i in range(len(probs)):
        lo, hi = F.get(sketch, F.lit(2 * i)), F.get(sketch, F.lit(2 * i + 1))
        below.append(v < lo)
        inside.append((v >= lo) & (v <= hi))
    counts = vals.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(f"b{i}") for i, c in enumerate(below)],
                      *[F.count_if(c).alias(f"m{i}") for i, c in enumerate(inside)])
    starts = []
    for i, p in enumerate(probs):
        rank = F.greatest(F.lit(1).cast("long"), F.ceil(F.lit(float(p)) * F.col("n")).cast("long"))
        held = (F.col(f"b{i}") < rank) & (rank <= F.col(f"b{i}") + F.col(f"m{i}"))
        missed = F.raise_error(F.lit(f"quantile {p} is outside its bracket; raise accuracy")).cast("long")
        starts.append(F.struct(F.lit(float(p)).alias("quantile"), rank.alias("rank"),
                               F.when(held, F.col(f"b{i}")).otherwise(missed).alias("before")))
    target = counts.filter("n > 0").select(F.array(*starts)).scalar()
    which = F.explode(F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(inside)])))
    few = vals.select(v, which.alias("i")).groupBy("i", "v").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy("i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = few.withColumn("t", F.get(target, F.col("i"))).withColumn("hi", F.col("t.before") + upto)
    return ranked.filter((F.col("hi") - F.col("c") < F.col("t.rank")) & (F.col("t.rank") <= F.col("hi"))) \
                 .select(F.col("t.quantile").alias("quantile"), F.col("v").alias("value"))


# ---------------------------------------------------------------- histograms

def _range(df: DataFrame, *cols: str) -> Column:
    """One scalar struct with lo and hi of each column, NaN left out."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        aggs += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    return df.agg(*aggs).select(F.struct(*[F.col(f"{e}{i}") for i in range(len(cols)) for e in ("lo", "hi")])).scalar()


def _bin(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin in [0, bins-1]; the last bin is closed on the right;
    a single-valued column puts everything in bin 0."""
    width = (hi - lo) / F.lit(float(bins))
    return F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((value - lo) / F.when(hi > lo, width)), F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """``plt.hist(values, bins)`` as a table: bin, bin_lo, bin_hi, count.

    Counting is one partial + final aggregation keyed by bin (at most
    ``bins`` groups); empty bins are kept. Null and NaN are left out; a column
    without numbers gives no rows.
    """
    edges = _range(df, col)
    lo, hi = edges["lo0"], edges["hi0"]
    counts = _numbers(df, col).groupBy(_bin(F.col("v"), lo, hi, bins).alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    width = (hi - lo) / F.lit(float(bins))
    all_bins = df.sparkSession.range(bins).filter(lo.isNotNull()).select(
        F.col("id").cast("int").alias("bin"),
        (lo + F.col("id") * width).alias("bin_lo"),
        F.when(F.col("id") == bins - 1, hi).otherwise(lo + (F.col("id") + 1) * width).alias("bin_hi"))
    return (all_bins.join(counts, "bin", "left")
                    .select("bin", "bin_lo", "bin_hi", F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def density_2d(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """Scatter plot as a table: count per (x bin, y bin), non-empty cells only.
    One scan gives all four bounds, one counts; rows with null or NaN in
    either column are left out of the counts."""
    edges = _range(df, x, y)
    xv, yv = F.col(x).cast("double"), F.col(y).cast("double")
    both = df.filter(xv.isNotNull() & yv.isNotNull() & ~F.isnan(xv) & ~F.isnan(yv))
    return both.groupBy(_bin(xv, edges["lo0"], edges["hi0"], bins).alias("x_bin"),
                        _bin(yv, edges["lo1"], edges["hi1"], bins).alias("y_bin")) \
               .agg(F.count(F.lit(1)).alias("count"))


def correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson correlation and the number of pairs it uses, one row."""
    xv, yv = F.col(x).cast("double"), F.col(y).cast("double")
    return df.agg(F.corr(xv, yv).alias("corr"), F.count_if(xv.isNotNull() & yv.isNotNull()).alias("n"))


def scatter_sample(df: DataFrame, x: str, y: str, key: list[str], bins: int = 20, per_cell: int = 5) -> DataFrame:
    """Points behind the density cells: of each cell the ``per_cell`` rows with
    the smallest digest of their key, so the sample is the same at any
    partitioning. Each task keeps that many rows of a cell before the shuffle."""
    edges = _range(df, x, y)
    xv, yv = F.col(x).cast("double"), F.col(y).cast("double")
    both = df.filter(xv.isNotNull() & yv.isNotNull() & ~F.isnan(xv) & ~F.isnan(yv))
    cells = both.select(*key, x, y, _bin(xv, edges["lo0"], edges["hi0"], bins).alias("x_bin"), _bin(yv, edges["lo1"], edges["hi1"], bins).alias("y_bin"),
                        F.md5(F.concat_ws("-", *[F.col(k).cast("string") for k in key])).alias("digest"))
    order = Window.partitionBy("x_bin", "y_bin").orderBy("digest", *key, x, y)
    return cells.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_cell).drop("digest")


def exact_distinct(df: DataFrame) -> DataFrame:
    """(column_name, n_distinct): exact distinct counts of every column.

    Whole numbers in a range not much wider than their number are counted by
    bitmaps (32,768 values in 4 KB, merged before the shuffle); other columns by
    their distinct values, each column in its own two-level aggregation over a
    scan of that column alone."""
    whole = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))]
    bounds = df.agg(F.count(F.lit(1)).alias("n"), *[f(c).cast("decimal(38,0)").alias(f"{k}{i}") for i, c in enumerate(whole)
                                                    for k, f in (("lo", F.min), ("hi", F.max))]).first()
    dense = {c for i, c in enumerate(whole) if bounds[f"lo{i}"] is not None and bounds[f"hi{i}"] - bounds[f"lo{i}"] <= 64 * bounds.n}
    parts = []
    for c in df.columns:
        if c in dense:
            v = F.col(c).cast("long")
            bits = df.filter(F.col(c).isNotNull()).groupBy(F.bitmap_bucket_number(v).alias("bucket")).agg(
                F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("bits"))
            count = bits.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n_distinct"))
        else:
            count = df.select(c).distinct().agg(F.count(c).alias("n_distinct"))
        parts.append(count.select(F.lit(c).alias("column_name"), "n_distinct"))
    return reduce(DataFrame.unionByName, parts)


def quantile_states(df: DataFrame, groups: list[str], col: str, k: int = 200) -> DataFrame:
    """(groups, sketch, n): a mergeable KLL sketch of the numbers of each group;
    null and NaN take no part. Kept states answer any union of groups."""
    v = F.col(col).cast("double")
    return df.filter(v.isNotNull() & ~F.isnan(v)).groupBy(*groups).agg(
        F.kll_sketch_agg_double(v, k).alias("sketch"), F.count(F.lit(1)).alias("n"))


def merged_quantiles(states: DataFrame, groups: list[str], probs: list[float], k: int = 200) -> DataFrame:
    """(groups, n, q, value) of sketches merged over whatever else they were
    grouped by."""
    whole = states.groupBy(*groups).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n"))
    return whole.select(*groups, "n", F.explode(F.array(*[
        F.struct(F.lit(p).alias("q"), F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias("value")) for p in probs])).alias("x")) \
        .select(*groups, "n", "x.q", "x.value")
