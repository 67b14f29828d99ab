"""Grouped averages, the lookup join and the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def monthly_average(df: DataFrame, ts_col: str, value_col: str,
                    name: str = "average_fare") -> DataFrame:
    """Average by calendar year and month, ordered by year, month."""
    return (df.groupBy(F.year(ts_col).alias("year"), F.month(ts_col).alias("month"))
              .agg(F.avg(value_col).alias(name))
              .orderBy("year", "month"))


def avg_by_key(df: DataFrame, key: str, value_col: str,
               name: str = "avg_fare_amount") -> DataFrame:
    return df.groupBy(key).agg(F.avg(value_col).alias(name))


def join_lookup(facts: DataFrame, fact_key: str, lookup: DataFrame, lookup_key: str,
                lenient: bool = True) -> DataFrame:
    """Inner join of a numeric key to a lookup whose key is text.

    The text key is cast explicitly to the fact key's type; with ``lenient``
    a malformed key (``'xx'``) becomes null and simply matches nothing
    instead of failing the job under ANSI mode. Both key columns are kept.
    The planner and adaptive execution choose the join by measured sizes.
    """
    key_type = facts.schema[fact_key].dataType.simpleString()
    lk = F.col(lookup_key)
    typed = lk.try_cast(key_type) if lenient else lk.cast(key_type)
    lu = lookup.withColumn("__lk", typed)
    return facts.join(lu, facts[fact_key] == F.col("__lk"), "inner").drop("__lk")


def feature_table(joined: DataFrame, feature: str = "avg_fare_amount",
                  label: str = "Zone") -> DataFrame:
    """(feature, label) frame. The demo's ``withColumnRenamed("AVG Fare
    Amount", "Zone")`` names a column that does not exist and so changes
    nothing; the result keeps both names."""
    return joined.select(feature, label).withColumnRenamed("AVG Fare Amount", label)


def avg_of_avg(features: DataFrame, label: str = "Zone", feature: str = "avg_fare_amount",
               name: str = "total_avg", digits: int = 2) -> DataFrame:
    """Unweighted average of per-key averages sharing a label, rounded."""
    return (features.groupBy(label).agg(F.avg(feature).alias(name))
                    .select(label, F.round(name, digits).alias(name)))
