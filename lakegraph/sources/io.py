"""Scans and sinks: Parquet, default-format load, CSV with all-string
columns, SQL scan with a limit, and full-replace table writes.

Everything returns lazy DataFrames; the only actions here are writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; filters and projections applied later reach the scan."""
    return spark.read.parquet(path)


def load_default(spark: SparkSession, path: str, **options) -> DataFrame:
    """``spark.read.load`` in the session's default format.

    CSV-only options such as ``header`` and ``inferSchema`` are accepted and
    have no effect on a self-describing format like Parquet.
    """
    return spark.read.load(path, **options)


def read_csv_strings(spark: SparkSession, path: str, columns: list[str] | None = None,
                     header: bool = True) -> DataFrame:
    """CSV scan with a header row where every column is a string.

    Passing the column names avoids a schema-inference pass over the files.
    """
    reader = spark.read.option("header", str(header).lower())
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def read_csv_kept_lines(spark: SparkSession, path: str, columns: list[str], malformed: str = "malformed_line",
                        header: bool = True) -> DataFrame:
    """CSV scan as strings that keeps lines with too few or too many fields
    whole in the ``malformed`` column (null on other lines)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, malformed]])
    return spark.read.schema(schema).option("header", str(header).lower()).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", malformed).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", "true").csv(path)
    return path


def sql_limit(spark: SparkSession, df: DataFrame, view: str | None = None,
              n: int = 1000, order_by: str | None = None) -> DataFrame:
    """``SELECT * FROM <table> LIMIT n`` through the SQL front end.

    With ``view`` the frame is registered under that name (as a table name
    would be); otherwise it is passed to ``spark.sql`` as a parameter and no
    session-wide name is created. Without ``order_by`` the rows returned are
    whichever partitions finish first; with it (``ALL`` or columns) they are
    the first by that order, each task keeping ``n`` rows.
    """
    order = f" ORDER BY {order_by}" if order_by else ""
    if view:
        df.createOrReplaceTempView(view)
        return spark.sql(f"SELECT * FROM {view}{order} LIMIT {int(n)}")
    return spark.sql(f"SELECT * FROM {{t}}{order} LIMIT {int(n)}", t=df)


def write_table(df: DataFrame, name: str | None = None, path: str | None = None,
                fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Full-replace write of a table, by catalog name and/or by path.

    ``fmt`` is a parameter (``delta`` where the jar is present). A table that
    is also being read in the same plan cannot be overwritten in place; write
    a new path and switch readers to it (see ``operators.graph.upsert``).
    """
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        if path:
            w = w.option("path", path)
        w.saveAsTable(name)
    elif path:
        w.save(path)
    else:
        raise ValueError("need a table name or a path")


def read_table(spark: SparkSession, name: str | None = None, path: str | None = None,
               fmt: str = "parquet") -> DataFrame:
    if name:
        return spark.table(name)
    return spark.read.format(fmt).load(path)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows by all columns, the frame behind ``show()``: an order
    makes the preview the same every time."""
    return df.orderBy(*df.columns).limit(n)


def head(df: DataFrame, n: int = 20) -> DataFrame:
    """Any ``n`` rows: a plain limit, which reads no more partitions than it
    needs (``preview`` orders the whole table)."""
    return df.limit(n)
