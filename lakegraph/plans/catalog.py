"""Registered jobs: name -> (Spark job over a table folder, equivalent SQL).

Every job reads the whole tables in ``sf_dir``. Floating results that two
engines may sum in a different order are rounded (6 places) on both sides.
The SQL is DuckDB dialect over views named after the tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegraph.functions.exprs import norm, py_str
from lakegraph.operators import aggregate as agg
from lakegraph.operators import cleanse, evaluate, graph, match, profile, retrieve, stored, vector_index, vectors
from lakegraph.plans import supply_graph as sg
from lakegraph.plans import trips as tr
from lakegraph.session import shared_dir
from lakegraph.sources import io
from lakegraph.sources.testdata import Tables, table_path

Job = Callable[[SparkSession, str], DataFrame]
JOBS: dict[str, Job] = {}
SQL: dict[str, str] = {}

# Fixed parameters of the registered jobs.
QUANTILES = [0.1, 0.25, 0.5, 0.75, 0.9]
HIST_BINS = 50
DENSITY_BINS = 20
K_SEARCH = 5          # graph retrieval top_k
K_CONTEXT = 3         # vector-only context top_k
EMBED_DIM = 64
SNAPSHOT = "2000-01-01 00:00:00"     # upsert: base holds orders before this
UPDATES_FROM = "1999-01-01 00:00:00"  # updates: orders from this date, P -> F


def job(name: str, sql: str | None = None):
    def deco(fn: Job) -> Job:
        JOBS[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


# ====================================================================== scans

@job("scan_parquet", "SELECT * FROM lineitem")
def scan_parquet(spark, d):
    return io.read_parquet(spark, table_path(d, "lineitem"))


@job("sql_limit", "SELECT * FROM lineitem ORDER BY ALL NULLS FIRST LIMIT 1000")
def sql_limit(spark, d):
    return io.sql_limit(spark, Tables(spark, d).lineitem, n=1000, order_by="ALL")


@job("preview", "SELECT * FROM orders ORDER BY ALL NULLS FIRST LIMIT 20")
def preview(spark, d):
    return io.preview(Tables(spark, d).orders, 20)


@job("limit_facts", """
SELECT 'limit' AS what, least(1000, count(*)) AS n_rows, least(1000, count(*)) AS n_contained FROM lineitem
UNION ALL SELECT 'head', least(20, count(*)), least(20, count(*)) FROM orders""")
def limit_facts(spark, d):
    # an unordered limit may give any rows: as many as asked, each of them one of the table's
    t = Tables(spark, d)
    parts = []
    for what, rows, table in (("limit", io.sql_limit(spark, t.lineitem, n=1000), t.lineitem), ("head", io.head(t.orders, 20), t.orders)):
        some = _kept(spark, rows, "limit")
        same = some.alias("a").join(table.alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in table.columns], "left_semi")
        parts.append(some.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(what).alias("what"), "n_rows", same.agg(F.count(F.lit(1))).scalar().alias("n_contained")))
    return parts[0].unionByName(parts[1])


@job("load_default", "SELECT * FROM orders")
def load_default(spark, d):
    return io.load_default(spark, table_path(d, "orders"), header=True, inferSchema=True)


LOOKUP_SQL = """
SELECT CAST(s.s_suppkey AS VARCHAR) AS LocationID, r.r_name AS Borough, n.n_name AS Zone,
       s.s_name AS service_zone
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""


@job("csv_lookup_scan", LOOKUP_SQL)
def csv_lookup_scan(spark, d):
    path = shared_dir(spark, "zone_lookup_csv")
    io.write_csv(tr.zone_lookup(spark, d), path)
    return io.read_csv_strings(spark, path, ["LocationID", "Borough", "Zone", "service_zone"])


CLEANSED_SQL = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, CASE WHEN l_returnflag = 'R' THEN true ELSE false END AS l_returnflag,
       l_linestatus, CAST(l_shipdate AS TIMESTAMP) AS l_shipdate,
       CAST(l_shipdate + to_days(l_linenumber) AS TIMESTAMP) AS l_dropoff
FROM lineitem WHERE l_quantity > {tr.VALID[tr.DIST]} AND l_extendedprice > {tr.VALID[tr.FARE]}
"""


def cleansed(spark, d):
    return cleanse.cleanse(tr.trips(spark, d), tr.VALID, flag_col=tr.FLAG, flag_true=tr.FLAG_TRUE,
                           timestamp_cols=[tr.PICKUP, tr.DROPOFF])


@job("table_roundtrip", CLEANSED_SQL)
def table_roundtrip(spark, d):
    # full-replace write of a named table whose files live in the shared folder
    path = shared_dir(spark, "tables", "trips_cleansed")
    name = f"lakegraph_trips_cleansed_{path.rsplit('/', 1)[1]}"     # runs do not meet in the metastore
    io.write_table(cleansed(spark, d), name=name, path=path, fmt="parquet")
    return io.read_table(spark, name=name)


LINEITEM_TYPES = "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' " \
                 "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' " \
                 "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END"


@job("schema_profile", f"""
WITH d AS (SELECT column_name, CAST(row_number() OVER () AS INTEGER) AS ordinal,
                  {LINEITEM_TYPES} AS data_type FROM (DESCRIBE lineitem)),
n AS (SELECT * FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM lineitem)
                     ON COLUMNS(*) INTO NAME column_name VALUE non_null_count)),
t AS (SELECT count(*) AS n_rows FROM lineitem)
SELECT d.column_name, d.ordinal, d.data_type, t.n_rows - n.non_null_count AS null_count,
       n.non_null_count
FROM d JOIN n ON d.column_name = n.column_name, t
""")
def schema_profile(spark, d):
    return profile.schema_profile(Tables(spark, d).lineitem)


@job("distinct_profile", """
WITH t AS (UNPIVOT (SELECT count(DISTINCT COLUMNS(*)) FROM supplier) ON COLUMNS(*) INTO NAME column_name VALUE n_distinct)
SELECT column_name, n_distinct FROM t""")
def distinct_profile(spark, d):
    return profile.distinct_counts(Tables(spark, d).supplier)


# ============================================================ cleanse / filter

@job("distinct_exact", """
WITH t AS (UNPIVOT (SELECT count(DISTINCT COLUMNS(*)) FROM lineitem) ON COLUMNS(*) INTO NAME column_name VALUE n_distinct)
SELECT column_name, n_distinct FROM t""")
def distinct_exact(spark, d):
    return profile.exact_distinct(Tables(spark, d).lineitem)


@job("project_columns", "SELECT l_quantity, l_extendedprice FROM lineitem")
def project_columns(spark, d):
    return Tables(spark, d).lineitem.select(tr.DIST, tr.FARE)


@job("flag_to_boolean", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN true ELSE false END AS l_returnflag
FROM lineitem""")
def flag_to_boolean(spark, d):
    li = Tables(spark, d).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     cleanse.flag_to_boolean(tr.FLAG, tr.FLAG_TRUE).alias(tr.FLAG))


@job("cast_timestamps", """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS TIMESTAMP) AS l_shipdate,
       CAST(l_shipdate + to_days(l_linenumber) AS TIMESTAMP) AS l_dropoff
FROM lineitem""")
def cast_timestamps(spark, d):
    t = tr.trips(spark, d)
    return t.select("l_orderkey", "l_linenumber",
                    cleanse.to_timestamp_col(tr.PICKUP).alias(tr.PICKUP),
                    cleanse.to_timestamp_col(tr.DROPOFF).alias(tr.DROPOFF))


@job("filter_valid", f"""
SELECT * FROM lineitem WHERE l_quantity > {tr.VALID[tr.DIST]} AND l_extendedprice > {tr.VALID[tr.FARE]}""")
def filter_valid(spark, d):
    return cleanse.filter_valid(Tables(spark, d).lineitem, tr.VALID)


@job("rejected_count", f"""
SELECT count(*) AS n_total,
       count(*) FILTER (WHERE coalesce(l_quantity > {tr.VALID[tr.DIST]} AND l_extendedprice > {tr.VALID[tr.FARE]}, false)) AS n_kept,
       count(*) FILTER (WHERE NOT coalesce(l_quantity > {tr.VALID[tr.DIST]} AND l_extendedprice > {tr.VALID[tr.FARE]}, false)) AS n_rejected
FROM lineitem""")
def rejected_count(spark, d):
    return cleanse.rejected_count(Tables(spark, d).lineitem, tr.VALID)


# lines with too few fields, texts that are no number or date, and a rule, by order key
QUARANTINE = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
LEAST_PRICE = 20000.0


@job("quarantine_counts", f"""
WITH r AS (SELECT CASE WHEN o_orderkey % 20 = 3 THEN 'malformed line' WHEN o_orderkey % 20 = 7 THEN 'o_totalprice is no double'
  WHEN o_orderkey % 20 = 11 THEN 'o_orderdate is no date' WHEN o_totalprice < {LEAST_PRICE} THEN 'price too small' ELSE 'kept' END AS reason FROM orders)
SELECT reason, count(*) AS n, (SELECT count(*) FROM orders) AS n_lines FROM r GROUP BY reason""")
def quarantine_counts(spark, d):
    key = F.col("o_orderkey") % 20
    good = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", F.when(key == 7, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")),
                       F.when(key == 11, F.lit("2020-13-45")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    lines = Tables(spark, d).orders.select(F.when(key == 3, F.concat_ws(",", "o_orderkey", "o_custkey")).otherwise(good).alias("value"))
    path = shared_dir(spark, "quarantine")
    lines.write.text(path)
    rows = io.read_csv_kept_lines(spark, path, QUARANTINE, header=False)
    judged = cleanse.with_reason(rows, {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderdate": "date"},
                                 {"price too small": F.col("o_totalprice") >= LEAST_PRICE}, malformed="malformed_line")
    judged = _kept(spark, judged, "judged")               # kept and rejected rows of one pass
    n = judged.agg(F.count(F.lit(1))).scalar()
    return judged.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n")).withColumn("n_lines", n)


@job("multi_filter", """
SELECT DISTINCT l.l_orderkey, l.l_partkey, l.l_suppkey
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
WHERE o.o_orderpriority IN ('1-URGENT', '2-HIGH') AND o.o_orderstatus = 'P'
  AND l.l_returnflag = 'R' AND s.s_acctbal < 1000""")
def multi_filter(spark, d):
    t = Tables(spark, d)
    o = t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
                        & (F.col("o_orderstatus") == "P")).select("o_orderkey")
    s = t.supplier.filter(F.col("s_acctbal") < 1000).select("s_suppkey")
    li = t.lineitem.filter(F.col("l_returnflag") == "R").select("l_orderkey", "l_partkey", "l_suppkey")
    return (li.join(s, li.l_suppkey == s.s_suppkey, "left_semi")
              .join(o, li.l_orderkey == o.o_orderkey, "left_semi")
              .distinct())


# ================================================================ aggregates

@job("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, d):
    return profile.row_count(Tables(spark, d).lineitem)


@job("group_count", "SELECT l_linenumber, count(*) AS count FROM lineitem GROUP BY l_linenumber")
def group_count(spark, d):
    return profile.group_count(Tables(spark, d).lineitem, F.col(tr.VENDOR))


@job("daily_counts", """
SELECT strftime(l_shipdate, '%Y-%m-%d') AS pickup_date, count(*) AS count FROM lineitem GROUP BY 1""")
def daily_counts(spark, d):
    return profile.daily_counts(Tables(spark, d).lineitem, tr.PICKUP)


@job("date_coverage", "SELECT min(l_shipdate) AS oldest_day, max(l_shipdate) AS latest_day FROM lineitem")
def date_coverage(spark, d):
    return profile.min_max(Tables(spark, d).lineitem, tr.PICKUP, "oldest_day", "latest_day")


@job("min_max", 'SELECT min(l_extendedprice) AS "min", max(l_extendedprice) AS "max" FROM lineitem')
def min_max(spark, d):
    return profile.min_max(Tables(spark, d).lineitem, tr.FARE)


@job("monthly_average", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
       round(avg(l_extendedprice), 6) AS average_fare
FROM lineitem GROUP BY 1, 2 ORDER BY 1, 2""")
def monthly_average(spark, d):
    out = agg.monthly_average(Tables(spark, d).lineitem, tr.PICKUP, tr.FARE)
    return out.withColumn("average_fare", r6("average_fare"))


@job("monthly_average_kept", SQL["monthly_average"])
def monthly_average_kept(spark, d):
    # states of the older trips, then of the new ones; one load comes twice, as after a failure
    li = Tables(spark, d).lineitem
    kept = stored.KeptAverages(spark, shared_dir(spark, "monthly-states"), {"year": F.year(tr.PICKUP), "month": F.month(tr.PICKUP)}, tr.FARE)
    new = F.col(tr.PICKUP) >= F.lit(SNAPSHOT).cast("timestamp_ntz")
    kept.load("older", li.filter(~new | F.col(tr.PICKUP).isNull()))
    kept.load("new", li.filter(new))
    kept.load("new", li.filter(new))
    return kept.averages("average_fare").withColumn("average_fare", r6("average_fare"))


@job("avg_by_key", """
SELECT l_suppkey, round(avg(l_extendedprice), 6) AS avg_fare_amount FROM lineitem GROUP BY l_suppkey""")
def avg_by_key(spark, d):
    out = agg.avg_by_key(Tables(spark, d).lineitem, tr.LOC, tr.FARE)
    return out.withColumn("avg_fare_amount", r6("avg_fare_amount"))


JOIN_LOOKUP_CTE = f"""
WITH a AS (SELECT l_suppkey, avg(l_extendedprice) AS avg_fare_amount FROM lineitem GROUP BY l_suppkey),
z AS ({LOOKUP_SQL}),
j AS (SELECT a.l_suppkey, a.avg_fare_amount, z.* FROM a JOIN z ON a.l_suppkey = TRY_CAST(z.LocationID AS BIGINT))
"""


def _joined(spark, d):
    a = agg.avg_by_key(Tables(spark, d).lineitem, tr.LOC, tr.FARE)
    return agg.join_lookup(a, tr.LOC, tr.zone_lookup(spark, d), "LocationID")


@job("join_lookup", JOIN_LOOKUP_CTE + """
SELECT l_suppkey, round(avg_fare_amount, 6) AS avg_fare_amount, LocationID, Borough, Zone, service_zone FROM j""")
def join_lookup(spark, d):
    return _joined(spark, d).withColumn("avg_fare_amount", r6("avg_fare_amount"))


@job("feature_table", JOIN_LOOKUP_CTE + "SELECT round(avg_fare_amount, 6) AS avg_fare_amount, Zone FROM j")
def feature_table(spark, d):
    return agg.feature_table(_joined(spark, d)).withColumn("avg_fare_amount", r6("avg_fare_amount"))


@job("avg_of_avg", JOIN_LOOKUP_CTE + "SELECT Zone, round(avg(avg_fare_amount), 2) AS total_avg FROM j GROUP BY Zone")
def avg_of_avg(spark, d):
    return agg.avg_of_avg(agg.feature_table(_joined(spark, d)))


@job("describe_stats", """
SELECT count(l_extendedprice) AS n, round(avg(l_extendedprice), 6) AS mean,
       round(stddev_samp(l_extendedprice), 6) AS stddev,
       CAST(min(l_extendedprice) AS DOUBLE) AS "min", CAST(max(l_extendedprice) AS DOUBLE) AS "max"
FROM lineitem""")
def describe_stats(spark, d):
    out = profile.describe_typed(Tables(spark, d).lineitem, tr.FARE)
    return out.withColumns({"mean": r6("mean"), "stddev": r6("stddev")})


@job("quantiles_exact", f"""
SELECT unnest({QUANTILES}) AS quantile,
       unnest(quantile_disc(l_extendedprice, {QUANTILES})) AS value
FROM lineitem""")
def quantiles_exact(spark, d):
    return profile.quantiles_exact(Tables(spark, d).lineitem, tr.FARE, QUANTILES)


@job("quantiles_approx")   # approximate by design; its ranks are checked by quantiles_approx_ranks
def quantiles_approx(spark, d):
    return profile.quantiles_approx(Tables(spark, d).lineitem, tr.FARE, QUANTILES, 0.01)


@job("quantiles_approx_ranks", f"SELECT unnest({QUANTILES}) AS quantile, true AS within_error")
def quantiles_approx_ranks(spark, d):
    li = Tables(spark, d).lineitem
    ranks = profile.rank_errors(li, tr.FARE, profile.quantiles_approx(li, tr.FARE, QUANTILES, 0.01))
    return ranks.select("quantile", (F.col("rank_error") <= 0.01).alias("within_error"))


KLL_ERROR = 0.02


@job("quantiles_by_group", f"""
WITH g AS (SELECT l_returnflag, count(l_extendedprice) AS n FROM lineitem GROUP BY 1 HAVING count(l_extendedprice) > 0)
SELECT l_returnflag, q, n, true AS rank_within_bound FROM g, (SELECT unnest({QUANTILES}) AS q)""")
def quantiles_by_group(spark, d):
    # states by group and day, written; merged over the days; each value's rank against all rows of its group
    li = Tables(spark, d).lineitem.select(tr.FLAG, F.to_date(tr.PICKUP).alias("day"), tr.FARE)
    states = _kept(spark, profile.quantile_states(li, [tr.FLAG, "day"], tr.FARE), "kll")
    found = profile.merged_quantiles(states, [tr.FLAG], QUANTILES)
    rows = li.filter(F.col(tr.FARE).isNotNull()).join(found.withColumnRenamed(tr.FLAG, "g"), F.col(tr.FLAG).eqNullSafe(F.col("g")))
    below, upto = F.count_if(F.col(tr.FARE) < F.col("value")), F.count_if(F.col(tr.FARE) <= F.col("value"))
    return rows.groupBy(tr.FLAG, "q", "n").agg(((below / F.col("n") <= F.col("q") + KLL_ERROR) & (upto / F.col("n") >= F.col("q") - KLL_ERROR)).alias("rank_within_bound"))


@job("histogram_50", f"""
WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT CASE WHEN s.hi = s.lo THEN 0
                  ELSE CAST(least(floor((l.l_extendedprice - s.lo) / ((s.hi - s.lo) / {HIST_BINS})), {HIST_BINS - 1}) AS INTEGER) END AS bin
      FROM lineitem l, s WHERE l.l_extendedprice IS NOT NULL),
c AS (SELECT bin, count(*) AS cnt FROM b GROUP BY bin),
e AS (SELECT CAST(r.range AS INTEGER) AS bin,
             round(s.lo + r.range * ((s.hi - s.lo) / {HIST_BINS}), 6) AS bin_lo,
             round(CASE WHEN r.range = {HIST_BINS - 1} THEN s.hi ELSE s.lo + (r.range + 1) * ((s.hi - s.lo) / {HIST_BINS}) END, 6) AS bin_hi
      FROM range(0, {HIST_BINS}) r, s)
SELECT e.bin, e.bin_lo, e.bin_hi, CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM e LEFT JOIN c ON e.bin = c.bin""")
def histogram_50(spark, d):
    h = profile.histogram(Tables(spark, d).lineitem, tr.FARE, HIST_BINS)
    return h.withColumns({"bin_lo": r6("bin_lo"), "bin_hi": r6("bin_hi")})


@job("density_2d", f"""
WITH s AS (SELECT min(l_quantity) AS xlo, max(l_quantity) AS xhi,
                  min(l_extendedprice) AS ylo, max(l_extendedprice) AS yhi FROM lineitem)
SELECT CASE WHEN s.xhi = s.xlo THEN 0 ELSE CAST(least(floor((l_quantity - s.xlo) / ((s.xhi - s.xlo) / {DENSITY_BINS})), {DENSITY_BINS - 1}) AS INTEGER) END AS x_bin,
       CASE WHEN s.yhi = s.ylo THEN 0 ELSE CAST(least(floor((l_extendedprice - s.ylo) / ((s.yhi - s.ylo) / {DENSITY_BINS})), {DENSITY_BINS - 1}) AS INTEGER) END AS y_bin,
       count(*) AS count
FROM lineitem, s WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY 1, 2""")
def density_2d(spark, d):
    return profile.density_2d(Tables(spark, d).lineitem, tr.DIST, tr.FARE, DENSITY_BINS)


SAMPLE_PER_CELL = 5


@job("scatter_sample", f"""
WITH s AS (SELECT min(l_quantity) AS xlo, max(l_quantity) AS xhi,
                  min(l_extendedprice) AS ylo, max(l_extendedprice) AS yhi FROM lineitem),
c AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
       CASE WHEN s.xhi = s.xlo THEN 0 ELSE CAST(least(floor((l_quantity - s.xlo) / ((s.xhi - s.xlo) / {DENSITY_BINS})), {DENSITY_BINS - 1}) AS INTEGER) END AS x_bin,
       CASE WHEN s.yhi = s.ylo THEN 0 ELSE CAST(least(floor((l_extendedprice - s.ylo) / ((s.yhi - s.ylo) / {DENSITY_BINS})), {DENSITY_BINS - 1}) AS INTEGER) END AS y_bin
FROM lineitem, s WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL)
SELECT *, CAST(row_number() OVER (PARTITION BY x_bin, y_bin ORDER BY md5(concat_ws('-', l_orderkey, l_linenumber)), l_orderkey, l_linenumber,
  l_quantity, l_extendedprice) AS INTEGER) AS place FROM c QUALIFY place <= {SAMPLE_PER_CELL}""")
def scatter_sample(spark, d):
    return profile.scatter_sample(Tables(spark, d).lineitem, tr.DIST, tr.FARE, ["l_orderkey", "l_linenumber"], DENSITY_BINS, SAMPLE_PER_CELL)


@job("correlation", """
SELECT round(corr(l_quantity, l_extendedprice), 6) AS corr, count(*) AS n FROM lineitem""")
def correlation(spark, d):
    return profile.correlation(Tables(spark, d).lineitem, tr.DIST, tr.FARE).withColumn("corr", r6("corr"))


# ===================================================================== graph

# The supply-chain roles over the tables, as SQL (see plans/supply_graph.py).
GRAPH_CTES = """
batches AS (
  SELECT b.batch_part, b.batch_supp, p.p_name AS product,
         CASE WHEN b.failed THEN 'FAILED' ELSE 'PASSED' END AS quality_status
  FROM (SELECT l_partkey AS batch_part, l_suppkey AS batch_supp, bool_or(l_returnflag = 'R') AS failed
        FROM lineitem GROUP BY 1, 2) b
  LEFT JOIN part p ON p.p_partkey = b.batch_part),
orders_n AS (
  SELECT o.o_orderkey AS order_id, c.c_name AS customer,
         CASE o.o_orderstatus WHEN 'P' THEN 'DELAYED' WHEN 'F' THEN 'SHIPPED' WHEN 'O' THEN 'PENDING'
              ELSE o.o_orderstatus END AS status,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'HIGH'
              WHEN o.o_orderpriority = '3-MEDIUM' THEN 'MEDIUM' ELSE 'LOW' END AS priority
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
suppliers_n AS (
  SELECT s_suppkey AS supplier_id, s_name AS name,
         CASE WHEN s_acctbal < 1000 THEN 'HIGH' WHEN s_acctbal < 5000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
  FROM supplier),
warehouses_n AS (SELECT CAST(n_nationkey AS BIGINT) AS warehouse_id, n_name AS location FROM nation),
contains_e AS (SELECT DISTINCT l_orderkey AS order_id, l_partkey AS batch_part, l_suppkey AS batch_supp FROM lineitem),
made_by_e AS (SELECT b.batch_part, b.batch_supp, s.supplier_id FROM batches b
              JOIN suppliers_n s ON s.supplier_id = b.batch_supp),
stored_in_e AS (SELECT b.batch_part, b.batch_supp, w.warehouse_id FROM batches b
                JOIN warehouses_n w ON w.warehouse_id = b.batch_part % 25)
"""


def _g(spark, d) -> match.SupplyGraph:
    """The graph frames over ``d``. They are lazy plans (no data, no action
    results), so one definition per session and folder is reused by jobs."""
    cache = spark.__dict__.setdefault("_lakegraph_graphs", {})
    if d not in cache:
        cache[d] = sg.tables_graph(spark, d)
    return cache[d]


PATTERN_SELECT = """
SELECT c.order_id AS oid, o.customer AS cust, c.batch_part, c.batch_supp, b.product AS prod,
       s.name AS sup_name, s.risk_tier AS risk, w.location AS warehouse
FROM contains_e c
JOIN orders_n o ON o.order_id = c.order_id
JOIN batches b ON b.batch_part = c.batch_part AND b.batch_supp = c.batch_supp
JOIN made_by_e m ON m.batch_part = b.batch_part AND m.batch_supp = b.batch_supp
JOIN suppliers_n s ON s.supplier_id = m.supplier_id
JOIN stored_in_e si ON si.batch_part = b.batch_part AND si.batch_supp = b.batch_supp
JOIN warehouses_n w ON w.warehouse_id = si.warehouse_id
WHERE o.priority = 'HIGH' AND o.status = 'DELAYED' AND b.quality_status = 'FAILED'
  AND s.risk_tier = 'HIGH'
"""
PATTERN_SQL = "WITH " + GRAPH_CTES + PATTERN_SELECT + "ORDER BY oid"


@job("pattern_3hop", PATTERN_SQL)
def pattern_3hop(spark, d):
    return sg.exact_answer(_g(spark, d)).orderBy("oid")


GRAPH_BUCKETS = 8


def _bucketed(spark, d) -> match.SupplyGraph:
    """The graph as bucketed tables, written once in a session."""
    cache = spark.__dict__.setdefault("_lakegraph_bucketed", {})
    if d not in cache:
        cache[d] = sg.bucketed_graph(_g(spark, d), f"graph_{uuid.uuid4().hex}", GRAPH_BUCKETS)
    return cache[d]


@job("pattern_3hop_stored", SQL["pattern_3hop"])
def pattern_3hop_stored(spark, d):
    return match.pattern_3hop(_bucketed(spark, d), sg.high_delayed_codes(), sg.failed(), sg.high_risk())


@job("pattern_paths_stored", SQL["pattern_3hop"])
def pattern_paths_stored(spark, d):
    return match.pattern_paths(_bucketed(spark, d), sg.high_delayed(), sg.failed(), sg.high_risk())


@job("build_edges", "WITH " + GRAPH_CTES + """
SELECT 'CONTAINS' AS edge_type, CAST(order_id AS VARCHAR) AS src_id,
       CAST(batch_part AS VARCHAR) || '-' || CAST(batch_supp AS VARCHAR) AS dst_id FROM contains_e
UNION ALL
SELECT 'MANUFACTURED_BY', CAST(batch_part AS VARCHAR) || '-' || CAST(batch_supp AS VARCHAR),
       CAST(supplier_id AS VARCHAR) FROM made_by_e
UNION ALL
SELECT 'STORED_IN', CAST(batch_part AS VARCHAR) || '-' || CAST(batch_supp AS VARCHAR),
       CAST(warehouse_id AS VARCHAR) FROM stored_in_e""")
def build_edges(spark, d):
    return sg.edge_list(_g(spark, d))


@job("project_nodes", "WITH " + GRAPH_CTES + """
SELECT batch_part, batch_supp, product, quality_status,
       coalesce(product, 'None') || ' batch ' || CAST(batch_part AS VARCHAR) || '-' || CAST(batch_supp AS VARCHAR) ||
       ' quality ' || quality_status || ' supplier ' || CAST(batch_supp AS VARCHAR) AS description
FROM batches""")
def project_nodes(spark, d):
    return _g(spark, d).batches.select("batch_part", "batch_supp", "product", "quality_status",
                                       "description")


@job("merged_nodes", """
SELECT DISTINCT 'Order' AS label, CAST(o.o_orderkey AS VARCHAR) AS id,
       'customer=' || coalesce(c.c_name, 'None') || '|status=' || (CASE o.o_orderstatus WHEN 'P' THEN 'DELAYED' WHEN 'F' THEN 'SHIPPED'
       WHEN 'O' THEN 'PENDING' ELSE o.o_orderstatus END) || '|priority=' || (CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'HIGH'
       WHEN o.o_orderpriority = '3-MEDIUM' THEN 'MEDIUM' ELSE 'LOW' END) || '|order_date=' || strftime(o.o_orderdate, '%Y-%m-%d') AS properties
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey WHERE o.o_orderkey IN (SELECT l_orderkey FROM lineitem)
UNION ALL
SELECT DISTINCT 'Supplier', CAST(s_suppkey AS VARCHAR), 'name=' || s_name || '|country=' || coalesce(n_name, 'None') || '|risk_tier=' ||
       (CASE WHEN s_acctbal < 1000 THEN 'HIGH' WHEN s_acctbal < 5000 THEN 'MEDIUM' ELSE 'LOW' END)
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)
UNION ALL
SELECT DISTINCT 'Warehouse', CAST(n_nationkey AS VARCHAR), 'location=' || n_name || '|region=' || coalesce(r_name, 'None')
FROM nation LEFT JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey IN (SELECT l_partkey % 25 FROM lineitem)
UNION ALL
SELECT 'Batch', id, 'product=' || product || '|quality_status=' || q || '|description=' || product || ' batch ' || id || ' quality ' || q || ' supplier ' || supp
FROM (SELECT CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS id, coalesce(any_value(p_name), 'None') AS product,
             CASE WHEN count(*) FILTER (WHERE l_returnflag = 'R') > 0 THEN 'FAILED' ELSE 'PASSED' END AS q, CAST(l_suppkey AS VARCHAR) AS supp
      FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY l_partkey, l_suppkey)""")
def merged_nodes(spark, d):
    return sg.merged_nodes(spark, d)


@job("describe_entities", "WITH " + GRAPH_CTES + """
SELECT batch_part, batch_supp,
       concat(coalesce(product, 'None'), ' batch ', CAST(batch_part AS VARCHAR) || '-' || CAST(batch_supp AS VARCHAR),
              ' quality ', quality_status) AS embed_text,
       concat(coalesce(product, 'None'), ' batch ', CAST(batch_part AS VARCHAR) || '-' || CAST(batch_supp AS VARCHAR),
              ' quality ', quality_status, ' supplier ', CAST(batch_supp AS VARCHAR)) AS stored_text
FROM batches""")
def describe_entities(spark, d):
    b = _g(spark, d).batches
    bid = sg.batch_id_text(F.col("batch_part"), F.col("batch_supp"))
    base = [py_str("product"), F.lit(" batch "), bid, F.lit(" quality "), F.col("quality_status")]
    return b.select("batch_part", "batch_supp", F.concat(*base).alias("embed_text"),
                    F.concat(*base, F.lit(" supplier "), F.col("batch_supp").cast("string"))
                    .alias("stored_text"))


@job("graph_node_counts", "WITH " + GRAPH_CTES + """
SELECT 'Batch' AS label, count(*) AS n FROM batches
UNION ALL SELECT 'Order', count(*) FROM orders_n
UNION ALL SELECT 'Supplier', count(*) FROM suppliers_n
UNION ALL SELECT 'Warehouse', count(*) FROM warehouses_n
ORDER BY label""")
def graph_node_counts(spark, d):
    return graph.node_counts(_g(spark, d).property_graph())


@job("graph_edge_counts", "WITH " + GRAPH_CTES + """
SELECT 'CONTAINS' AS edge_type, count(*) AS n FROM contains_e
UNION ALL SELECT 'MANUFACTURED_BY', count(*) FROM made_by_e
UNION ALL SELECT 'STORED_IN', count(*) FROM stored_in_e
ORDER BY edge_type""")
def graph_edge_counts(spark, d):
    return graph.edge_counts(_g(spark, d).property_graph())


@job("key_violations", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def key_violations(spark, d):
    return graph.key_violations(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


@job("label_key_report", """
WITH k AS (SELECT 'Batch' AS label, count(*) AS n FROM lineitem GROUP BY l_partkey, l_suppkey
           UNION ALL SELECT 'Order', count(*) FROM orders GROUP BY o_orderkey
           UNION ALL SELECT 'Supplier', count(*) FROM supplier GROUP BY s_suppkey
           UNION ALL SELECT 'Warehouse', count(*) FROM nation GROUP BY n_nationkey)
SELECT label, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, count(*) FILTER (WHERE n > 1) AS n_repeated,
       CAST(0 AS BIGINT) AS n_null FROM k GROUP BY label""")
def label_key_report(spark, d):
    return graph.label_key_report(sg.node_sources(spark, d))


UPSERT_CTES = f"""
WITH b AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{SNAPSHOT}'),
u AS (SELECT o_orderkey, o_custkey,
             CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
             o_totalprice, o_orderdate, o_orderpriority
      FROM orders WHERE o_orderdate >= TIMESTAMP '{UPDATES_FROM}')
SELECT coalesce(b.o_orderkey, u.o_orderkey) AS o_orderkey,
       CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_custkey ELSE b.o_custkey END AS o_custkey,
       CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus,
       CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_totalprice ELSE b.o_totalprice END AS o_totalprice,
       CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_orderdate ELSE b.o_orderdate END AS o_orderdate,
       CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_orderpriority ELSE b.o_orderpriority END AS o_orderpriority"""
UPSERT_FROM = " FROM b FULL OUTER JOIN u ON b.o_orderkey = u.o_orderkey"


@job("upsert", UPSERT_CTES + """,
       CASE WHEN b.o_orderkey IS NULL THEN 'insert' WHEN u.o_orderkey IS NOT NULL THEN 'update'
            ELSE 'keep' END AS change""" + UPSERT_FROM)
def upsert(spark, d):
    o = Tables(spark, d).orders
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    base = o.filter(F.col("o_orderdate") < ts(SNAPSHOT))
    upd = o.filter(F.col("o_orderdate") >= ts(UPDATES_FROM)).withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus")))
    return graph.upsert(base, upd, ["o_orderkey"])


NODE_BUCKETS = 16


@job("upsert_stored", UPSERT_CTES + UPSERT_FROM)
def upsert_stored(spark, d):
    # the snapshot as a stored table, the updates merged into its buckets, read back
    o = Tables(spark, d).orders
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    nodes = stored.StoredNodes.create(o.filter(F.col("o_orderdate") < ts(SNAPSHOT)), ["o_orderkey"], shared_dir(spark, "nodes"), NODE_BUCKETS)
    nodes.merge(o.filter(F.col("o_orderdate") >= ts(UPDATES_FROM)).withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus"))))
    return nodes.rows


@job("dangling_refs", """
SELECT 'lineitem.l_orderkey->orders' AS reference, count(*) AS n_refs,
       count(*) FILTER (WHERE o.o_orderkey IS NULL) AS n_dangling
FROM lineitem l LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders) o ON l.l_orderkey = o.o_orderkey
UNION ALL
SELECT 'lineitem.l_partkey->part', count(*), count(*) FILTER (WHERE p.p_partkey IS NULL)
FROM lineitem l LEFT JOIN (SELECT DISTINCT p_partkey FROM part) p ON l.l_partkey = p.p_partkey
UNION ALL
SELECT 'lineitem.l_suppkey->supplier', count(*), count(*) FILTER (WHERE s.s_suppkey IS NULL)
FROM lineitem l LEFT JOIN (SELECT DISTINCT s_suppkey FROM supplier) s ON l.l_suppkey = s.s_suppkey
UNION ALL
SELECT 'orders.o_custkey->customer', count(*), count(*) FILTER (WHERE c.c_custkey IS NULL)
FROM orders o LEFT JOIN (SELECT DISTINCT c_custkey FROM customer) c ON o.o_custkey = c.c_custkey
UNION ALL
SELECT 'embeddings.vec_id->part', count(*), count(*) FILTER (WHERE p.p_partkey IS NULL)
FROM embeddings e LEFT JOIN (SELECT DISTINCT p_partkey FROM part) p ON e.vec_id = p.p_partkey""")
def dangling_refs(spark, d):
    t = Tables(spark, d)
    li = t.lineitem
    return graph.dangling_summary({
        "lineitem.l_orderkey->orders": (li, ["l_orderkey"], t.orders, ["o_orderkey"]),
        "lineitem.l_partkey->part": (li, ["l_partkey"], t.part, ["p_partkey"]),
        "lineitem.l_suppkey->supplier": (li, ["l_suppkey"], t.supplier, ["s_suppkey"]),
        "orders.o_custkey->customer": (t.orders, ["o_custkey"], t.customer, ["c_custkey"]),
        "embeddings.vec_id->part": (t.embeddings, ["vec_id"], t.part, ["p_partkey"]),
    })


EXPAND_SQL_SELECT = """
SELECT c.batch_part, c.batch_supp, c.order_id, o.customer, o.status, o.priority,
       b.product, b.quality_status, s.name AS supplier_name, s.risk_tier AS supplier_risk,
       w.location AS warehouse_location
FROM seeds sd
JOIN contains_e c ON c.batch_part = sd.batch_part AND c.batch_supp = sd.batch_supp
JOIN orders_n o ON o.order_id = c.order_id
JOIN batches b ON b.batch_part = c.batch_part AND b.batch_supp = c.batch_supp
LEFT JOIN made_by_e m ON m.batch_part = b.batch_part AND m.batch_supp = b.batch_supp
LEFT JOIN suppliers_n s ON s.supplier_id = m.supplier_id
LEFT JOIN stored_in_e si ON si.batch_part = b.batch_part AND si.batch_supp = b.batch_supp
LEFT JOIN warehouses_n w ON w.warehouse_id = si.warehouse_id"""


@job("seeded_expand", "WITH " + GRAPH_CTES + ", seeds AS (SELECT batch_part, batch_supp FROM batches)"
     + EXPAND_SQL_SELECT)
def seeded_expand(spark, d):
    g = _g(spark, d)
    return match.seeded_expand(g.batches, g, whole=True)      # every batch node is a seed


@job("expand_inner", "WITH " + GRAPH_CTES + """
SELECT b.batch_part, b.batch_supp, o.order_id, o.customer, o.status, o.priority
FROM batches b JOIN contains_e c ON c.batch_part = b.batch_part AND c.batch_supp = b.batch_supp
JOIN orders_n o ON o.order_id = c.order_id
WHERE b.quality_status = 'FAILED'""")
def expand_inner(spark, d):
    # the seeds here are the FAILED batches; every batch is a seed in seeded_expand
    g = _g(spark, d)
    seeds = g.batch_keys.filter(sg.failed()).select(*g.batch_key)   # no product join needed
    return match.expand_inner(seeds, g).select(*g.batch_key, "order_id", "customer", "status",
                                               "priority")


@job("expand_optional", "WITH " + GRAPH_CTES + """
SELECT b.batch_part, b.batch_supp, s.name AS supplier_name, s.risk_tier AS supplier_risk,
       w.location AS warehouse_location
FROM batches b
LEFT JOIN made_by_e m ON m.batch_part = b.batch_part AND m.batch_supp = b.batch_supp
LEFT JOIN suppliers_n s ON s.supplier_id = m.supplier_id
LEFT JOIN stored_in_e si ON si.batch_part = b.batch_part AND si.batch_supp = b.batch_supp
LEFT JOIN warehouses_n w ON w.warehouse_id = si.warehouse_id""")
def expand_optional(spark, d):
    g = _g(spark, d)
    seeds = g.batch_keys.select(*g.batch_key, "supplier_id", "warehouse_id")   # carry their references
    return match.expand_optional(seeds, g)


# =================================================================== vectors

@job("attach_vectors", "WITH " + GRAPH_CTES + """
SELECT b.batch_part, b.batch_supp, e.vec_id, CAST(len(e.embedding) AS INTEGER) AS dim, e.label,
       round(list_sum(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE))), 6) AS vector_sum
FROM batches b LEFT JOIN embeddings e ON e.vec_id = b.batch_part""")
def attach_vectors(spark, d):
    g = _g(spark, d)
    emb = Tables(spark, d).embeddings
    v = vectors.attach_vectors(g.batch_keys.select(*g.batch_key), "batch_part",
                               emb.withColumn("vec_id_", F.col("vec_id")), "vec_id_")
    total = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double"))
    return v.select("batch_part", "batch_supp", "vec_id", F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("dim"),
                    "label", r6(total).alias("vector_sum"))


@job("text_vectors")   # TF-IDF vectors of whole documents: no SQL twin; text_tokens checks the words
def text_vectors(spark, d):
    return vectors.text_vectors(Tables(spark, d).documents, "doc_id", "text")


@job("text_tokens", r"""
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents)
SELECT doc_id, CAST(len(w) AS INTEGER) AS n_tokens, CAST(len(list_distinct(w)) AS INTEGER) AS n_terms FROM t""")
def text_tokens(spark, d):
    return vectors.text_tokens(Tables(spark, d).documents, "doc_id", "text")


@job("vector_audit", f"""
SELECT count(*) AS n_vectors, count(*) FILTER (WHERE embedding IS NULL) AS n_null,
       count(*) FILTER (WHERE embedding IS NOT NULL AND len(embedding) <> {EMBED_DIM}) AS n_wrong_dim,
       count(*) FILTER (WHERE embedding IS NOT NULL AND list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) = 0) AS n_zero_norm,
       count(*) FILTER (WHERE embedding IS NOT NULL AND abs(sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) - 1.0) > 1e-3) AS n_not_unit,
       CAST(min(len(embedding)) AS INTEGER) AS min_dim, CAST(max(len(embedding)) AS INTEGER) AS max_dim
FROM embeddings""")
def vector_audit(spark, d):
    return vectors.vector_audit(Tables(spark, d).embeddings, "embedding", EMBED_DIM)


def knn_sql(k: int) -> str:
    """Questions are the per-label mean vectors; top-k embeddings by cosine."""
    return f"""
ex AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
pm AS (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS m FROM ex GROUP BY label, pos),
q AS (SELECT label AS query_id, list(m ORDER BY pos) AS centroid FROM pm GROUP BY label),
sc AS (SELECT q.query_id, e.vec_id,
              list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), q.centroid) AS score
       FROM q, embeddings e),
hits AS (SELECT query_id, vec_id, score,
                CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
         FROM sc QUALIFY rank <= {k})"""


def _hits(spark, d, k):
    emb = Tables(spark, d).embeddings
    q = vectors.centroids(emb, "label", "embedding")
    return vectors.knn_exact(emb, "vec_id", "embedding", q, "label", "centroid", k, EMBED_DIM)


@job("knn_exact", "WITH " + knn_sql(K_SEARCH) + " SELECT query_id, vec_id, round(score, 6) AS score, rank FROM hits")
def knn_exact(spark, d):
    return _hits(spark, d, K_SEARCH).withColumn("score", r6("score"))


def _cell_hits(spark, d):
    emb = Tables(spark, d).embeddings
    q = vectors.centroids(emb, "label", "embedding")
    return vectors.knn_cells(emb, "vec_id", "embedding", q, "label", "centroid", K_SEARCH, EMBED_DIM)


@job("knn_lsh")   # approximate (clusters): recall tested against knn_exact, exact facts checked by knn_approx_facts
def knn_lsh(spark, d):
    return _cell_hits(spark, d).withColumn("score", r6("score"))


@job("knn_approx_facts", "WITH " + knn_sql(K_SEARCH) + """
SELECT query_id, count(*) AS n_hits, count(*) AS n_true_scores FROM hits GROUP BY query_id""")
def knn_approx_facts(spark, d):
    # every question gets k rows, and each returned score is the pair's true cosine
    emb = Tables(spark, d).embeddings
    q = vectors.centroids(emb, "label", "embedding")
    hits = _cell_hits(spark, d).join(emb.select("vec_id", "embedding"), "vec_id") \
        .join(q.select(F.col("label").alias("query_id"), "centroid"), "query_id")
    dot = F.aggregate(F.zip_with("embedding", "centroid", lambda x, y: x.cast("double") * y), F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    true = F.abs(dot / (norm("embedding") * norm("centroid")) - F.col("score")) < 1e-6
    return hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_hits"), F.count_if(true).alias("n_true_scores"))


INDEX_PROBE, INDEX_RERANK = 56, 48
_INDEXES: dict[tuple[str, str], vector_index.VectorIndex] = {}


def stored_index(spark, d) -> vector_index.VectorIndex:
    """The vector index of a table folder, built once in a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _INDEXES:
        _INDEXES[key] = vector_index.build(Tables(spark, d).embeddings, "vec_id", "embedding", EMBED_DIM)
    return _INDEXES[key]


def _asked(spark, d):
    """Every 50th vector asks all vectors."""
    return Tables(spark, d).embeddings.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))


ASKED_SQL = f"""
q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 50 = 0),
sc AS (SELECT q.query_id, e.vec_id, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), q.v) AS score FROM q, embeddings e),
hits AS (SELECT query_id, vec_id, score,
                CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, {vectors.DIGITS}) DESC, vec_id) AS INTEGER) AS rank
         FROM sc QUALIFY rank <= {K_SEARCH})"""


@job("knn_index_exact", "WITH " + ASKED_SQL + " SELECT query_id, vec_id, round(score, 6) AS score, rank FROM hits")
def knn_index_exact(spark, d):
    hits, _ = vector_index.search_exact(stored_index(spark, d), _asked(spark, d), "query_id", "q", K_SEARCH)
    return hits.withColumn("score", r6("score"))


@job("knn_index_recall", "WITH " + ASKED_SQL + """
SELECT (SELECT count(*) FROM q) AS n_queries, count(*) AS n_hits, true AS recall_of_90_percent, true AS compared_at_most_10_percent FROM hits""")
def knn_index_recall(spark, d):
    # the code search against the exact rows: hits, recall, pairs compared at full precision
    index, q, emb = stored_index(spark, d), _asked(spark, d), Tables(spark, d).embeddings
    exact = vectors.knn_exact(emb, "vec_id", "embedding", q, "query_id", "q", K_SEARCH, EMBED_DIM).select("query_id", "vec_id", F.lit(True).alias("true"))
    hits = vector_index.search_codes(index, q, "query_id", "q", K_SEARCH, INDEX_PROBE, INDEX_RERANK)
    found = exact.join(hits.select("query_id", "vec_id", F.lit(True).alias("hit")), ["query_id", "vec_id"], "full").agg(
        F.count("hit").alias("n_hits"), (F.count(F.col("true") & F.col("hit")) / F.count("true")).alias("recall"))
    pairs = vector_index.candidates(index, q, "query_id", "q", INDEX_PROBE, INDEX_RERANK).agg(F.count(F.lit(1)).alias("pairs"))
    n_queries, n = (x.agg(F.count(F.lit(1))).scalar() for x in (q, emb))
    return found.select(n_queries.alias("n_queries"), "n_hits", (F.col("recall") >= 0.9).alias("recall_of_90_percent"),
                        (pairs.scalar() <= n_queries * n * 0.1).alias("compared_at_most_10_percent"))


CONTEXT_SQL = "WITH " + knn_sql(K_CONTEXT) + """,
lines AS (SELECT h.query_id, h.rank, h.score,
                 CAST(h.vec_id AS VARCHAR) || ' | ' || p.p_name || ' | type: ' || p.p_type AS ctx
          FROM hits h LEFT JOIN part p ON p.p_partkey = h.vec_id),
ctx AS (SELECT query_id,
               string_agg('- ' || coalesce(ctx, 'None') || ' (score: ' || printf('%.3f', score) || ')', chr(10) ORDER BY rank) AS context,
               count(*) AS n_hits
        FROM lines GROUP BY query_id)
"""


def _context(spark, d):
    hits = _hits(spark, d, K_CONTEXT)
    part = Tables(spark, d).part.select(F.col("p_partkey").alias("vec_id"), "p_name", "p_type")
    lines = hits.join(part, "vec_id", "left").withColumn(
        "ctx", retrieve.hit_line("vec_id", "p_name", "type", "p_type"))
    return retrieve.vector_context(lines)


@job("vector_context", CONTEXT_SQL + "SELECT query_id, context, n_hits FROM ctx")
def vector_context(spark, d):
    return _context(spark, d)


@job("prompt_table", CONTEXT_SQL + f"""
SELECT query_id, '{retrieve.SYSTEM_PROMPT}' AS system_prompt,
       'Context:' || chr(10) || context || chr(10) || chr(10) || 'Question: ' || '{retrieve.QUESTION}' AS user_prompt
FROM ctx""")
def prompt_table(spark, d):
    return retrieve.prompt_table(_context(spark, d))


RETRIEVE_SQL = "WITH " + GRAPH_CTES + "," + knn_sql(K_SEARCH) + """,
seeds AS (SELECT h.query_id, h.rank AS seed_rank, b.batch_part, b.batch_supp
          FROM hits h JOIN batches b ON b.batch_part = h.vec_id),
ret AS (SELECT sd.query_id, sd.seed_rank, c.batch_part, c.batch_supp, c.order_id, o.customer, o.status,
               o.priority, b.product, b.quality_status, s.name AS supplier_name,
               s.risk_tier AS supplier_risk, w.location AS warehouse_location
        FROM seeds sd
        JOIN contains_e c ON c.batch_part = sd.batch_part AND c.batch_supp = sd.batch_supp
        JOIN orders_n o ON o.order_id = c.order_id
        JOIN batches b ON b.batch_part = c.batch_part AND b.batch_supp = c.batch_supp
        LEFT JOIN made_by_e m ON m.batch_part = b.batch_part AND m.batch_supp = b.batch_supp
        LEFT JOIN suppliers_n s ON s.supplier_id = m.supplier_id
        LEFT JOIN stored_in_e si ON si.batch_part = b.batch_part AND si.batch_supp = b.batch_supp
        LEFT JOIN warehouses_n w ON w.warehouse_id = si.warehouse_id)
"""


def _retrieved(spark, d, g=None, hits=None):
    g = g or _g(spark, d)
    hits = hits if hits is not None else _hits(spark, d, K_SEARCH)
    seeds = (hits.select("query_id", F.col("rank").alias("seed_rank"), F.col("vec_id").alias("batch_part"))
                 .join(g.batch_keys.select(*g.batch_key), "batch_part"))
    return retrieve.vector_graph_retrieve(seeds, g, carry=["seed_rank"])


@job("vector_graph_retrieve", RETRIEVE_SQL + "SELECT * FROM ret")
def vector_graph_retrieve(spark, d):
    return _retrieved(spark, d)


@job("retrieval_items", RETRIEVE_SQL + """
SELECT query_id,
       'Order ' || coalesce(CAST(order_id AS VARCHAR), 'None') || ' (' || coalesce(customer, 'None') || ', ' ||
       coalesce(status, 'None') || ', priority:' || coalesce(priority, 'None') || ') | Batch ' ||
       (CAST(batch_part AS VARCHAR) || '-' || CAST(batch_supp AS VARCHAR)) || ' (' || coalesce(product, 'None') ||
       ') | quality: ' || coalesce(quality_status, 'None') || ' | supplier: ' || coalesce(supplier_name, 'None') ||
       ' [risk:' || coalesce(supplier_risk, 'None') || '] | warehouse: ' || coalesce(warehouse_location, 'None') AS content,
       CAST(order_id AS VARCHAR) AS metadata_order_id
FROM ret""")
def retrieval_items(spark, d):
    items = retrieve.retrieval_items(_retrieved(spark, d),
                                     sg.batch_id_text(F.col("batch_part"), F.col("batch_supp")),
                                     keep=["query_id"])
    return items.select("query_id", "content",
                        F.col("metadata")["order_id"].alias("metadata_order_id"))


@job("graph_prompts", RETRIEVE_SQL + f"""
SELECT query_id, seed_rank, CAST(order_id AS VARCHAR) AS order_id, batch_part, batch_supp,
       '{retrieve.SYSTEM_PROMPT}' AS system_prompt, '{retrieve.QUESTION}' AS question
FROM ret""")
def graph_prompts(spark, d):
    # the prompt parts of the graph path: one row per item, so no text grows with a seed's orders
    return _retrieved(spark, d).select("query_id", "seed_rank", F.col("order_id").cast("string").alias("order_id"), "batch_part",
                                       "batch_supp", F.lit(retrieve.SYSTEM_PROMPT).alias("system_prompt"),
                                       F.lit(retrieve.QUESTION).alias("question"))


PROMPT_CHARS = 4000


@job("graph_prompt_parts", RETRIEVE_SQL + f""",
items AS (SELECT query_id, seed_rank, order_id, batch_part, batch_supp,
       'Order ' || coalesce(CAST(order_id AS VARCHAR), 'None') || ' (' || coalesce(customer, 'None') || ', ' ||
       coalesce(status, 'None') || ', priority:' || coalesce(priority, 'None') || ') | Batch ' ||
       (CAST(batch_part AS VARCHAR) || '-' || CAST(batch_supp AS VARCHAR)) || ' (' || coalesce(product, 'None') ||
       ') | quality: ' || coalesce(quality_status, 'None') || ' | supplier: ' || coalesce(supplier_name, 'None') ||
       ' [risk:' || coalesce(supplier_risk, 'None') || '] | warehouse: ' || coalesce(warehouse_location, 'None') AS content FROM ret),
cut AS (SELECT *, CAST((sum(length(content)) OVER (PARTITION BY query_id ORDER BY seed_rank, order_id, batch_part, batch_supp) - length(content))
  // {PROMPT_CHARS} AS BIGINT) AS part FROM items)
SELECT query_id, part, count(*) AS n_items, '{retrieve.SYSTEM_PROMPT}' AS system_prompt,
       'Context:' || chr(10) || string_agg('- ' || content, chr(10) ORDER BY seed_rank, order_id, batch_part, batch_supp) ||
       chr(10) || chr(10) || 'Question: ' || '{retrieve.QUESTION}' AS user_prompt FROM cut GROUP BY query_id, part""")
def graph_prompt_parts(spark, d):
    # the whole prompt text of the graph path, in parts of bounded size
    keys = ["seed_rank", "order_id", "batch_part", "batch_supp"]
    items = retrieve.retrieval_items(_retrieved(spark, d), sg.batch_id_text(F.col("batch_part"), F.col("batch_supp")), keep=["query_id", *keys])
    return retrieve.prompt_parts(items, keys, "content", PROMPT_CHARS)


def _evaluated(spark, d):
    """Retrieved ids, exact ids and the questions, each written once: hits and
    the exact answer feed several branches."""
    g = _g(spark, d)
    hits = _kept(spark, _hits(spark, d, K_SEARCH), "eval_hits")
    truth_rows = _kept(spark, sg.exact_answer(g), "eval_truth")
    # the evaluation needs the retrieved orders only, not their properties
    seeds = hits.select("query_id", F.col("vec_id").alias("batch_part"))
    orders = Tables(spark, d).orders.select(F.col("o_orderkey").alias("order_id"))
    found = g.contains_rows.join(seeds, "batch_part").select("query_id", "order_id").distinct() \
             .join(orders, "order_id", "left_semi")
    retrieved = (hits.select("query_id", F.lit("vector").alias("method"), F.col("vec_id").alias("item_id"))
                 .unionByName(found.select("query_id", F.lit("graph").alias("method"),
                                           F.col("order_id").alias("item_id"))))
    truth = truth_rows.select(F.inline(F.array(
        F.struct(F.lit("vector").alias("method"), F.col("batch_part").alias("item_id")),
        F.struct(F.lit("graph").alias("method"), F.col("oid").alias("item_id")))))
    asked = Tables(spark, d).embeddings.filter("embedding is not null").select(F.col("label").alias("query_id")).distinct() \
        .select("query_id", F.explode(F.array(F.lit("vector"), F.lit("graph"))).alias("method"))
    return retrieved, truth, asked


def _kept(spark, df, name):
    path = shared_dir(spark, name)
    io.write_table(df, path=path)
    return io.read_table(spark, path=path)


@job("retrieval_eval")   # SQL twin set below (_eval_sql)
def retrieval_eval(spark, d):
    out = evaluate.retrieval_eval(*_evaluated(spark, d))
    return out.withColumns({"precision": r6("precision"), "recall": r6("recall")})


@job("retrieval_missing")   # SQL twin set below
def retrieval_missing(spark, d):
    return evaluate.missing_items(*_evaluated(spark, d))


EVAL_CTES = RETRIEVE_SQL + f""",
tr AS ({PATTERN_SELECT}),
asked AS (SELECT q.query_id, m.method FROM (SELECT DISTINCT label AS query_id FROM embeddings) q,
          (SELECT unnest(['vector', 'graph']) AS method) m),
retrieved AS (SELECT DISTINCT query_id, 'vector' AS method, vec_id AS item_id FROM hits
              UNION SELECT DISTINCT query_id, 'graph', order_id FROM ret),
truth AS (SELECT DISTINCT 'vector' AS method, batch_part AS item_id FROM tr
          UNION SELECT DISTINCT 'graph', oid FROM tr)"""

SQL["retrieval_eval"] = (EVAL_CTES + """,
c AS (SELECT a.query_id, a.method,
             (SELECT count(*) FROM retrieved r WHERE r.query_id = a.query_id AND r.method = a.method) AS n_retrieved,
             (SELECT count(*) FROM truth t WHERE t.method = a.method) AS n_relevant,
             (SELECT count(*) FROM retrieved r JOIN truth t ON t.method = r.method AND t.item_id = r.item_id
              WHERE r.query_id = a.query_id AND r.method = a.method) AS n_hits FROM asked a)
SELECT query_id, method, n_retrieved, n_relevant, n_hits, n_relevant - n_hits AS n_missing,
       round(CASE WHEN n_retrieved > 0 THEN n_hits / n_retrieved END, 6) AS precision,
       round(CASE WHEN n_relevant > 0 THEN n_hits / n_relevant END, 6) AS recall FROM c""").strip()
SQL["retrieval_missing"] = (EVAL_CTES + """
SELECT a.query_id, a.method, t.item_id FROM asked a JOIN truth t ON t.method = a.method
EXCEPT SELECT query_id, method, item_id FROM retrieved""").strip()
