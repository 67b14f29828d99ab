"""Cleansing, profiles and the lookup join on small hand-made trip rows."""

import math
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakegraph import schemas
from lakegraph.operators import aggregate as agg
from lakegraph.operators import cleanse, profile
from lakegraph.session import shared_dir
from lakegraph.sources import io

NAN = float("nan")


@pytest.fixture(scope="module")
def trips(spark):
    import datetime as dt
    d = dt.datetime
    rows = [
        (1, d(2022, 8, 1, 10), d(2022, 8, 1, 10, 20), "Y", 10, 2.5, 12.0),
        (2, d(2022, 8, 1, 11), d(2022, 8, 1, 11, 30), "N", 10, 0.0, 8.0),     # distance 0
        (1, d(2022, 8, 2, 9), d(2022, 8, 2, 9, 15), "y", 11, 1.0, -1.0),      # fare -1
        (2, d(2022, 8, 2, 12), d(2022, 8, 2, 12, 5), None, 11, 3.0, None),    # null fare
        (1, d(2022, 8, 3, 8), d(2022, 8, 3, 8, 45), "Y", 12, 4.0, NAN),       # NaN fare: kept
        (2, d(2022, 9, 1, 7), d(2022, 9, 1, 7, 10), "N", 12, 5.0, 20.0),
        (1, d(2022, 9, 2, 7), d(2022, 9, 2, 7, 10), "N", 13, 6.0, 30.0),
    ]
    return spark.createDataFrame(rows, schemas.TRIPS)


VALID = {"trip_distance": 0.0, "fare_amount": 0.0}


def test_filter_keeps_nan_drops_null_and_nonpositive(trips):
    kept = cleanse.filter_valid(trips, VALID).collect()
    assert len(kept) == 4
    assert any(math.isnan(r.fare_amount) for r in kept)
    r = cleanse.rejected_count(trips, VALID).first()
    assert (r.n_total, r.n_kept, r.n_rejected) == (7, 4, 3)


def test_flag_to_boolean(trips):
    out = [r.f for r in trips.select(cleanse.flag_to_boolean("store_and_fwd_flag").alias("f")).collect()]
    assert out == [True, False, False, False, True, False, False]


def test_cleanse_replaces_in_place(trips):
    out = cleanse.cleanse(trips, VALID, flag_col="store_and_fwd_flag",
                          timestamp_cols=["lpep_pickup_datetime"])
    assert out.columns == trips.columns
    assert dict(out.dtypes)["store_and_fwd_flag"] == "boolean"


def test_lenient_timestamp_cast(spark):
    df = spark.createDataFrame([("2022-08-01 10:00:00",), ("not a time",)], "s string")
    out = [r.t for r in df.select(cleanse.to_timestamp_col("s", lenient=True).alias("t")).collect()]
    assert out[0] is not None and out[1] is None


def test_counts_and_coverage(trips):
    assert {r.VendorID: r["count"] for r in profile.group_count(trips, "VendorID").collect()} == {1: 4, 2: 3}
    days = {r.pickup_date: r["count"] for r in profile.daily_counts(trips, "lpep_pickup_datetime").collect()}
    assert days["2022-08-01"] == 2 and len(days) == 5
    mm = profile.min_max(trips, "trip_distance").first()
    assert (mm["min"], mm["max"]) == (0.0, 6.0)


def test_monthly_average(trips):
    clean = cleanse.filter_valid(trips, VALID).filter(~F.isnan("fare_amount"))
    rows = agg.monthly_average(clean, "lpep_pickup_datetime", "fare_amount").collect()
    assert [(r.year, r.month, r.average_fare) for r in rows] == [(2022, 8, 12.0), (2022, 9, 25.0)]


def test_lookup_join_csv_feature_and_zone_average(spark, trips):
    lookup_rows = [("10", "B1", "Zone A", "x"), ("11", "B1", "Zone A", "x"),   # two locations, one zone
                   ("12", "B2", "Zone B", "y"), ("xx", "B3", "Bad", "z"),       # malformed key
                   ("99", "B4", "Unused", "w")]                                 # no trips
    path = shared_dir(spark, "test_lookup")
    io.write_csv(spark.createDataFrame(lookup_rows, ",".join(f"{c} string" for c in schemas.ZONE_LOOKUP_COLUMNS)), path)
    lookup = io.read_csv_strings(spark, path, schemas.ZONE_LOOKUP_COLUMNS)
    assert all(t == "string" for _, t in lookup.dtypes)
    clean = trips.filter(F.col("fare_amount").isNotNull() & ~F.isnan("fare_amount"))
    by_loc = agg.avg_by_key(clean, "PULocationID", "fare_amount")
    joined = agg.join_lookup(by_loc, "PULocationID", lookup, "LocationID")
    assert {"PULocationID", "LocationID"} <= set(joined.columns)
    feats = agg.feature_table(joined)
    assert feats.columns == ["avg_fare_amount", "Zone"]
    za = {r.Zone: r.total_avg for r in agg.avg_of_avg(feats).collect()}
    # loc 10 avg (12+8)/2 = 10, loc 11 avg -1 -> zone A unweighted (10 + -1)/2 = 4.5
    assert za == {"Zone A": 4.5, "Zone B": 20.0}


def test_histogram_edges_and_counts(spark):
    vals = [0.0, 1.0, 2.5, 5.0, 10.0, 10.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    h = profile.histogram(df, "v", bins=4).orderBy("bin").collect()
    assert [r["count"] for r in h] == [2, 1, 1, 2]               # last bin closed on the right
    assert sum(r["count"] for r in h) == 6                        # = non-null count
    one = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    h1 = profile.histogram(one, "v", bins=5).collect()
    assert len(h1) == 5 and sum(r["count"] for r in h1) == 2
    empty = spark.createDataFrame([], "v double")
    assert profile.histogram(empty, "v", bins=5).count() == 0


def test_density_and_correlation(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(100)], "x double, y double")
    d = profile.density_2d(df, "x", "y", bins=10).collect()
    assert sum(r["count"] for r in d) == 100 and all(r.x_bin == r.y_bin for r in d)
    assert profile.correlation(df, "x", "y").first().corr == pytest.approx(1.0)


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles_match_duckdb_with_hot_value(spark, seed):
    rnd = random.Random(seed)
    vals = [rnd.choice([rnd.random() * 100, 42.0]) for _ in range(3000)]   # ~half on one value
    vals += [None] * 10
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r.quantile: r.value for r in profile.quantiles_exact(df, "v", probs).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in vals])
    want = con.execute(f"SELECT quantile_disc(v, {probs}) FROM t").fetchone()[0]
    assert [got[p] for p in probs] == want


def test_approx_quantile_rank_error(spark):
    rnd = np.random.default_rng(3)
    vals = rnd.exponential(10.0, 20000)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    got = profile.quantiles_approx(df, "v", probs, 0.01).collect()
    s = np.sort(vals)
    for r in got:
        rank = np.searchsorted(s, r.value, side="right")
        assert abs(rank - r.quantile * len(s)) <= 0.01 * len(s) + 1


def test_describe_and_schema_profile(spark, trips):
    d = profile.describe_typed(trips.filter(F.col("fare_amount") > 0), "fare_amount").first()
    assert d.n == 5 and d["min"] == 8.0          # NaN passes "> 0" and is counted
    rows = {r.column_name: r for r in profile.schema_profile(trips, approx_distinct=True).collect()}
    assert rows["fare_amount"].null_count == 1 and rows["store_and_fwd_flag"].null_count == 1
    assert rows["VendorID"].approx_distinct == 2 and rows["VendorID"].data_type == "bigint"
    stats = {r.summary for r in profile.describe_rows(trips, "fare_amount").collect()}
    assert stats == {"count", "mean", "stddev", "min", "max"}


def test_table_write_overwrite_and_read(spark, trips):
    path = shared_dir(spark, "test_table")
    io.write_table(trips, path=path)
    io.write_table(trips.limit(2), path=path)                    # full replace
    assert io.read_table(spark, path=path).count() == 2
    assert io.load_default(spark, path, header=True, inferSchema=True).count() == 2
    assert os.path.isdir(path)


def test_only_single_machine_sessions_bind_to_loopback():
    from lakegraph.session import DEFAULT_CONF, is_single_machine
    assert not any(k.startswith("spark.driver") for k in DEFAULT_CONF)
    assert is_single_machine("local[8]") and is_single_machine("local")
    assert not is_single_machine("local-cluster[3,2,1024]") and not is_single_machine("yarn")


def test_nan_takes_no_part_in_bins_and_quantiles(spark):
    rows = [(float(i), float(i % 7)) for i in range(100)] + [(float("nan"), 1.0)] * 100 + [(None, 2.0)]
    df = spark.createDataFrame(rows, "v double, w double").repartition(3)
    h = profile.histogram(df, "v", bins=50).collect()
    assert sum(r["count"] for r in h) == 100 and all(r["count"] == 2 for r in h)
    assert sum(r["count"] for r in profile.density_2d(df, "v", "w", bins=10).collect()) == 100
    exact = {r.quantile: r.value for r in profile.quantiles_exact(df, "v", [0.25, 0.5]).collect()}
    assert exact == {0.25: 24.0, 0.5: 49.0}
    approx = {r.quantile: r.value for r in profile.quantiles_approx(df, "v", [0.25, 0.5], 0.01).collect()}
    assert all(abs(approx[q] - exact[q]) <= 1 for q in exact)
    assert profile.correlation(df.filter("not isnan(v)"), "v", "w").first().n == 100


@pytest.mark.parametrize(("reuse", "parts"), [("true", 8), ("false", 64), ("false", 500)])
def test_exact_quantiles_do_not_depend_on_partitions(spark, reuse, parts):
    df = spark.range(40_000).select(((F.col("id") * 7919) % 100_003 / 7.0).alias("v"))
    want = sorted(r.v for r in df.collect())
    old = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = {r.quantile: r.value for r in profile.quantiles_exact(df.repartition(5), "v", [0.1, 0.5, 0.9]).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {p: want[max(1, int(np.ceil(p * len(want)))) - 1] for p in (0.1, 0.5, 0.9)}


def test_exact_quantiles_edges(spark):
    probs = [0.0, 0.5, 1.0]
    empty = spark.createDataFrame([(None,), (None,)], "v double")
    assert profile.quantiles_exact(empty, "v", probs).count() == 0
    one = spark.createDataFrame([(7.0,)] * 5, "v double")
    assert {r.quantile: r.value for r in profile.quantiles_exact(one, "v", probs).collect()} == \
        {0.0: 7.0, 0.5: 7.0, 1.0: 7.0}


def test_group_count_resolves_name_case_insensitively(trips):
    out = profile.group_count(trips, F.col("vendorID"))
    assert out.columns == ["vendorID", "count"]          # the requested spelling
    assert {r.vendorID: r["count"] for r in out.collect()} == {1: 4, 2: 3}
