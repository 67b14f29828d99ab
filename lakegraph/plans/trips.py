"""The trip pipeline's roles bound to the warehouse tables.

trip = lineitem row; trip_distance = l_quantity; fare_amount = l_extendedprice;
pickup = l_shipdate; dropoff = l_shipdate + l_linenumber days;
VendorID = l_linenumber; store_and_fwd_flag "Y" = l_returnflag "R";
PULocationID = l_suppkey; zone lookup = supplier x nation x region with a
text LocationID.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegraph.sources.testdata import Tables

DIST, FARE, PICKUP, DROPOFF = "l_quantity", "l_extendedprice", "l_shipdate", "l_dropoff"
VENDOR, FLAG, FLAG_TRUE, LOC = "l_linenumber", "l_returnflag", "R", "l_suppkey"
# The tables hold no trip with a non-positive distance, so the validity test
# uses a distance threshold that actually rejects rows.
VALID = {DIST: 5.0, FARE: 0.0}


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    return li.withColumn(DROPOFF, F.col(PICKUP) + F.make_dt_interval(days=F.col(VENDOR)))


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LocationID (text), Borough, Zone, service_zone."""
    t = Tables(spark, sf_dir)
    return (t.supplier
            .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(F.col("s_suppkey").cast("string").alias("LocationID"),
                    F.col("r_name").alias("Borough"), F.col("n_name").alias("Zone"),
                    F.col("s_name").alias("service_zone")))
