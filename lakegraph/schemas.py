"""Explicit schemas for the supply-chain tables and the trip-shaped frames."""

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()


def _struct(*cols):
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SUPPLIERS = _struct(("supplier_id", S), ("name", S), ("country", S), ("risk_tier", S),
                    ("active_deliveries", L))
WAREHOUSES = _struct(("warehouse_id", S), ("location", S), ("region", S), ("capacity", L))
BATCHES = _struct(("batch_id", S), ("product", S), ("quality_status", S), ("mfg_date", S),
                  ("supplier_id", S), ("warehouse_id", S))
ORDERS = _struct(("order_id", S), ("customer", S), ("batch_id", S), ("status", S),
                 ("priority", S), ("order_date", S))

ZONE_LOOKUP_COLUMNS = ["LocationID", "Borough", "Zone", "service_zone"]

TRIPS = _struct(("VendorID", L), ("lpep_pickup_datetime", T.TimestampType()),
                ("lpep_dropoff_datetime", T.TimestampType()), ("store_and_fwd_flag", S),
                ("PULocationID", L), ("trip_distance", T.DoubleType()),
                ("fare_amount", T.DoubleType()))
