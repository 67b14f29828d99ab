"""The supply-chain demo rows (inline records to DataFrames with explicit schemas).

These are test inputs for the graph and retrieval jobs; the registered
queries run on the driver's tables instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakegraph import schemas

# The demo's four tables, as given.
SUPPLIERS = [
    ("S001", "ChemSynth GmbH", "Germany", "HIGH", 3),
    ("S002", "PharmaBase Italia", "Italy", "LOW", 7),
    ("S003", "Nordic API Solutions", "Sweden", "MEDIUM", 2),
    ("S004", "EastChem Ltd", "Poland", "HIGH", 5),
]
WAREHOUSES = [
    ("W001", "Berlin", "EU-West", 5000),
    ("W002", "Hamburg", "EU-North", 3000),
    ("W003", "Munich", "EU-South", 4000),
    ("W004", "Warsaw", "EU-East", 2500),
]
BATCHES = [
    ("B001", "Aspirin 500mg", "FAILED", "2024-01-10", "S001", "W002"),
    ("B002", "Ibuprofen 200mg", "PASSED", "2024-01-15", "S002", "W001"),
    ("B003", "Paracetamol 500mg", "PASSED", "2024-01-20", "S003", "W003"),
    ("B004", "Aspirin 500mg", "ON_HOLD", "2024-02-01", "S004", "W004"),
    ("B005", "Metformin 1000mg", "FAILED", "2024-02-05", "S001", "W002"),
    ("B006", "Lisinopril 10mg", "PASSED", "2024-02-08", "S002", "W001"),
]
ORDERS = [
    ("O001", "Charite Berlin", "B001", "DELAYED", "HIGH", "2024-02-10"),
    ("O002", "UKE Hamburg", "B001", "DELAYED", "HIGH", "2024-02-11"),
    ("O003", "Klinikum Muenchen", "B002", "SHIPPED", "MEDIUM", "2024-02-12"),
    ("O004", "Szpital Krakow", "B004", "PENDING", "HIGH", "2024-02-13"),
    ("O005", "Karolinska", "B005", "DELAYED", "HIGH", "2024-02-14"),
    ("O006", "Charite Berlin", "B003", "SHIPPED", "LOW", "2024-02-15"),
    ("O007", "AZ Sint-Jan", "B004", "PENDING", "MEDIUM", "2024-02-16"),
]


def supply_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "suppliers": spark.createDataFrame(SUPPLIERS, schemas.SUPPLIERS),
        "warehouses": spark.createDataFrame(WAREHOUSES, schemas.WAREHOUSES),
        "batches": spark.createDataFrame(BATCHES, schemas.BATCHES),
        "orders": spark.createDataFrame(ORDERS, schemas.ORDERS),
    }
