"""Schemas of the trip files.

Fixed values: the columns and types of the three kinds of trip files, and the
map from lower-cased column names to warehouse types.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType, TimestampNTZType

YELLOW = """VendorID string, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count int,
trip_distance double, RatecodeID string, store_and_fwd_flag string, PULocationID string, DOLocationID string, payment_type int,
fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double,
total_amount double, congestion_surcharge double"""

GREEN = """VendorID string, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, store_and_fwd_flag string,
RatecodeID string, PULocationID string, DOLocationID string, passenger_count int, trip_distance double, fare_amount double,
extra double, mta_tax double, tip_amount double, tolls_amount double, ehail_fee double, improvement_surcharge double,
total_amount double, payment_type int, trip_type int, congestion_surcharge double"""

FHV = """dispatching_base_num string, pickup_datetime timestamp_ntz, dropOff_datetime timestamp_ntz, PUlocationID int,
DOlocationID int, SR_Flag int, Affiliated_base_number string"""

TYPES = {"string": StringType(), "int": IntegerType(), "double": DoubleType(), "timestamp_ntz": TimestampNTZType()}
SCHEMAS = {"yellow": YELLOW, "green": GREEN, "fhv": FHV}

_INTEGERS = ["vendorid", "ratecodeid", "pulocationid", "dolocationid", "passenger_count", "trip_type", "payment_type", "sr_flag"]
_TIMES = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "lpep_pickup_datetime", "lpep_dropoff_datetime", "pickup_datetime",
          "dropoff_datetime"]
_TEXTS = ["store_and_fwd_flag", "dispatching_base_num", "affiliated_base_number"]
_AMOUNTS = ["trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge",
            "total_amount", "congestion_surcharge", "airport_fee"]
#: For readers that type a file from its header.
TYPE_MAP = {**dict.fromkeys(_INTEGERS, "int"), **dict.fromkeys(_TIMES, "timestamp_ntz"), **dict.fromkeys(_TEXTS, "string"),
            **dict.fromkeys(_AMOUNTS, "decimal(38,9)")}


def trip_schema(taxi: str) -> StructType:
    """Schema of a kind's monthly files."""
    if taxi not in SCHEMAS:
        raise ValueError(f"unknown taxi type {taxi!r}")
    pairs = [column.split() for column in SCHEMAS[taxi].split(",")]
    return StructType([StructField(name, TYPES[kind]) for name, kind in pairs])
