"""Seeds: small lookup tables shipped with the project, and seed-file readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# Fixed values that must equal the reference's for equal results.
# Payment type lookup of the warehouse models (codes 1-6; no code 0).
PAYMENT_TYPES = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided"),
]
# Payment type lookup of the layered assets (codes 0-6).
PAYMENT_TYPES_WITH_FLEX = [
    (0, "flex_fare"),
    (1, "credit_card"),
    (2, "cash"),
    (3, "no_charge"),
    (4, "dispute"),
    (5, "unknown"),
    (6, "voided_trip"),
]

PAYMENT_SCHEMA = StructType([
    StructField("payment_type", IntegerType(), True),
    StructField("description", StringType(), True),
])
PAYMENT_FLEX_SCHEMA = StructType([
    StructField("payment_type_id", IntegerType(), True),
    StructField("payment_type_name", StringType(), True),
])


def _local(spark: SparkSession, rows, schema: StructType) -> DataFrame:
    """A seed as a local relation (SQL VALUES): its size is known to the
    optimizer, so joins broadcast it.  (A frame created from a Python list is
    planned as an RDD of unknown size.)"""
    names = [f.name for f in schema.fields]
    casts = ", ".join(f"cast({n} as {f.dataType.simpleString()}) as {n}" for n, f in zip(names, schema.fields))
    return spark.sql(f"select {casts} from {values_sql(rows, names)}")


def payment_type_lookup(spark: SparkSession) -> DataFrame:
    return _local(spark, PAYMENT_TYPES, PAYMENT_SCHEMA)


def payment_lookup_with_flex(spark: SparkSession) -> DataFrame:
    return _local(spark, PAYMENT_TYPES_WITH_FLEX, PAYMENT_FLEX_SCHEMA)


def values_sql(rows, names) -> str:
    """The same lookup as a SQL VALUES list (for SQL text and oracles)."""
    body = ", ".join(
        "(" + ", ".join(repr(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"(values {body}) as t({', '.join(names)})"
