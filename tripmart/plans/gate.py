"""Gate queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each builds its result from the driver tables with the library's operators.
Money columns leave as DOUBLE through DECIMAL(18,2) so that results can be
compared with the oracle bit for bit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.aggregates import REVENUE_SUMS
from tripmart.plans import oracle, warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def gate(name: str, sql: str | None = None):
    """Register a gate query and, when given, its DuckDB oracle text."""
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def money_double(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("decimal(18,2)").cast("double")


@gate("monthly_zone_revenue", oracle.MONTHLY_ZONE_REVENUE)
def monthly_zone_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = warehouse.fct_monthly_zone_revenue(spark, sf_dir)
    return m.select("pickup_zone", "revenue_month", "service_type",
                    *[money_double(dst).alias(dst) for _, dst in REVENUE_SUMS],
                    "total_monthly_trips", "avg_monthly_passenger_count",
                    "avg_monthly_trip_distance")


@gate("warehouse_build", oracle.MONTHLY_ZONE_REVENUE)
def warehouse_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model DAG run twice (the second run finds nothing past the fact's
    high-water mark); the stored revenue mart equals the flagship result."""
    from tripmart.session import scratch_database
    db = scratch_database(spark, "models")
    warehouse.run_models(spark, sf_dir, db)
    built = warehouse.run_models(spark, sf_dir, db)
    m = spark.table(built["fct_monthly_zone_revenue"])
    return m.select("pickup_zone", "revenue_month", "service_type",
                    *[money_double(dst).alias(dst) for _, dst in REVENUE_SUMS],
                    "total_monthly_trips", "avg_monthly_passenger_count",
                    "avg_monthly_trip_distance")


@gate("warehouse_full_refresh", oracle.MONTHLY_ZONE_REVENUE)
def warehouse_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact table of an older layout (a column too many, one too few, stale
    rows) is rebuilt by a full refresh (INC-6)."""
    from tripmart.session import scratch_database
    from tripmart.sinks import tables
    db = scratch_database(spark, "refresh")
    old = warehouse.fct_trips(spark, sf_dir).drop("tip_amount").withColumn("old_column", F.lit(1))
    tables.write_replace(old.limit(100), f"{db}.fct_trips")
    built = warehouse.run_models(spark, sf_dir, db, full_refresh=True)
    m = spark.table(built["fct_monthly_zone_revenue"])
    return m.select("pickup_zone", "revenue_month", "service_type",
                    *[money_double(dst).alias(dst) for _, dst in REVENUE_SUMS],
                    "total_monthly_trips", "avg_monthly_passenger_count",
                    "avg_monthly_trip_distance")


#: Bounds of the increments, and the trips that the last one sends again with another month and fare.
INCREMENT_BOUNDS = ("1997-01-01", "2000-01-01")
_RESENT = "substr(trip_id, 1, 1) in ('0', '7') and pickup_datetime < timestamp '2000-01-01'"


@gate("mart_increments", oracle.MONTHLY_ZONE_REVENUE.replace("\nfrom fct\n", f"""
from (select * replace (case when {_RESENT} then pickup_datetime + interval 40 day else pickup_datetime end as pickup_datetime,
  case when {_RESENT} then fare_amount + 1 else fare_amount end as fare_amount) from fct) as final
"""))
def mart_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revenue mart kept by increments: early trips, later ones, then the
    latest with some of the earlier moved to another month, this one run twice.
    It equals the mart of all trips as they are in the end."""
    from tripmart.functions.columns import month_start
    from tripmart.operators import rollup
    from tripmart.session import scratch_database
    from tripmart.sinks.tables import materialize
    db = scratch_database(spark, "increments")
    fct = materialize(warehouse.fct_trips(spark, sf_dir), "trips")
    first, last = (F.lit(b).cast("timestamp_ntz") for b in INCREMENT_BOUNDS)
    moved = fct.where(_RESENT.replace("timestamp '", "timestamp_ntz '")).withColumn(
        "pickup_datetime", F.col("pickup_datetime") + F.expr("interval 40 days")).withColumn("fare_amount", (F.col("fare_amount") + 1).cast(fct.schema["fare_amount"].dataType))
    pickup = F.col("pickup_datetime")
    increments = [fct.where(pickup < first), fct.where((pickup >= first) & (pickup < last)),
                  fct.where(~(pickup < last) | pickup.isNull()).unionByName(moved)]
    for number, rows in [*enumerate(increments), (2, increments[2])]:
        rollup.add_increment(rows.withColumn("pickup_month", month_start("pickup_datetime")), f"{db}.fct_trips", f"{db}.zone_revenue",
                             rollup.zone_revenue(), "trip_id", "pickup_month", number)
    m = rollup.zone_revenue_report(spark.table(f"{db}.zone_revenue"))
    return m.select("pickup_zone", "revenue_month", "service_type",
                    *[money_double(dst).alias(dst) for _, dst in REVENUE_SUMS],
                    "total_monthly_trips", "avg_monthly_passenger_count",
                    "avg_monthly_trip_distance")
