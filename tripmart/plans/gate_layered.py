"""Gate queries of the layered assets (ingestion -> staging -> report)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.columns import in_window, month_start
from tripmart.plans import layered, oracle
from tripmart.plans.gate import gate, money_double
from tripmart.session import scratch_database
from tripmart.sinks import tables

FULL_START, FULL_END = "1995-01-01", "2002-01-01"
WIN_START, WIN_END = "1998-03-01", "1998-09-01"
REPORT_END = "1998-09-01 12:00:00"      # a non-midnight end: its day is left out
RUN1, RUN2 = _dt.datetime(2024, 3, 1), _dt.datetime(2024, 3, 2)


def _loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Load 1: everything.  Load 2: the window re-ingested with corrected tips."""
    first = layered.ingest_trips(spark, sf_dir, "1", RUN1)
    pick = F.coalesce(F.col("tpep_pickup_datetime"), F.col("lpep_pickup_datetime"))
    again = layered.ingest_trips(spark, sf_dir, "2", RUN2, where=in_window(
        pick, WIN_START, WIN_END, first.schema["tpep_pickup_datetime"].dataType))
    return first, again.withColumn("tip_amount", F.col("tip_amount") + F.lit(1.0))


def ingestions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The ingestion table after load 1, and after load 2 was appended (the
    window's trips then exist twice), as lazy frames."""
    first, again = _loads(spark, sf_dir)
    return first, first.unionByName(again)


# --- oracle text -------------------------------------------------------------

INGEST_SQL = oracle.JOINED + ",\n" + oracle.raw_sql("yellow") + f""",
ing1 as (select *, '1' as _dlt_load_id from yellow_raw),
ing2 as (select * from ing1 union all
         select * replace (tip_amount + 1.0 as tip_amount), '2' as _dlt_load_id from yellow_raw
         where tpep_pickup_datetime >= timestamp '{WIN_START}' and tpep_pickup_datetime < timestamp '{WIN_END}')"""

_TIE = ", ".join(f"{c} desc nulls last" for c in [
    "_dlt_load_id", "passenger_count", "trip_distance", "RatecodeID", "store_and_fwd_flag",
    "pickup_location_id", "dropoff_location_id", "payment_type", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "total_amount"])


def staged_sql(name: str, ing: str, start: str, end: str) -> str:
    return f""",
{name}_src as (select tpep_pickup_datetime as pickup_datetime, tpep_dropoff_datetime as dropoff_datetime,
    passenger_count, trip_distance, RatecodeID, store_and_fwd_flag, PULocationID as pickup_location_id,
    DOLocationID as dropoff_location_id, payment_type, fare_amount, extra, mta_tax, tip_amount,
    tolls_amount, total_amount, _dlt_load_id from {ing}
  where tpep_pickup_datetime >= timestamp '{start}' and tpep_pickup_datetime < timestamp '{end}'
    and tpep_pickup_datetime is not null and tpep_dropoff_datetime is not null),
{name}_d as (select * from (select *, row_number() over (
    partition by pickup_datetime, dropoff_datetime, fare_amount order by {_TIE}) as rn
  from {name}_src) x where rn = 1),
{name} as (select pickup_datetime, dropoff_datetime, passenger_count, trip_distance, RatecodeID,
    store_and_fwd_flag, pickup_location_id, dropoff_location_id, d.payment_type, fare_amount, extra, mta_tax,
    tip_amount, tolls_amount, total_amount, coalesce(p.payment_type_name, 'Unknown') as payment_type_name
  from {name}_d d left join {oracle.PAYMENT_FLEX_VALUES.replace(' as t(', ' as p(')}
    on d.payment_type = p.payment_type_id)"""


_STAGED_FINAL = ("with " + INGEST_SQL + staged_sql("s_all", "ing1", FULL_START, FULL_END)
                 + staged_sql("s_win", "ing2", WIN_START, WIN_END) + f""",
final as (select * from s_all where not (pickup_datetime >= timestamp '{WIN_START}'
                                         and pickup_datetime < timestamp '{WIN_END}')
          union all select * from s_win)""")


@gate("dedupe_latest_load", "with " + INGEST_SQL + staged_sql("s_win", "ing2", WIN_START, WIN_END)
      + "\nselect * from s_win")
def dedupe_latest_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, both = ingestions(spark, sf_dir)
    return layered.stage_trips(both, layered.flex_lookup(spark), WIN_START, WIN_END)


def _materialised(spark: SparkSession, sf_dir: str) -> str:
    db = scratch_database(spark, "layered")
    target, ingestion = f"{db}.staged_trips", f"{db}.ingestion_trips"
    first, again = _loads(spark, sf_dir)
    lk = layered.flex_lookup(spark)
    # The ingestion asset is an append-only table; staging reads it.
    tables.write_append(first, ingestion)
    initial = layered.stage_trips(spark.table(ingestion), lk, FULL_START, FULL_END)
    tables.write_replace(initial.withColumn("pickup_month", month_start("pickup_datetime")), target,
                         ["pickup_month"])
    tables.write_append(again, ingestion)
    refresh = layered.stage_trips(spark.table(ingestion), lk, WIN_START, WIN_END)
    tables.write_time_interval(refresh.withColumn("pickup_month", month_start("pickup_datetime")), target,
                               "pickup_datetime", WIN_START, WIN_END, "pickup_month", month_start)
    return target


@gate("staged_trips_window", _STAGED_FINAL + "\nselect * from final")
def staged_trips_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging materialised with the time-interval strategy: a full build,
    then a refresh of the window after a re-ingestion."""
    return spark.table(_materialised(spark, sf_dir)).select(*layered.STAGED_COLUMNS)


@gate("daily_report", _STAGED_FINAL + f"""
select cast(pickup_datetime as date) as report_date, payment_type_name, count(*) as trip_count,
  cast(sum(cast(total_amount as decimal(18,2))) as double) as total_revenue,
  cast(sum(cast(fare_amount as decimal(38,6))) as double) / count(fare_amount) as avg_fare,
  cast(sum(cast(trip_distance as decimal(38,6))) as double) / count(trip_distance) as avg_trip_distance,
  cast(sum(cast(passenger_count as decimal(38,6))) as double) / count(passenger_count) as avg_passenger_count
from final
where cast(pickup_datetime as date) >= date '{WIN_START}' and cast(pickup_datetime as date) < cast(timestamp '{REPORT_END}' as date)
group by 1, 2""")
def daily_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = spark.table(_materialised(spark, sf_dir))
    r = layered.trips_report(staged, WIN_START, REPORT_END)
    return r.withColumn("total_revenue", money_double("total_revenue"))
