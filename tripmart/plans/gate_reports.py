"""Gate queries of the ad-hoc reports and load metrics, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.plans import reports, warehouse
from tripmart.plans.gate import gate, money_double
from tripmart.plans.oracle import TRIPS, ZONES
from tripmart.sources import adapter

# Parameters of the report gates (a day, a month and a zone of the test data).
REPORT_DAY = "1997-11-18"
MONTH_START, MONTH_END = "1997-11-01", "1997-12-01"
PICKUP_ZONE = "NATION_7"
RANGE_START, RANGE_END = "1998-03-01", "1998-03-15 23:59:59"

W = "with " + TRIPS


@gate("short_trips_count", W + "\nselect count(*) as short_trips from trips where trip_distance <= 1")
def short_trips_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.short_trips(adapter.trips(spark, sf_dir), 1)


@gate("longest_trip_day", W + """
select cast(pickup_datetime as date) as pickup_day, cast(max(trip_distance) as double) as max_distance
from trips where trip_distance < 100 group by 1 order by max_distance desc, pickup_day limit 1""")
def longest_trip_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reports.longest_trip_day(adapter.trips(spark, sf_dir), 100)
    return r.select("pickup_day", money_double("max_distance").alias("max_distance"))


@gate("top_zone_revenue_on_day", W + ",\n" + ZONES + f"""
select z.zone as pickup_zone, cast(sum(t.total_amount) as double) as total_revenue
from trips t join zones z on t.pickup_location_id = z.location_id
where cast(t.pickup_datetime as date) = date '{REPORT_DAY}'
group by z.zone order by total_revenue desc, pickup_zone limit 1""")
def top_zone_revenue_on_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reports.top_zone_on_day(adapter.trips(spark, sf_dir), warehouse.dim_zones(spark, sf_dir), REPORT_DAY)
    return r.select("pickup_zone", money_double("total_revenue").alias("total_revenue"))


@gate("top_tip_dropoff_zone", W + ",\n" + ZONES + f"""
select dz.zone as dropoff_zone, cast(t.tip_amount as double) as tip_amount
from trips t join zones pz on t.pickup_location_id = pz.location_id
join zones dz on t.dropoff_location_id = dz.location_id
where pz.zone = '{PICKUP_ZONE}' and t.pickup_datetime >= timestamp '{MONTH_START}'
  and t.pickup_datetime < timestamp '{MONTH_END}'
order by t.tip_amount desc nulls last, dropoff_zone limit 1""")
def top_tip_dropoff_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reports.top_tip_dropoff_zone(adapter.trips(spark, sf_dir), warehouse.dim_zones(spark, sf_dir),
                                     PICKUP_ZONE, MONTH_START, MONTH_END)
    return r.select("dropoff_zone", money_double("tip_amount").alias("tip_amount"))


@gate("zero_fare_count", W + """
select count(*) as total_trips, count(*) filter (where fare_amount = 0) as zero_fare_trips,
       count(*) filter (where tip_amount = 0) as zero_tip_trips from trips""")
def zero_fare_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = adapter.trips(spark, sf_dir)
    return t.agg(F.count(F.lit(1)).alias("total_trips"),
                 F.count(F.when(F.col("fare_amount") == 0, 1)).alias("zero_fare_trips"),
                 F.count(F.when(F.col("tip_amount") == 0, 1)).alias("zero_tip_trips"))


@gate("distinct_vendors_in_range", W + f"""
select distinct vendor_id from trips
where dropoff_datetime >= timestamp '{RANGE_START}' and dropoff_datetime <= timestamp '{RANGE_END}'""")
def distinct_vendors_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distinct_in_range(adapter.trips(spark, sf_dir), "vendor_id", "dropoff_datetime",
                                     RANGE_START, RANGE_END)


@gate("trips_by_month", W + """
select month, trips, cast(row_number() over (order by month) as int) as position from (
  select cast(date_trunc('month', pickup_datetime) as date) as month, count(*) as trips
  from trips where vendor_id is not null group by 1)""")
def trips_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips without a vendor have their pickup time removed: they must not be counted."""
    planted = F.when(F.col("vendor_id").isNotNull(), F.col("pickup_datetime"))
    return reports.trips_by_month(adapter.trips(spark, sf_dir).withColumn("pickup_datetime", planted))


@gate("payment_mix", W + """
select payment_type, trips, cast(row_number() over (order by trips desc, payment_type) as int) as position from (
  select coalesce(cast(payment_type as varchar), 'UNKNOWN') as payment_type, count(*) as trips
  from trips group by 1)""")
def payment_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.payment_mix(adapter.trips(spark, sf_dir))


@gate("distinct_payment_types", W + """
select payment_type, cast(row_number() over (order by payment_type nulls last) as int) as position from (
  select cast(payment_type as varchar) as payment_type from trips group by 1)""")
def distinct_payment_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distinct_payment_types(adapter.trips(spark, sf_dir))


@gate("pickup_range", W + """
select count(*) as total_trips, min(pickup_datetime) as first_pickup, max(pickup_datetime) as last_pickup,
       min(dropoff_datetime) as first_dropoff, max(dropoff_datetime) as last_dropoff from trips""")
def pickup_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.date_range(adapter.trips(spark, sf_dir))


_LATEST_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "pickup_datetime", "dropoff_datetime",
                "trip_distance", "fare_amount", "tip_amount", "total_amount"]


@gate("latest_trips", W + """
select l_orderkey, l_partkey, l_suppkey, pickup_datetime, dropoff_datetime,
       cast(trip_distance as double) as trip_distance, cast(fare_amount as double) as fare_amount,
       cast(tip_amount as double) as tip_amount, cast(total_amount as double) as total_amount
from trips order by pickup_datetime desc nulls last, dropoff_datetime desc nulls last,
  l_orderkey, l_partkey, l_suppkey, trip_distance, fare_amount limit 10""")
def latest_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = adapter.trips(spark, sf_dir).select(*_LATEST_COLS)
    # Of equal pickups the later dropoff comes first.
    longest = F.col("dropoff_datetime").desc_nulls_last()
    r = reports.latest(t, "pickup_datetime", 10, (longest, "l_orderkey", "l_partkey", "l_suppkey", "trip_distance", "fare_amount"))
    return r.select(*[money_double(c).alias(c) if c in ("trip_distance", "fare_amount", "tip_amount",
                                                        "total_amount") else F.col(c)
                      for c in _LATEST_COLS])


# --- API load metrics ------------------------------------------------------

API = TRIPS + """,
api as (select case when payment_type = 1 then 'Credit' else cast(payment_type as varchar) end as payment_type,
  pickup_datetime as trip_pickup_date_time, dropoff_datetime as trip_dropoff_date_time,
  trip_distance, fare_amount as fare_amt, tip_amount as tip_amt, total_amount as total_amt,
  'load_' || cast(year(pickup_datetime) as varchar) as _dlt_load_id from trips)"""


def _ledger_sql(all_pending: bool) -> str:
    status = "'0'" if all_pending else \
        "case when cast(substring(load_id, 6, 4) as int) % 2 = 0 then ' Loaded ' else '0' end"
    return f""",
ledger0 as (select _dlt_load_id as load_id, max(trip_dropoff_date_time) as inserted_at
            from api group by 1),
ledger as (select load_id, inserted_at, {status} as status from ledger0)"""


def _credit_sql(col: str) -> str:
    # ROUND(100 * AVG(CASE ... 1 ELSE 0), 2), computed exactly with integers
    # (round half away from zero of a non-negative value).
    hits = (f"sum(case when lower(trim(cast({col} as varchar))) like '%credit%' then 1 "
            f"when trim(cast({col} as varchar)) = '1' then 1 else 0 end)")
    return f"cast((2 * 10000 * {hits} + count(*)) // (2 * count(*)) as double) / 100"


@gate("credit_share", "with " + API + f"""
select min(cast(trip_pickup_date_time as date)) as start_date,
       max(cast(trip_pickup_date_time as date)) as end_date,
       {_credit_sql('payment_type')} as credit_card_pct,
       cast(round(sum(tip_amt), 2) as double) as total_tip_amt
from api""")
def credit_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reports.credit_share(adapter.api_trips(spark, sf_dir), "payment_type", "tip_amt",
                             "trip_pickup_date_time")
    return r.select("start_date", "end_date", "credit_card_pct",
                    money_double("total_tip_amt").alias("total_tip_amt"))


def _latest_metrics_sql(all_pending: bool) -> str:
    """One ranked ledger row, joined to the metrics of every load."""
    return "with " + API + _ledger_sql(all_pending) + f""",
ranked as (
  select load_id, trim(lower(status)) as state,
         row_number() over (order by trim(lower(status)) = 'loaded' desc, inserted_at desc, load_id desc) as place
  from ledger),
per_load as (
  select _dlt_load_id,
    min(trip_pickup_date_time)::date as p0, max(trip_pickup_date_time)::date as p1,
    min(trip_dropoff_date_time)::date as d0, max(trip_dropoff_date_time)::date as d1,
    {_credit_sql('payment_type')} as share, sum(tip_amt) as tips
  from api group by _dlt_load_id)
select load_id as latest_load_id, state as latest_status_normalized,
  p0 as pickup_start_date, p1 as pickup_end_date, d0 as dropoff_start_date, d1 as dropoff_end_date,
  if((p0, p1) = (d0, d1), 'MATCH', 'DIFFER') as date_span_check,
  share as credit_card_pct, round(coalesce(tips, 0), 2)::double as total_tip_amt
from ranked left join per_load on per_load._dlt_load_id = ranked.load_id where place = 1"""


def _latest_metrics(spark: SparkSession, sf_dir: str, all_pending: bool) -> DataFrame:
    api = adapter.api_trips(spark, sf_dir)
    ledger = adapter.load_ledger(api, all_pending)
    r = reports.latest_load_metrics(api, ledger, "_dlt_load_id", "payment_type", "tip_amt",
                                    "trip_pickup_date_time", "trip_dropoff_date_time")
    return r.withColumn("total_tip_amt", money_double("total_tip_amt"))


@gate("latest_load_metrics", _latest_metrics_sql(False))
def latest_load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest_metrics(spark, sf_dir, False)


@gate("latest_load_metrics_fallback", _latest_metrics_sql(True))
def latest_load_metrics_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest_metrics(spark, sf_dir, True)


@gate("cumulative_metrics", "with " + API + f"""
select {_credit_sql('payment_type')} as cumulative_credit_card_pct,
       cast(round(sum(coalesce(tip_amt, 0)), 2) as double) as cumulative_total_tip_amt from api""")
def cumulative_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reports.cumulative_metrics(adapter.api_trips(spark, sf_dir), "payment_type", "tip_amt")
    return r.withColumn("cumulative_total_tip_amt", money_double("cumulative_total_tip_amt"))


@gate("recent_loads", "with " + API + _ledger_sql(False) + """
select load_id, inserted_at, cast(status as varchar) as status_raw from ledger
order by inserted_at desc, load_id desc limit 10""")
def recent_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    api = adapter.api_trips(spark, sf_dir)
    return reports.recent_loads(adapter.load_ledger(api), 10)
