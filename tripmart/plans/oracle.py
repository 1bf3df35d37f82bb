"""DuckDB oracle SQL for the gate queries.

The driver registers the test tables as views; every text here inlines the
derived sources it needs as CTEs.  Numbers follow the rules of the gate:
money summed as DECIMAL and turned into DOUBLE at the end, averages as
``CAST(SUM(x) AS DOUBLE) / COUNT(x)``, months and days as DATE.
"""

from __future__ import annotations

from tripmart.sources.seeds import PAYMENT_TYPES, PAYMENT_TYPES_WITH_FLEX, values_sql

JOINED = """j as (
  select l.*, o.o_custkey, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
         c.c_custkey, c.c_nationkey, s.s_nationkey
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey
  join customer c on o.o_custkey = c.c_custkey
  join supplier s on l.l_suppkey = s.s_suppkey)"""

TRIPS = JOINED + """,
trips as (select
  case when l_linenumber = 7 then null else l_linenumber % 5 end as vendor_id,
  case when l_linestatus = 'F' then 'Green' else 'Yellow' end as service_type,
  case when l_linenumber = 6 then 99 else c_nationkey end as pickup_location_id,
  s_nationkey as dropoff_location_id,
  o_orderdate as pickup_datetime, l_shipdate as dropoff_datetime,
  l_returnflag as store_and_fwd_flag,
  cast(l_quantity as int) as passenger_count,
  cast(l_quantity as decimal(18,2)) as trip_distance,
  cast(l_extendedprice as decimal(18,2)) as fare_amount,
  cast(l_tax as decimal(18,2)) as mta_tax,
  cast(l_discount as decimal(18,2)) as tip_amount,
  cast(o_totalprice as decimal(18,2)) as total_amount,
  nullif(cast(substring(o_orderpriority, 1, 1) as int), 5) as payment_type,
  l_orderkey, l_partkey, l_suppkey
  from j)"""


def raw_sql(taxi: str) -> str:
    p = "lpep" if taxi == "green" else "tpep"
    status = "F" if taxi == "green" else "O"
    green_only_fee = "cast(null as double) as ehail_fee," if taxi == "green" else ""
    green_only_type = ", cast(case when l_returnflag = 'A' then 2.0 else 1.0 end as double) as trip_type" if taxi == "green" else ""
    return f"""{taxi}_raw as (select
  case when l_linenumber = 7 then null else cast(l_linenumber % 5 as bigint) end as VendorID,
  o_orderdate as {p}_pickup_datetime, l_shipdate as {p}_dropoff_datetime,
  l_returnflag as store_and_fwd_flag, cast(l_linenumber as double) as RatecodeID,
  cast(case when l_linenumber = 6 then 99 else c_nationkey end as bigint) as PULocationID,
  cast(s_nationkey as bigint) as DOLocationID,
  l_quantity as passenger_count, l_quantity as trip_distance, l_extendedprice as fare_amount,
  cast(l_linenumber % 3 as double) * cast(0.5 as double) as extra, l_tax as mta_tax, l_discount as tip_amount,
  cast(case when c_nationkey = s_nationkey then 6.55 else 0.0 end as double) as tolls_amount,
  {green_only_fee}
  cast(0.3 as double) as improvement_surcharge, o_totalprice as total_amount,
  cast(nullif(cast(substring(o_orderpriority, 1, 1) as int), 5) as double) as payment_type
  {green_only_type}, cast(0.0 as double) as congestion_surcharge
  from j where l_linestatus = '{status}')"""


STAGED = JOINED + ",\n" + raw_sql("green") + ",\n" + raw_sql("yellow") + """,
stg_green as (select
  cast(VendorID as int) as vendor_id, cast(RatecodeID as int) as rate_code_id,
  cast(PULocationID as int) as pickup_location_id, cast(DOLocationID as int) as dropoff_location_id,
  lpep_pickup_datetime as pickup_datetime, lpep_dropoff_datetime as dropoff_datetime,
  store_and_fwd_flag, cast(passenger_count as int) as passenger_count,
  cast(trip_distance as decimal(38,9)) as trip_distance, cast(trip_type as int) as trip_type,
  cast(fare_amount as decimal(38,9)) as fare_amount, cast(extra as decimal(38,9)) as extra,
  cast(mta_tax as decimal(38,9)) as mta_tax, cast(tip_amount as decimal(38,9)) as tip_amount,
  cast(tolls_amount as decimal(38,9)) as tolls_amount, cast(ehail_fee as decimal(38,9)) as ehail_fee,
  cast(improvement_surcharge as decimal(38,9)) as improvement_surcharge,
  cast(total_amount as decimal(38,9)) as total_amount, cast(payment_type as int) as payment_type
  from green_raw where VendorID is not null),
stg_yellow as (select
  cast(VendorID as int) as vendor_id, cast(RatecodeID as int) as rate_code_id,
  cast(PULocationID as int) as pickup_location_id, cast(DOLocationID as int) as dropoff_location_id,
  tpep_pickup_datetime as pickup_datetime, tpep_dropoff_datetime as dropoff_datetime,
  store_and_fwd_flag, cast(passenger_count as int) as passenger_count,
  cast(trip_distance as decimal(38,9)) as trip_distance,
  cast(fare_amount as decimal(38,9)) as fare_amount, cast(extra as decimal(38,9)) as extra,
  cast(mta_tax as decimal(38,9)) as mta_tax, cast(tip_amount as decimal(38,9)) as tip_amount,
  cast(tolls_amount as decimal(38,9)) as tolls_amount,
  cast(improvement_surcharge as decimal(38,9)) as improvement_surcharge,
  cast(total_amount as decimal(38,9)) as total_amount, cast(payment_type as int) as payment_type
  from yellow_raw where VendorID is not null)"""

UNIONED = STAGED + """,
unioned as (
  select vendor_id, rate_code_id, pickup_location_id, dropoff_location_id, pickup_datetime,
         dropoff_datetime, store_and_fwd_flag, passenger_count, trip_distance, trip_type,
         fare_amount, extra, mta_tax, tip_amount, tolls_amount, ehail_fee,
         improvement_surcharge, total_amount, payment_type, 'Green' as service_type
  from stg_green
  union all
  select vendor_id, rate_code_id, pickup_location_id, dropoff_location_id, pickup_datetime,
         dropoff_datetime, store_and_fwd_flag, passenger_count, trip_distance, 1 as trip_type,
         fare_amount, extra, mta_tax, tip_amount, tolls_amount, cast(0 as decimal(38,9)) as ehail_fee,
         improvement_surcharge, total_amount, payment_type, 'Yellow' as service_type
  from stg_yellow)"""

# Tie-break order of the first-trip deduplication: dropoff, then the other
# columns in schema order, ascending with NULLs first.
_DEDUPE_ORDER = ", ".join(f"{c} nulls first" for c in [
    "dropoff_datetime", "rate_code_id", "dropoff_location_id", "store_and_fwd_flag",
    "passenger_count", "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax",
    "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount",
    "payment_type"])

PAYMENT_VALUES = values_sql(PAYMENT_TYPES, ["payment_type", "description"])
PAYMENT_FLEX_VALUES = values_sql(PAYMENT_TYPES_WITH_FLEX, ["payment_type_id", "payment_type_name"])

INT_TRIPS = UNIONED + f""",
deduped as (select * from (select *, row_number() over (
    partition by vendor_id, pickup_datetime, pickup_location_id, service_type
    order by {_DEDUPE_ORDER}) as rn from unioned) x where rn = 1),
int_trips as (select
  md5(concat_ws('-',
      coalesce(cast(vendor_id as varchar), '_dbt_utils_surrogate_key_null_'),
      coalesce(cast(pickup_datetime as varchar), '_dbt_utils_surrogate_key_null_'),
      coalesce(cast(pickup_location_id as varchar), '_dbt_utils_surrogate_key_null_'),
      coalesce(cast(service_type as varchar), '_dbt_utils_surrogate_key_null_'))) as trip_id,
  vendor_id, service_type, rate_code_id, pickup_location_id, dropoff_location_id,
  pickup_datetime, dropoff_datetime, store_and_fwd_flag, passenger_count, trip_distance,
  trip_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, ehail_fee,
  improvement_surcharge, total_amount,
  coalesce(d.payment_type, 0) as payment_type,
  coalesce(pt.description, 'Unknown') as payment_type_description
  from deduped d left join {PAYMENT_VALUES.replace(' as t(', ' as pt(')}
    on coalesce(d.payment_type, 0) = pt.payment_type)"""

ZONES = """zones as (select n.n_nationkey as location_id, r.r_name as borough, n.n_name as zone,
  'Boro Zone' as service_zone from nation n left join region r on n.n_regionkey = r.r_regionkey)"""

MINUTES = ("(cast(date_diff('day', cast(pickup_datetime as date), cast(dropoff_datetime as date)) as bigint) * 1440"
           " + (hour(dropoff_datetime) * 60 + minute(dropoff_datetime))"
           " - (hour(pickup_datetime) * 60 + minute(pickup_datetime)))")

FCT_TRIPS = INT_TRIPS + ",\n" + ZONES + f""",
fct as (select t.trip_id, t.vendor_id, t.service_type, t.rate_code_id, t.pickup_location_id,
  pz.borough as pickup_borough, pz.zone as pickup_zone, t.dropoff_location_id,
  dz.borough as dropoff_borough, dz.zone as dropoff_zone, t.pickup_datetime, t.dropoff_datetime,
  t.store_and_fwd_flag, t.passenger_count, t.trip_distance, t.trip_type,
  {MINUTES} as trip_duration_minutes,
  t.fare_amount, t.extra, t.mta_tax, t.tip_amount, t.tolls_amount, t.ehail_fee,
  t.improvement_surcharge, t.total_amount, t.payment_type, t.payment_type_description
  from int_trips t
  left join zones pz on t.pickup_location_id = pz.location_id
  left join zones dz on t.dropoff_location_id = dz.location_id)"""


def money_double(expr: str) -> str:
    return f"cast(cast({expr} as decimal(18,2)) as double)"


MONTHLY_ZONE_REVENUE = "with " + FCT_TRIPS + f"""
select coalesce(pickup_zone, 'Unknown Zone') as pickup_zone,
  cast(date_trunc('month', pickup_datetime) as date) as revenue_month, service_type,
  {money_double('sum(fare_amount)')} as revenue_monthly_fare,
  {money_double('sum(extra)')} as revenue_monthly_extra,
  {money_double('sum(mta_tax)')} as revenue_monthly_mta_tax,
  {money_double('sum(tip_amount)')} as revenue_monthly_tip_amount,
  {money_double('sum(tolls_amount)')} as revenue_monthly_tolls_amount,
  {money_double('sum(ehail_fee)')} as revenue_monthly_ehail_fee,
  {money_double('sum(improvement_surcharge)')} as revenue_monthly_improvement_surcharge,
  {money_double('sum(total_amount)')} as revenue_monthly_total_amount,
  count(trip_id) as total_monthly_trips,
  cast(sum(passenger_count) as double) / count(passenger_count) as avg_monthly_passenger_count,
  cast(sum(trip_distance) as double) / count(trip_distance) as avg_monthly_trip_distance
from fct
group by coalesce(pickup_zone, 'Unknown Zone'), cast(date_trunc('month', pickup_datetime) as date), service_type"""

