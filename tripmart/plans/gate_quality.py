"""Gate queries of the quality suite and of the incremental fact build."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.columns import month_start
from tripmart.operators import quality as Q
from tripmart.operators.aggregates import monthly_zone_revenue
from tripmart.operators.incremental import build_incremental
from tripmart.operators.transforms import FCT_COLUMNS, dim_vendors
from tripmart.plans import layered, oracle, warehouse
from tripmart.plans.gate import gate
from tripmart.plans.gate_layered import INGEST_SQL, REPORT_END, WIN_END, WIN_START, ingestions, staged_sql
from tripmart.plans.gate_models import NUMERIC_COLS, replace_decimals_sql, doubles
from tripmart.plans.gate_sinks import FCT_CONTRACT
from tripmart.session import scratch_database
from tripmart.sinks import tables
from tripmart.sources import adapter, seeds

# Check specs: (kind, column, accepted values).  The same spec drives the
# Spark suite and the oracle text.
FCT_CHECKS = [("unique", "trip_id", ()), ("not_null", "trip_id", ()), ("not_null", "vendor_id", ()),
              ("not_null", "service_type", ()), ("accepted_values", "service_type", ("Green", "Yellow")),
              ("not_null", "pickup_datetime", ()), ("not_null", "total_amount", ()),
              # planted violation: code 0 (unknown payment) is not in the list
              ("accepted_values", "payment_type", (1, 2, 3, 4, 5, 6)),
              # planted as well: code 0 is not positive
              ("positive", "payment_type", ()), ("positive", "total_amount", ())]
ZONE_CHECKS = [("unique", "location_id", ()), ("not_null", "location_id", ())]
VENDOR_CHECKS = [("unique", "vendor_id", ()), ("not_null", "vendor_id", ())]
REVENUE_CHECKS = [("not_null", "pickup_zone", ()), ("not_null", "revenue_month", ()),
                  ("not_null", "service_type", ()), ("accepted_values", "service_type", ("Green", "Yellow")),
                  ("not_null", "revenue_monthly_total_amount", ())]
STAGED_CHECKS = [("not_null", "pickup_datetime", ()), ("not_null", "dropoff_datetime", ()),
                 ("non_negative", "trip_distance", ()), ("non_negative", "fare_amount", ()),
                 ("non_negative", "total_amount", ()), ("not_null", "payment_type_name", ()),
                 ("not_null", "pickup_location_id", ()), ("not_null", "dropoff_location_id", ())]
REPORT_CHECKS = [("not_null", "report_date", ()), ("not_null", "payment_type_name", ()),
                 ("non_negative", "trip_count", ()), ("non_negative", "total_revenue", ()),
                 ("non_negative", "avg_fare", ()), ("non_negative", "avg_trip_distance", ()),
                 ("non_negative", "avg_passenger_count", ())]
LOOKUP_CHECKS = [("not_null", "payment_type_id", ()), ("unique", "payment_type_id", ()),
                 ("not_null", "payment_type_name", ())]


def _spark_checks(spec) -> list[Q.Check]:
    out = []
    for kind, col, values in spec:
        out.append({"unique": lambda: Q.unique(col), "not_null": lambda: Q.not_null(col),
                    "non_negative": lambda: Q.non_negative(col), "positive": lambda: Q.positive(col),
                    "accepted_values": lambda: Q.accepted_values(col, values)}[kind]())
    return out


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def _check_sql(cte: str, table: str, spec) -> list[str]:
    rows = []
    for kind, col, values in spec:
        if kind == "unique":
            n = (f"(select count(*) from (select {col} from {cte} where {col} is not null "
                 f"group by {col} having count(*) > 1))")
        else:
            cond = {"not_null": f"{col} is null", "non_negative": f"{col} < 0", "positive": f"{col} <= 0",
                    "accepted_values": f"{col} is not null and {col} not in ({', '.join(map(_lit, values))})"}[kind]
            n = f"(select count(*) from {cte} where {cond})"
        rows.append(f"select '{table}' as table_name, '{kind}' as check_name, '{col}' as column_name, "
                    f"cast({n} as bigint) as violations, {n} = 0 as passed")
    return rows


_MONTHLY = """monthly as (select coalesce(pickup_zone, 'Unknown Zone') as pickup_zone,
  cast(date_trunc('month', pickup_datetime) as date) as revenue_month, service_type,
  sum(total_amount) as revenue_monthly_total_amount from fct group by 1, 2, 3)"""
_VENDORS = "vendors as (select distinct vendor_id from fct)"


@gate("dq_suite", "with " + oracle.FCT_TRIPS + ",\n" + _MONTHLY + ",\n" + _VENDORS + "\n" + "\nunion all\n".join(
    _check_sql("fct", "fct_trips", FCT_CHECKS) + _check_sql("zones", "dim_zones", ZONE_CHECKS)
    + _check_sql("vendors", "dim_vendors", VENDOR_CHECKS)
    + _check_sql("monthly", "fct_monthly_zone_revenue", REVENUE_CHECKS)))
def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The models' declared tests plus one planted violation.  The fact is
    materialised once (as the model table would be) and every table's checks
    read it."""
    fct = tables.materialize(warehouse.fct_trips(spark, sf_dir), "fct")
    parts = [Q.run_checks(fct, _spark_checks(FCT_CHECKS), "fct_trips"),
             Q.run_checks(warehouse.dim_zones(spark, sf_dir), _spark_checks(ZONE_CHECKS), "dim_zones"),
             Q.run_checks(dim_vendors(fct), _spark_checks(VENDOR_CHECKS), "dim_vendors"),
             Q.run_checks(monthly_zone_revenue(fct), _spark_checks(REVENUE_CHECKS), "fct_monthly_zone_revenue")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@gate("dq_unique_combination", "with " + oracle.FCT_TRIPS + ",\n" + _MONTHLY + """
select 'fct_monthly_zone_revenue' as table_name, 'unique_combination_of_columns' as check_name,
  'pickup_zone,revenue_month,service_type' as column_name, count(*) as violations, count(*) = 0 as passed
from (select 1 from monthly group by pickup_zone, revenue_month, service_type having count(*) > 1)
union all
select 'trips' as table_name, 'unique_combination_of_columns' as check_name,
  'vendor_id,pickup_datetime,pickup_location_id,service_type' as column_name, count(*) as violations,
  count(*) = 0 as passed
from (select 1 from unioned where vendor_id is not null and pickup_datetime is not null
        and pickup_location_id is not null
      group by vendor_id, pickup_datetime, pickup_location_id, service_type having count(*) > 1)""")
def dq_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart's grain holds; the union before deduplication violates the
    deduplication key (planted)."""
    m = warehouse.fct_monthly_zone_revenue(spark, sf_dir)
    a = Q.run_checks(m, [Q.unique_combination("pickup_zone", "revenue_month", "service_type")],
                     "fct_monthly_zone_revenue")
    u = warehouse.int_trips_unioned(spark, sf_dir)
    b = Q.run_checks(u, [Q.unique_combination("vendor_id", "pickup_datetime", "pickup_location_id",
                                              "service_type")], "trips")
    return a.unionByName(b)


@gate("dq_relationships", "with " + oracle.FCT_TRIPS + """
select 'fct_trips' as table_name, 'relationships' as check_name, 'pickup_location_id' as column_name,
  count(*) as violations, count(*) = 0 as passed
from fct where pickup_location_id is not null
  and pickup_location_id not in (select location_id from zones where location_id is not null)
union all
select 'fct_trips', 'relationships', 'dropoff_location_id', count(*), count(*) = 0
from fct where dropoff_location_id is not null
  and dropoff_location_id not in (select location_id from zones where location_id is not null)""")
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    fct = warehouse.fct_trips(spark, sf_dir)
    z = warehouse.dim_zones(spark, sf_dir)
    return Q.run_checks(fct, [Q.relationships("pickup_location_id", z, "location_id"),
                              Q.relationships("dropoff_location_id", z, "location_id")], "fct_trips")


_REPORT_SQL = """report as (select cast(pickup_datetime as date) as report_date, payment_type_name,
  count(*) as trip_count, sum(cast(total_amount as decimal(18,2))) as total_revenue,
  cast(sum(cast(fare_amount as decimal(38,6))) as double) / count(fare_amount) as avg_fare,
  cast(sum(cast(trip_distance as decimal(38,6))) as double) / count(trip_distance) as avg_trip_distance,
  cast(sum(cast(passenger_count as decimal(38,6))) as double) / count(passenger_count) as avg_passenger_count
  from s_win where cast(pickup_datetime as date) >= date '{start}'
    and cast(pickup_datetime as date) < cast(timestamp '{end}' as date) group by 1, 2)"""


@gate("dq_asset_checks", "with " + INGEST_SQL + staged_sql("s_win", "ing2", WIN_START, WIN_END) + ",\n"
      + _REPORT_SQL.format(start=WIN_START, end=REPORT_END) + ",\n"
      + f"lookup as (select * from {oracle.PAYMENT_FLEX_VALUES})\n" + "\nunion all\n".join(
          _check_sql("lookup", "payment_lookup", LOOKUP_CHECKS) + _check_sql("s_win", "staged_trips", STAGED_CHECKS)
          + _check_sql("report", "trips_report", REPORT_CHECKS)))
def dq_asset_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layered assets' column checks: lookup, staged trips, report."""
    _, both = ingestions(spark, sf_dir)
    lk = seeds.payment_lookup_with_flex(spark)
    staged = layered.stage_trips(both, lk, WIN_START, WIN_END)
    report = layered.trips_report(staged, WIN_START, REPORT_END)
    return (Q.run_checks(lk, _spark_checks(LOOKUP_CHECKS), "payment_lookup")
            .unionByName(Q.run_checks(staged, _spark_checks(STAGED_CHECKS), "staged_trips"))
            .unionByName(Q.run_checks(report, _spark_checks(REPORT_CHECKS), "trips_report")))


@gate("dq_custom_dropoff_after_pickup", "with " + oracle.TRIPS + """
select 'trips' as table_name, 'dropoff_after_pickup' as check_name, cast(null as varchar) as column_name,
  count(*) as violations, count(*) = 0 as passed from trips where dropoff_datetime <= pickup_datetime""")
def dq_custom_dropoff_after_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Custom SQL check with an expected value of 0 (fails on this data)."""
    view = f"trips_{abs(hash(sf_dir)) % 10**8}"
    adapter.trips(spark, sf_dir).createOrReplaceTempView(view)
    return Q.custom_value(spark, "dropoff_after_pickup",
                          f"SELECT COUNT(*) AS invalid_rows FROM {view} WHERE dropoff_datetime <= pickup_datetime",
                          0, "trips")


FRESH_NOW = "2001-08-02 06:00:00"


@gate("dq_freshness", "with " + oracle.JOINED + ",\n" + oracle.raw_sql("green") + ",\n" + oracle.raw_sql("yellow") + f"""
select *, case when age_hours is null or age_hours > 48 then 'error' when age_hours > 24 then 'warn' else 'pass' end as status
from (
  select 'green_tripdata' as table_name, max(lpep_pickup_datetime) as max_loaded_at,
    (epoch(timestamp '{FRESH_NOW}') - epoch(max(lpep_pickup_datetime))) / 3600.0 as age_hours from green_raw
  union all
  select 'yellow_tripdata', max(tpep_pickup_datetime),
    (epoch(timestamp '{FRESH_NOW}') - epoch(max(tpep_pickup_datetime))) / 3600.0 from yellow_raw
  union all
  select 'yellow_an_hour_later', max(tpep_pickup_datetime), 1.0 from yellow_raw
  union all
  select 'yellow_30_hours_later', max(tpep_pickup_datetime), 30.0 from yellow_raw
  union all
  select 'no_rows', null, null)""")
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age and status of the newest pickup of each raw source at a fixed run
    time, at run times within each limit, and of an empty source."""
    g = Q.freshness(adapter.raw_tripdata(spark, sf_dir, "green"), "lpep_pickup_datetime", FRESH_NOW,
                    table="green_tripdata")
    y = Q.freshness(adapter.raw_tripdata(spark, sf_dir, "yellow"), "tpep_pickup_datetime", FRESH_NOW,
                    table="yellow_tripdata")
    yellow = adapter.raw_tripdata(spark, sf_dir, "yellow").select("tpep_pickup_datetime")
    newest = yellow.agg(F.max("tpep_pickup_datetime").cast("string")).first()[0]
    for name, hours in (("yellow_an_hour_later", 1), ("yellow_30_hours_later", 30)):
        now = _dt.datetime.fromisoformat(newest) + _dt.timedelta(hours=hours)
        y = y.unionByName(Q.freshness(yellow, "tpep_pickup_datetime", now, table=name))
    none = Q.freshness(yellow.where(F.lit(False)), "tpep_pickup_datetime", FRESH_NOW, table="no_rows")
    return g.unionByName(y).unionByName(none)


# --- incremental fact ---------------------------------------------------------

FIRST_RUN_END = "1998-01-01"


def _fct_with_month(fct: DataFrame) -> DataFrame:
    return fct.withColumn("pickup_month", month_start("pickup_datetime"))


@gate("fct_trips_increment", "with " + oracle.FCT_TRIPS + f""",
t0 as (select * from fct where pickup_datetime < timestamp '{FIRST_RUN_END}' and service_type = 'Green'),
res as (select * from t0 union all
        select * from fct where pickup_datetime > (select max(pickup_datetime) from t0))
""" + replace_decimals_sql("res", NUMERIC_COLS))
def fct_trips_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First run sees only green trips before 1998; the second run sees all
    trips and takes those past the high-water mark: the late yellow trips
    before it are dropped, as in the reference (INC-1)."""
    db = scratch_database(spark, "incr")
    target = f"{db}.fct_trips"
    fct = _fct_with_month(warehouse.fct_trips(spark, sf_dir))
    first = fct.where((F.col("pickup_datetime") < F.lit(FIRST_RUN_END).cast("timestamp_ntz"))
                      & (F.col("service_type") == "Green"))
    build_incremental(first, target, "trip_id", "pickup_datetime", "pickup_month")
    build_incremental(fct, target, "trip_id", "pickup_datetime", "pickup_month")
    return doubles(spark.table(target).select(*FCT_COLUMNS))


@gate("fct_trips_increment_empty", "with " + oracle.FCT_TRIPS + "\n" + replace_decimals_sql("fct", NUMERIC_COLS)
      + " where false")
def fct_trips_increment_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An existing but empty target: max() is NULL and nothing passes."""
    db = scratch_database(spark, "incr0")
    target = f"{db}.fct_trips"
    schema = FCT_CONTRACT.add("pickup_month", "date")
    tables.ensure_table(spark, target, schema, ["pickup_month"])
    build_incremental(_fct_with_month(warehouse.fct_trips(spark, sf_dir)), target, "trip_id",
                      "pickup_datetime", "pickup_month")
    return doubles(spark.table(target).select(*FCT_COLUMNS))
