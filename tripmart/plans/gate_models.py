"""Gate queries of the star-schema models and column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tripmart.functions.columns import minutes_between, row_hash, surrogate_key
from tripmart.operators import transforms
from tripmart.plans import oracle, warehouse
from tripmart.plans.gate import gate, money_double
from tripmart.sources import adapter, seeds

NUMERIC_COLS = ["trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                "ehail_fee", "improvement_surcharge", "total_amount"]


def doubles(df: DataFrame) -> DataFrame:
    """DECIMAL columns leave as DOUBLE (through DECIMAL(18,2))."""
    return df.select(*[money_double(f.name).alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def replace_decimals_sql(cte: str, present: list[str]) -> str:
    """``select * replace (...)`` turning the given DECIMAL columns into DOUBLE."""
    rep = ", ".join(f"cast(cast({c} as decimal(18,2)) as double) as {c}" for c in present)
    return f"select * replace ({rep}) from {cte}"


@gate("stg_green", "with " + oracle.STAGED + "\n" + replace_decimals_sql("stg_green", NUMERIC_COLS))
def stg_green(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(warehouse.stg_green(spark, sf_dir))


_YELLOW_NUM = [c for c in NUMERIC_COLS if c != "ehail_fee"]


@gate("stg_yellow", "with " + oracle.STAGED + "\n" + replace_decimals_sql("stg_yellow", _YELLOW_NUM))
def stg_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(warehouse.stg_yellow(spark, sf_dir))


# The sample window of the gate: one year of the test data.
SAMPLE = ("1996-01-01", "1997-01-01")


@gate("sample_window", "with " + oracle.STAGED + "\n" + replace_decimals_sql("stg_yellow", _YELLOW_NUM)
      + f" where pickup_datetime >= timestamp '{SAMPLE[0]}' and pickup_datetime < timestamp '{SAMPLE[1]}'")
def sample_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(warehouse.stg_yellow(spark, sf_dir, dev_window=SAMPLE))


@gate("stg_fhv", "with " + oracle.JOINED + """
select format('B{:05d}', l_suppkey) as dispatching_base_num,
       format('B{:05d}', c_custkey % 1000) as affiliated_base_number,
       o_orderdate as pickup_datetime, l_shipdate as dropoff_datetime,
       cast(case when l_linenumber = 6 then 99 else c_nationkey end as int) as pickup_location_id,
       cast(s_nationkey as int) as dropoff_location_id,
       case when l_returnflag = 'R' then 1 end as sr_flag
from j where l_linenumber <> 7""")
def stg_fhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.stg_fhv(spark, sf_dir)


@gate("union_services", "with " + oracle.UNIONED + "\n" + replace_decimals_sql("unioned", NUMERIC_COLS))
def union_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(warehouse.int_trips_unioned(spark, sf_dir))


@gate("dedupe_first_trip", "with " + oracle.INT_TRIPS + "\n" + replace_decimals_sql("int_trips", NUMERIC_COLS))
def dedupe_first_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(warehouse.int_trips(spark, sf_dir))


@gate("fct_trips", "with " + oracle.FCT_TRIPS + "\n" + replace_decimals_sql("fct", NUMERIC_COLS))
def fct_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(warehouse.fct_trips(spark, sf_dir))


@gate("dim_zones", "with " + oracle.ZONES + "\nselect * from zones")
def dim_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.dim_zones(spark, sf_dir)


@gate("dim_vendors", "with " + oracle.FCT_TRIPS + """
select distinct vendor_id, case vendor_id when 1 then 'Creative Mobile Technologies'
  when 2 then 'VeriFone Inc.' when 4 then 'Unknown/Other' end as vendor_name from fct""")
def dim_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.dim_vendors(spark, sf_dir)


_T = "with " + oracle.TRIPS + "\n"


@gate("enrich_payment", _T + f"""
select l_orderkey, l_partkey, l_suppkey, coalesce(t.payment_type, 0) as payment_type,
       coalesce(pt.description, 'Unknown') as payment_type_description
from trips t left join {oracle.PAYMENT_VALUES.replace(' as t(', ' as pt(')}
  on coalesce(t.payment_type, 0) = pt.payment_type""")
def enrich_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = adapter.trips(spark, sf_dir).select("l_orderkey", "l_partkey", "l_suppkey", "payment_type")
    return transforms.enrich_payment(t, seeds.payment_type_lookup(spark), null_code=0)


@gate("enrich_payment_raw_key", _T + f"""
select l_orderkey, l_partkey, l_suppkey, t.payment_type,
       coalesce(p.payment_type_name, 'Unknown') as payment_type_name
from trips t left join {oracle.PAYMENT_FLEX_VALUES.replace(' as t(', ' as p(')}
  on t.payment_type = p.payment_type_id""")
def enrich_payment_raw_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = adapter.trips(spark, sf_dir).select("l_orderkey", "l_partkey", "l_suppkey", "payment_type")
    return transforms.enrich_payment(t, seeds.payment_lookup_with_flex(spark), null_code=None,
                                     lookup_code="payment_type_id", lookup_name="payment_type_name",
                                     out_name="payment_type_name")


@gate("surrogate_key", """
select o_orderkey, md5(concat_ws('-',
  coalesce(cast(o_orderkey as varchar), '_dbt_utils_surrogate_key_null_'),
  coalesce(cast(o_custkey as varchar), '_dbt_utils_surrogate_key_null_'),
  coalesce(cast(o_orderdate as varchar), '_dbt_utils_surrogate_key_null_'),
  coalesce(cast(o_orderpriority as varchar), '_dbt_utils_surrogate_key_null_'))) as order_sk
from orders""")
def surrogate_key_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = adapter.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", surrogate_key("o_orderkey", "o_custkey", "o_orderdate",
                                                "o_orderpriority").alias("order_sk"))


ROW_HASH_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice", "o_orderpriority"]


def orders_for_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = adapter.table(spark, sf_dir, "orders")
    return o.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))


ROW_HASH_SQL = ("md5(coalesce(cast(o_orderkey as varchar), '') || coalesce(cast(o_custkey as varchar), '')"
                " || coalesce(o_orderstatus, '') || coalesce(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '')"
                " || coalesce(cast(cast(o_totalprice as decimal(18,2)) as varchar), '')"
                " || coalesce(o_orderpriority, ''))")


@gate("row_hash", f"select o_orderkey, {ROW_HASH_SQL} as unique_row_id from orders")
def row_hash_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = orders_for_hash(spark, sf_dir)
    return o.select("o_orderkey", row_hash(o.schema, ROW_HASH_COLS).alias("unique_row_id"))


@gate("trip_duration_minutes", """
select a.event_id, date_diff('minute', a.ts, b.ts) as minutes_to_next,
       date_diff('minute', b.ts, a.ts) as minutes_from_next
from events a join events b on b.event_id = a.event_id + 1""")
def trip_duration_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive events paired by id (an equi-join, no per-user window):
    minute boundaries crossed forward and backward."""
    e = adapter.table(spark, sf_dir, "events").select("event_id", "ts")
    nxt = e.select((F.col("event_id") - 1).alias("event_id"), F.col("ts").alias("ts_next"))
    j = e.join(nxt, "event_id", "inner")
    return j.select("event_id", minutes_between("ts", "ts_next").alias("minutes_to_next"),
                    minutes_between("ts_next", "ts").alias("minutes_from_next"))
