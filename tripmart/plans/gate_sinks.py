"""Gate queries of the materialisation strategies.

Each gate builds a fresh database in the shared work folder, runs the
strategy on batches derived from the driver tables and returns the final
table.  Batches are windows of order or event time, so together they cover
whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)

from tripmart.functions.columns import month_start, row_hash, ts_literal
from tripmart.plans import oracle, warehouse
from tripmart.plans.gate import gate, money_double
from tripmart.plans.gate_models import NUMERIC_COLS, ROW_HASH_COLS, ROW_HASH_SQL, replace_decimals_sql, doubles
from tripmart.session import scratch_database
from tripmart.sinks import tables
from tripmart.sources import adapter

# --- insert-only merge -------------------------------------------------------

LOADED_SCHEMA = StructType([
    StructField("unique_row_id", StringType()),
    StructField("filename", StringType()),
    StructField("o_orderkey", LongType()),
    StructField("o_custkey", LongType()),
    StructField("o_orderstatus", StringType()),
    StructField("o_totalprice", DecimalType(18, 2)),
    StructField("o_orderdate", TimestampNTZType()),
    StructField("o_orderpriority", StringType()),
])

SPLIT = "1999-01-01"          # batch 1: orders before; batch 2: from OVERLAP on
OVERLAP = "1998-01-01"
DUP_START, DUP_END = "1999-06-01", "1999-07-01"   # a month sent twice inside batch 2


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = adapter.table(spark, sf_dir, "orders")
    return o.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))


def _loaded(o: DataFrame, filename: str) -> DataFrame:
    return o.select(row_hash(o.schema, ROW_HASH_COLS).alias("unique_row_id"),
                    F.lit(filename).alias("filename"),
                    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                    "o_orderpriority")


def _between(c: str, start=None, end=None, like=TimestampNTZType()):
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(c) >= ts_literal(start, like))
    if end is not None:
        cond = cond & (F.col(c) < ts_literal(end, like))
    return cond


def _batches(spark: SparkSession, sf_dir: str):
    o = _orders(spark, sf_dir)
    b1 = _loaded(o.where(_between("o_orderdate", end=SPLIT)), "orders_batch_1")
    b2 = _loaded(o.where(_between("o_orderdate", start=OVERLAP)), "orders_batch_2")
    dup = _loaded(o.where(_between("o_orderdate", DUP_START, DUP_END)), "orders_batch_2")
    return b1, b2.unionByName(dup)


def _out_loaded(df: DataFrame) -> DataFrame:
    return df.withColumn("o_totalprice", money_double("o_totalprice"))


MERGE_SQL = f"""with o as (select {ROW_HASH_SQL} as unique_row_id, o_orderkey, o_custkey, o_orderstatus,
    cast(o_totalprice as decimal(18,2)) as o_totalprice, o_orderdate, o_orderpriority from orders),
b1 as (select *, 'orders_batch_1' as filename from o where o_orderdate < timestamp '{SPLIT}'),
b2 as (select *, 'orders_batch_2' as filename from o where o_orderdate >= timestamp '{OVERLAP}'
       union all
       select *, 'orders_batch_2' as filename from o
       where o_orderdate >= timestamp '{DUP_START}' and o_orderdate < timestamp '{DUP_END}'),
res as (select * from b1 union all
        select * from b2 where unique_row_id not in (select unique_row_id from b1))
select unique_row_id, filename, o_orderkey, o_custkey, o_orderstatus,
       cast(o_totalprice as double) as o_totalprice, o_orderdate, o_orderpriority from res"""


def _merge_insert(spark: SparkSession, sf_dir: str, reruns: int) -> DataFrame:
    db = scratch_database(spark, "merge")
    target = f"{db}.trips_loaded"
    tables.ensure_table(spark, target, LOADED_SCHEMA)
    b1, b2 = _batches(spark, sf_dir)
    tables.merge_insert_new(b1, target, ["unique_row_id"])
    for _ in range(1 + reruns):
        tables.merge_insert_new(b2, target, ["unique_row_id"])
    return _out_loaded(spark.table(target))


@gate("merge_insert_new", MERGE_SQL)
def merge_insert_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge_insert(spark, sf_dir, 0)


@gate("merge_insert_rerun", MERGE_SQL)
def merge_insert_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch merged twice: the re-run inserts nothing (INC-3)."""
    return _merge_insert(spark, sf_dir, 1)


# --- upsert, delete+insert ---------------------------------------------------

UPSERT_FROM = "1998-07-01"
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _monthly(o: DataFrame) -> DataFrame:
    return o.select(*ORDER_COLS, month_start("o_orderdate").alias("order_month"))


def _upsert_source(o: DataFrame) -> DataFrame:
    """Orders from UPSERT_FROM on, repriced; those already loaded move 40
    days later (some into another month partition)."""
    moved = F.when(F.col("o_orderdate") < ts_literal(SPLIT, TimestampNTZType()),
                   F.col("o_orderdate") + F.expr("INTERVAL 40 DAYS")).otherwise(F.col("o_orderdate"))
    s = o.where(_between("o_orderdate", start=UPSERT_FROM)).select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        (F.col("o_totalprice") + F.lit(1)).cast("decimal(18,2)").alias("o_totalprice"),
        moved.alias("o_orderdate"), "o_orderpriority")
    return _monthly(s)


def _out_orders(df: DataFrame) -> DataFrame:
    return df.select(*[money_double(c).alias(c) if c == "o_totalprice" else F.col(c)
                       for c in ORDER_COLS + ["order_month"]])


_O = ("with o as (select o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as decimal(18,2)) "
      "as o_totalprice, o_orderdate, o_orderpriority from orders),\n"
      f"t0 as (select * from o where o_orderdate < timestamp '{SPLIT}'),\n")
_OUT = ("select o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as double) as o_totalprice, "
        "o_orderdate, o_orderpriority, cast(date_trunc('month', o_orderdate) as date) as order_month from res")


@gate("merge_upsert", _O + f"""src as (select o_orderkey, o_custkey, o_orderstatus,
    cast(o_totalprice + 1 as decimal(18,2)) as o_totalprice,
    case when o_orderdate < timestamp '{SPLIT}' then o_orderdate + interval 40 day else o_orderdate end as o_orderdate,
    o_orderpriority from o where o_orderdate >= timestamp '{UPSERT_FROM}'),
res as (select * from t0 where o_orderkey not in (select o_orderkey from src) union all select * from src)
""" + _OUT)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = scratch_database(spark, "upsert")
    target = f"{db}.orders_fact"
    o = _orders(spark, sf_dir)
    tables.write_replace(_monthly(o.where(_between("o_orderdate", end=SPLIT))), target, ["order_month"])
    tables.merge_upsert(_upsert_source(o), target, ["o_orderkey"], "order_month")
    return _out_orders(spark.table(target))


@gate("delete_insert", _O + f"""src as (select * from o where o_orderdate >= timestamp '{SPLIT}'),
res as (select * from t0 where o_custkey not in (select o_custkey from src) union all select * from src)
""" + _OUT)
def delete_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New orders replace every loaded order of the same customers (SNK-10)."""
    db = scratch_database(spark, "delins")
    target = f"{db}.orders_fact"
    o = _orders(spark, sf_dir)
    tables.write_replace(_monthly(o.where(_between("o_orderdate", end=SPLIT))), target, ["order_month"])
    tables.write_delete_insert(_monthly(o.where(_between("o_orderdate", start=SPLIT))), target,
                               ["o_custkey"], "order_month")
    return _out_orders(spark.table(target))


# --- the partition of rows without a month ----------------------------------

NO_MONTH_TARGET, NO_MONTH_SOURCE = "2-HIGH", "1-URGENT"


def _undated(o: DataFrame, priority: str) -> DataFrame:
    """Orders of one priority lose their date, so they are in the partition without a month."""
    return _monthly(o.withColumn("o_orderdate", F.when(F.col("o_orderpriority") != priority, F.col("o_orderdate"))))


def _null_partition(spark: SparkSession, sf_dir: str, write) -> DataFrame:
    """Loaded orders include undated ones.  The source moves some of them into
    a month, others out of their month, adds new ones of both kinds, and
    leaves the rest where they are."""
    db = scratch_database(spark, "undated")
    target = f"{db}.orders_fact"
    o = _orders(spark, sf_dir)
    tables.write_replace(_undated(o.where(_between("o_orderdate", end=SPLIT)), NO_MONTH_TARGET), target, ["order_month"])
    write(_undated(o.where(_between("o_orderdate", start=UPSERT_FROM)), NO_MONTH_SOURCE), target)
    return _out_orders(spark.table(target))


_UNDATED = ("select o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
            "case when o_orderpriority <> '{p}' then o_orderdate end as o_orderdate, o_orderpriority from {t}")
_NULL_PART = _O + f"""old as ({_UNDATED.format(p=NO_MONTH_TARGET, t='t0')}),
src as ({_UNDATED.format(p=NO_MONTH_SOURCE, t='o')} where o.o_orderdate >= timestamp '{UPSERT_FROM}'),
res as (select * from old where {{key}} not in (select {{key}} from src) union all select * from src)
""" + _OUT


@gate("merge_upsert_null_partition", _NULL_PART.format(key="o_orderkey"))
def merge_upsert_null_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _null_partition(spark, sf_dir, lambda src, target: tables.merge_upsert(src, target, ["o_orderkey"], "order_month"))


@gate("delete_insert_null_partition", _NULL_PART.format(key="o_custkey"))
def delete_insert_null_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _null_partition(spark, sf_dir, lambda src, target: tables.write_delete_insert(src, target, ["o_custkey"], "order_month"))


# --- time-interval refresh ---------------------------------------------------

WIN_START, WIN_END = "2024-01-10 12:00:00", "2024-01-20 00:00:00"
EMPTY_START, EMPTY_END, EMPTY_DAY = "2024-01-10", "2024-01-13", "2024-01-11"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = adapter.table(spark, sf_dir, "events")
    return e.select("event_id", "ts", "user_id", "event_type", "value", F.to_date("ts").alias("event_date"))


def _interval(spark: SparkSession, sf_dir: str, start, end, new_version) -> DataFrame:
    db = scratch_database(spark, "interval")
    target = f"{db}.events_staged"
    tables.write_replace(_events(spark, sf_dir), target, ["event_date"])
    e = _events(spark, sf_dir)
    like = e.schema["ts"].dataType
    window = (F.col("ts") >= ts_literal(start, like)) & (F.col("ts") < ts_literal(end, like))
    tables.write_time_interval(new_version(e.where(window)), target, "ts", start, end, "event_date")
    return spark.table(target)


_EV = "select event_id, ts, user_id, event_type, {value} as value, cast(ts as date) as event_date from events"


@gate("time_interval_refresh", _EV.format(value="value")
      + f" where not (ts >= timestamp '{WIN_START}' and ts < timestamp '{WIN_END}')\nunion all\n"
      + _EV.format(value="value * 2")
      + f" where ts >= timestamp '{WIN_START}' and ts < timestamp '{WIN_END}'")
def time_interval_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _interval(spark, sf_dir, WIN_START, WIN_END,
                     lambda w: w.withColumn("value", F.col("value") * 2))


@gate("time_interval_emptied_day", _EV.format(value="value")
      + f" where not (ts >= timestamp '{EMPTY_START}' and ts < timestamp '{EMPTY_END}')\nunion all\n"
      + _EV.format(value="value")
      + f" where ts >= timestamp '{EMPTY_START}' and ts < timestamp '{EMPTY_END}'"
      + f" and cast(ts as date) <> date '{EMPTY_DAY}'")
def time_interval_emptied_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refreshed result has no row on one day of the window: that day's
    partition must end up empty, not keep its old rows."""
    return _interval(spark, sf_dir, EMPTY_START, EMPTY_END,
                     lambda w: w.where(F.col("event_date") != F.lit(EMPTY_DAY).cast("date")))


# --- replace / append / truncate / create-like / evolution -------------------

@gate("append_twice", "select * from nation union all select * from nation")
def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = scratch_database(spark, "append")
    n = adapter.table(spark, sf_dir, "nation")
    tables.write_append(n, f"{db}.nation")
    tables.write_append(n, f"{db}.nation")
    return spark.table(f"{db}.nation")


@gate("replace_table", "select * from nation")
def replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = scratch_database(spark, "replace")
    tables.write_replace(adapter.table(spark, sf_dir, "region"), f"{db}.dim")
    tables.write_replace(adapter.table(spark, sf_dir, "nation"), f"{db}.dim")
    return spark.table(f"{db}.dim")


@gate("truncate_insert", "select * from nation")
def truncate_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = scratch_database(spark, "truncate")
    n = adapter.table(spark, sf_dir, "nation")
    tables.write_replace(n.withColumn("n_name", F.lower("n_name")), f"{db}.nation")
    tables.write_truncate_insert(n, f"{db}.nation")
    return spark.table(f"{db}.nation")


@gate("create_like", "select * from nation where false")
def create_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = scratch_database(spark, "like")
    tables.create_like(adapter.table(spark, sf_dir, "nation"), f"{db}.nation_like")
    return spark.table(f"{db}.nation_like")


@gate("evolve_append", """
select n_nationkey, n_name, n_regionkey, cast(null as varchar) as r_name from nation
union all
select n.n_nationkey, n.n_name, n.n_regionkey, r.r_name
from nation n join region r on n.n_regionkey = r.r_regionkey""")
def evolve_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = scratch_database(spark, "evolve")
    n = adapter.table(spark, sf_dir, "nation")
    r = adapter.table(spark, sf_dir, "region")
    tables.evolve_append(n, f"{db}.nation")
    wide = n.join(r, n["n_regionkey"] == r["r_regionkey"], "inner").select(
        "n_nationkey", "n_name", "n_regionkey", "r_name")
    tables.evolve_append(wide, f"{db}.nation")
    return spark.table(f"{db}.nation")


def _f(name, t):
    return StructField(name, t, True)


_NUM = DecimalType(38, 9)
# The enforced contract of the fact table (names, order, types).  Timestamps
# are zone-less, as in the source files.
FCT_CONTRACT = StructType([
    _f("trip_id", StringType()), _f("vendor_id", IntegerType()), _f("service_type", StringType()),
    _f("rate_code_id", IntegerType()), _f("pickup_location_id", IntegerType()),
    _f("pickup_borough", StringType()), _f("pickup_zone", StringType()),
    _f("dropoff_location_id", IntegerType()), _f("dropoff_borough", StringType()),
    _f("dropoff_zone", StringType()), _f("pickup_datetime", TimestampNTZType()),
    _f("dropoff_datetime", TimestampNTZType()), _f("store_and_fwd_flag", StringType()),
    _f("passenger_count", IntegerType()), _f("trip_distance", _NUM), _f("trip_type", IntegerType()),
    _f("trip_duration_minutes", LongType()), _f("fare_amount", _NUM), _f("extra", _NUM),
    _f("mta_tax", _NUM), _f("tip_amount", _NUM), _f("tolls_amount", _NUM), _f("ehail_fee", _NUM),
    _f("improvement_surcharge", _NUM), _f("total_amount", _NUM), _f("payment_type", IntegerType()),
    _f("payment_type_description", StringType()),
])


@gate("conform_contract", "with " + oracle.FCT_TRIPS + "\n" + replace_decimals_sql("fct", NUMERIC_COLS))
def conform_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(tables.conform(warehouse.fct_trips(spark, sf_dir), FCT_CONTRACT, strict=True))

