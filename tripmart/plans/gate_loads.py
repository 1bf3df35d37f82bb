"""Gate queries of the monthly file loads and file-name filters."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.columns import safe_cast
from tripmart.plans import loads, oracle
from tripmart.plans.gate import gate
from tripmart.plans.gate_sources import named_files
from tripmart.session import scratch_database, scratch_dir
from tripmart.sinks import tables
from tripmart.sources import adapter, files
from tripmart.sources.trips import trip_schema


def _row_id_sql(taxi: str, variant: str = "rowstore") -> str:
    parts = [f"coalesce(strftime({c}, '%Y-%m-%d %H:%M:%S'), '')" if c.endswith("datetime") else f"coalesce(cast({c} as varchar), '')"
             for c in loads.row_id_fields(taxi, variant)]
    return f"md5({' || '.join(parts)})"


def _load_sql(taxi: str) -> str:
    p = loads.PREFIX[taxi]
    return f"""select {_row_id_sql(taxi)} as unique_row_id, '{taxi}_tripdata_' || strftime({p}_pickup_datetime, '%Y-%m') || '.csv' as filename,
  VendorID, {p}_pickup_datetime as pickup_datetime, {p}_dropoff_datetime as dropoff_datetime, PULocationID, DOLocationID, fare_amount, trip_distance
from {taxi}_raw"""


@gate("flow_month_load", "with " + oracle.JOINED + ",\n" + oracle.raw_sql("green") + ",\n" + oracle.raw_sql("yellow") + "\n"
      + _load_sql("green") + "\nunion all\n" + _load_sql("yellow"))
def flow_month_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file of both kinds staged with row id and file name, merged into
    the kind's main table twice: the second run inserts nothing."""
    db = scratch_database(spark, "flow")
    out = None
    with tables.staged(adapter.trip_rows(spark, sf_dir), "trip-rows") as (joined, _):
        for taxi, p in loads.PREFIX.items():
            raw = adapter.raw_tripdata(spark, sf_dir, taxi, joined)
            fname = F.concat(F.lit(f"{taxi}_tripdata_"), F.date_format(f"{p}_pickup_datetime", "yyyy-MM"), F.lit(".csv"))
            staged = loads.stage_for_load(raw, taxi, fname, "rowstore")
            target = f"{db}.{taxi}_tripdata"
            tables.ensure_table(spark, target, staged.schema)
            for _ in range(2):
                tables.merge_insert_new(staged, target, ["unique_row_id"])
            rows = spark.table(target).select(
                "unique_row_id", "filename", "VendorID", F.col(f"{p}_pickup_datetime").alias("pickup_datetime"),
                F.col(f"{p}_dropoff_datetime").alias("dropoff_datetime"), "PULocationID", "DOLocationID", "fare_amount", "trip_distance")
            out = rows if out is None else out.unionByName(rows)
    return out


@gate("rows_for_file_pattern", "with " + oracle.TRIPS + """,
f as (select lower(service_type) || '_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.csv' as filename
      from trips)
select count(*) filter (where filename like '%1998%') as rows_1998,
       count(*) filter (where filename like 'yellow%') as rows_yellow,
       count(*) filter (where filename = 'green_tripdata_1998-03.csv') as rows_one_file
from f""")
def rows_for_file_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts by file-name pattern and by one exact file (FLT-7)."""
    path = scratch_dir(spark, "pattern")
    t = adapter.trips(spark, sf_dir)
    name = F.concat(F.lower("service_type"), F.lit("_tripdata_"), F.date_format("pickup_datetime", "yyyy-MM"), F.lit(".csv"))
    named_files(t.select("l_orderkey", name.alias("source")), F.col("source"), path)
    back = files.with_source_file(spark.read.option("header", True).schema("l_orderkey bigint").csv(path))
    fn = F.col("filename")
    return back.agg(F.count(F.when(fn.like("%1998%"), 1)).alias("rows_1998"),
                    F.count(F.when(fn.like("yellow%"), 1)).alias("rows_yellow"),
                    F.count(F.when(fn == "green_tripdata_1998-03.csv", 1)).alias("rows_one_file"))


def _months_around(raw: DataFrame, pickup: str) -> tuple[_dt.date, _dt.date]:
    """From the month before the first trip to the one after the last: there is no file for these two."""
    first, last = raw.agg(F.add_months(F.trunc(F.min(pickup), "month"), -1), F.add_months(F.trunc(F.max(pickup), "month"), 1)).first()
    return first, last


_TYPED = {"string": "varchar", "int": "int", "double": "double", "timestamp_ntz": "timestamp"}


def _backfill_sql(taxi: str, variant: str) -> str:
    """The backfilled rows of a kind: all raw trips in the file schema's types, with row id and file name."""
    p = loads.PREFIX[taxi]
    typed = ", ".join(f"cast({f.name} as {_TYPED[f.dataType.simpleString()]}) as {f.name}" for f in trip_schema(taxi).fields)
    return f"""select {_row_id_sql(taxi, variant)} as unique_row_id,
  '{taxi}_tripdata_' || strftime({p}_pickup_datetime, '%Y-%m') || '.csv' as filename, '{taxi}' as taxi, VendorID, PULocationID,
  {p}_pickup_datetime as pickup_datetime, fare_amount, payment_type from (select {typed} from {taxi}_raw)"""


@gate("flow_backfill", "with " + oracle.JOINED + ",\n" + oracle.raw_sql("green") + ",\n" + oracle.raw_sql("yellow") + "\n"
      + _backfill_sql("green", "rowstore") + "\nunion all\n" + _backfill_sql("yellow", "warehouse"))
def flow_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All month files of both kinds, each kind with its own row id, loaded twice, with
    a month without a file at each end: the second run inserts nothing (INC-2)."""
    db, root = scratch_database(spark, "backfill"), scratch_dir(spark, "backfill-files")
    out = None
    for taxi, variant in (("green", "rowstore"), ("yellow", "warehouse")):
        p = loads.PREFIX[taxi]
        with tables.staged(adapter.raw_tripdata(spark, sf_dir, taxi), "raw-trips") as (raw, _):
            typed = raw.select(*[F.col(f.name).cast(f.dataType) for f in trip_schema(taxi).fields])
            month = F.date_format(f"{p}_pickup_datetime", "yyyy-MM")
            named_files(typed, F.concat(F.lit(f"{taxi}_tripdata_"), month, F.lit(".csv")), f"{root}/{taxi}")
            months = _months_around(raw, f"{p}_pickup_datetime")
        for _ in range(2):
            loads.backfill(spark, f"{root}/{taxi}", [taxi], *months, db, variant)
        rows = spark.table(f"{db}.{taxi}_tripdata").select(
            "unique_row_id", "filename", F.lit(taxi).alias("taxi"), "VendorID", "PULocationID",
            F.col(f"{p}_pickup_datetime").alias("pickup_datetime"), "fare_amount", "payment_type")
        out = rows if out is None else out.unionByName(rows)
    return out


@gate("flow_month_replace", "with " + oracle.JOINED + ",\n" + oracle.raw_sql("yellow") + "\nselect filename, count(*) as rows from (\n"
      + _backfill_sql("yellow", "warehouse") + "\n) where filename = (select 'yellow_tripdata_' || strftime(max(tpep_pickup_datetime), '%Y-%m') || '.csv' from yellow_raw) group by 1")
def flow_month_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse flow's mode: a table is rebuilt from each month's file, so the last month stays."""
    db, root = scratch_database(spark, "replace"), scratch_dir(spark, "replace-files")
    raw = adapter.raw_tripdata(spark, sf_dir, "yellow")
    typed = raw.select(*[F.col(f.name).cast(f.dataType) for f in trip_schema("yellow").fields])
    month = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    named_files(typed, F.concat(F.lit("yellow_tripdata_"), month, F.lit(".csv")), root)
    loads.backfill(spark, root, ["yellow"], *_months_around(raw, "tpep_pickup_datetime"), db, "warehouse", "replace")
    return spark.table(f"{db}.yellow_tripdata").groupBy("filename").agg(F.count(F.lit(1)).alias("rows"))


@gate("describe_lineitem", """
select cast(row_number() over () - 1 as int) as position, column_name,
  case column_type when 'VARCHAR' then 'string' when 'TIMESTAMP' then 'timestamp_ntz' when 'INTEGER' then 'int'
    else lower(column_type) end as data_type, (select count(*) from lineitem) as row_count
from (describe lineitem)""")
def describe_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns, types and row count of a table (PRJ-8)."""
    return loads.describe_table(adapter.table(spark, sf_dir, "lineitem"))


_TEXTS = ("case l_linenumber % 4 when 0 then cast(l_quantity as varchar) when 1 then ' ' || cast(cast(l_quantity as int) as varchar) || ' ' "
          "when 2 then 'abc' || cast(l_linenumber as varchar) end")


@gate("safe_cast_text", f"""select l_orderkey, l_partkey, l_suppkey, l_linenumber, cast(round(try_cast({_TEXTS} as decimal(38,9)), 0) as int) as value
from lineitem""")
def safe_cast_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers with decimals or blanks around them, words and NULL, cast without an error (FN-3)."""
    n = F.col("l_linenumber") % 4
    text = F.when(n == 0, F.col("l_quantity").cast("string")).when(
        n == 1, F.concat(F.lit(" "), F.col("l_quantity").cast("int").cast("string"), F.lit(" "))).when(
        n == 2, F.concat(F.lit("abc"), F.col("l_linenumber").cast("string")))
    return adapter.table(spark, sf_dir, "lineitem").withColumn("text", text).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", safe_cast("text", "int").alias("value"))


@gate("stored_view", "select o_orderstatus, count(*) as orders from orders where o_totalprice > 1000 group by 1")
def stored_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view in the catalog over a stored table; another session reads it (SNK-6)."""
    db = scratch_database(spark, "views")
    tables.write_replace(adapter.table(spark, sf_dir, "orders"), f"{db}.orders_stored")
    tables.write_stored_view(spark, f"{db}.large_orders", f"select * from {db}.orders_stored where o_totalprice > 1000")
    seen = spark.newSession().table(f"{db}.large_orders").count()
    view = spark.table(f"{db}.large_orders")
    return view.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders")).where(F.lit(seen) >= F.col("orders"))
