"""Gate queries of the file sources.

Each gate writes its input files with Spark from the driver tables into a new
folder under the shared work root, then reads them back with the source
operator under test.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tripmart.functions.columns import avg_rounded, month_start, row_hash
from tripmart.operators.joins import estimated_bytes
from tripmart.operators.transforms import keep_columns, keep_record_columns
from tripmart.plans import loads, oracle, reports
from tripmart.plans.gate import gate
from tripmart.plans.gate_models import ROW_HASH_COLS, ROW_HASH_SQL
from tripmart.plans.gate_reports import RANGE_END, RANGE_START
from tripmart.plans.gate_sinks import LOADED_SCHEMA
from tripmart.session import scratch_database, scratch_dir
from tripmart.sinks import layout, tables
from tripmart.sinks.tables import materialize
from tripmart.sources import adapter, files, trips

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.table(spark, sf_dir, "orders").select(*ORDER_COLS)


def _orders_schema(spark: SparkSession, sf_dir: str) -> StructType:
    return _orders(spark, sf_dir).schema


def named_files(df: DataFrame, name, root: str, header: bool = True) -> None:
    """One CSV file per value of ``name``, with that file name, as the files
    come from their publisher (a month's file is bounded)."""
    spark = df.sparkSession
    df.withColumn("source", name).repartition("source").write.partitionBy("source").option("header", header).csv(root + "-parts")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.Path(root))
    for folder in fs.listStatus(hadoop.Path(root + "-parts")):
        if folder.isDirectory():
            target = folder.getPath().getName().partition("=")[2]
            part, = [f for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
            fs.rename(part.getPath(), hadoop.Path(root, target))


# --- CSV ---------------------------------------------------------------------

@gate("csv_typed_scan", "select * from orders")
def csv_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gzip CSV with a header, read back with the explicit typed schema."""
    path = scratch_dir(spark, "csv")
    _orders(spark, sf_dir).write.option("header", True).option("compression", "gzip").csv(path)
    return files.read_csv(spark, path, _orders_schema(spark, sf_dir))


@gate("csv_copy_in", f"""select {ROW_HASH_SQL} as unique_row_id, 'orders_copy.csv' as filename,
  o_orderkey, o_custkey, o_orderstatus, cast(cast(o_totalprice as decimal(18,2)) as double) as o_totalprice,
  o_orderdate, o_orderpriority from orders""")
def csv_copy_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headerless CSV loaded by position into the named columns of the loaded
    schema; the row id and file name are then set (SNK-16)."""
    path = scratch_dir(spark, "copy")
    _orders(spark, sf_dir).write.option("header", False).csv(path)
    staged = files.read_csv(spark, path, LOADED_SCHEMA, header=False, columns=ORDER_COLS)
    staged = staged.withColumn("unique_row_id", row_hash(staged.schema, ROW_HASH_COLS)) \
                   .withColumn("filename", F.lit("orders_copy.csv"))
    return staged.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@gate("csv_copy_in_unset", """select cast(null as varchar) as unique_row_id, cast(null as varchar) as filename, o_orderkey, o_custkey,
  o_orderstatus, cast(cast(o_totalprice as decimal(18,2)) as double) as o_totalprice, o_orderdate, o_orderpriority from orders""")
def csv_copy_in_unset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Right after the copy the columns that are not in its list are NULL."""
    path = scratch_dir(spark, "copy")
    _orders(spark, sf_dir).write.option("header", False).csv(path)
    staged = files.read_csv(spark, path, LOADED_SCHEMA, header=False, columns=ORDER_COLS)
    return staged.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@gate("quoted_zone_csv", """select n_nationkey as locationid, r_name as borough, n_name || ', "' || r_name || '"' as zone,
  'Boro Zone' as service_zone from nation join region on n_regionkey = r_regionkey""")
def quoted_zone_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted comma-separated seed whose zone names hold commas and quotes (SRC-11)."""
    path = scratch_dir(spark, "zones")
    z = adapter.zones(spark, sf_dir)
    z = z.withColumn("zone", F.concat("zone", F.lit(', "'), "borough", F.lit('"')))
    z.toDF("LocationID", "Borough", "Zone", "service_zone").write.option("header", True).option("quoteAll", True) \
        .option("escape", '"').csv(path)
    return files.read_seed(spark, path)


@gate("csv_external", "select * from orders")
def csv_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External CSV table whose files carry a surplus trailing column."""
    path = scratch_dir(spark, "ext")
    o = _orders(spark, sf_dir)
    o.withColumn("o_comment", F.concat(F.lit("c-"), "o_orderstatus")).write.option("header", True).csv(path)
    db = scratch_database(spark, "ext")
    return files.external_table(spark, f"{db}.orders_ext", path, o.schema, "csv")


@gate("tsv_seed", "with " + oracle.ZONES + "\nselect * from zones")
def tsv_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated seed with CRLF line ends and an upper-case header, read
    with inferred types and a lower-cased header (zones are a bounded seed,
    so it is written as one file)."""
    path = scratch_dir(spark, "seed")
    z = adapter.zones(spark, sf_dir)
    header = spark.createDataFrame([("LocationID\tBorough\tZone\tservice_zone\r",)], "line string") \
        .select(F.lit(0).alias("k"), F.lit(0).alias("id"), "line")
    rows = z.select(F.lit(1).alias("k"), F.col("locationid").alias("id"),
                    F.concat(F.concat_ws("\t", F.col("locationid").cast("string"), "borough", "zone",
                                         "service_zone"), F.lit("\r")).alias("line"))
    header.unionByName(rows).orderBy("k", "id").coalesce(1).select("line").write.text(path)
    seed = files.read_seed(spark, path, sep="\t")
    return seed.select(F.col("locationid").alias("location_id"), "borough", "zone", "service_zone")


TYPE_MAP = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double",
            "o_orderdate": "timestamp_ntz"}


@gate("header_schema", """select o_orderkey as O_ORDERKEY, o_custkey as O_CUSTKEY, o_orderstatus as O_ORDERSTATUS,
  o_totalprice as O_TOTALPRICE, o_orderdate as O_ORDERDATE, o_orderpriority as O_ORDERPRIORITY,
  o_orderstatus || '-' || o_orderpriority as O_COMMENT from orders""")
def header_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types from the header names; the unknown O_COMMENT column is text."""
    path = scratch_dir(spark, "hdr")
    o = _orders(spark, sf_dir).withColumn("o_comment", F.concat_ws("-", "o_orderstatus", "o_orderpriority"))
    o.toDF(*[c.upper() for c in o.columns]).write.option("header", True).csv(path)
    return files.read_csv_header_typed(spark, path, TYPE_MAP)


_RAW_COLS = """cast({vendor} as int) as vendor, cast({pu} as int) as pu, cast({do} as int) as do_, cast({pay} as int) as payment_type,
  cast({rate} as int) as rate_code, {yellow} as yellow_pickup, {green} as green_pickup, {fhv} as fhv_pickup, cast({fare} as double) as fare,
  cast({fee} as double) as ehail_fee, {base} as base, {affiliated} as affiliated, cast({sr} as int) as sr_flag"""
_TRIP_COLS = dict(vendor="VendorID", pu="PULocationID", do="DOLocationID", pay="payment_type", rate="RatecodeID", yellow="null", green="null",
                  fhv="null", fare="fare_amount", fee="null", base="null", affiliated="null", sr="null")
_FHV_COLS = dict(dict.fromkeys(_TRIP_COLS, "null"), pu="case when l_linenumber = 6 then 99 else c_nationkey end", do="s_nationkey", fhv="o_orderdate",
                 base="case when l_linenumber <> 7 then format('B{:05d}', l_suppkey) end", affiliated="format('B{:05d}', c_custkey % 1000)",
                 sr="case when l_returnflag = 'R' then 1 end")
TRIP_TYPES = "int,int,int,int,int,timestamp_ntz,timestamp_ntz,timestamp_ntz,decimal(38,9),decimal(38,9),string,string,int"


@gate("header_trip_types", "with " + oracle.JOINED + ",\n" + oracle.raw_sql("green") + ",\n" + oracle.raw_sql("yellow") + f"""
select *, '{TRIP_TYPES}' as types from (
  select {_RAW_COLS.format(**dict(_TRIP_COLS, green="lpep_pickup_datetime", fee="ehail_fee"))} from green_raw
  union all select {_RAW_COLS.format(**dict(_TRIP_COLS, yellow="tpep_pickup_datetime"))} from yellow_raw
  union all select {_RAW_COLS.format(**_FHV_COLS)} from j)""")
def header_trip_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of all three kinds in one folder, typed from their headers by the
    shipped type map; each kind has columns that the others lack (SRC-12)."""
    path = scratch_dir(spark, "trip-heads")
    with tables.staged(adapter.trip_rows(spark, sf_dir), "trip-rows") as (joined, _):
        for taxi in ("green", "yellow", "fhv"):
            raw = adapter.raw_tripdata(spark, sf_dir, taxi, joined)
            typed = raw.select(*[F.col(c).cast(trips.TYPE_MAP[c.lower()]) for c in raw.columns])
            # As their publisher packs them.
            typed.write.mode("append").option("header", True).option("compression", "gzip") \
                .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    back = files.read_csv_header_typed(spark, path, trips.TYPE_MAP)
    names = ["VendorID", "PULocationID", "DOLocationID", "payment_type", "RatecodeID", "tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime",
             "fare_amount", "ehail_fee", "dispatching_base_num", "Affiliated_base_number", "SR_Flag"]
    kinds = ",".join(back.select(n).schema[0].dataType.simpleString() for n in names)
    out = ["vendor", "pu", "do_", "payment_type", "rate_code", "yellow_pickup", "green_pickup", "fhv_pickup", "fare", "ehail_fee", "base", "affiliated", "sr_flag"]
    return back.select(*[(F.col(n).cast("double") if o in ("fare", "ehail_fee") else F.col(n)).alias(o) for n, o in zip(names, out)],
                       F.lit(kinds).alias("types"))


@gate("head_rows", "select least(count(*), 100) as rows, true as all_in_table, true as all_different from orders")
def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of a scan: as many as asked for, rows of the table, each once (SRC-14)."""
    o = _orders(spark, sf_dir)
    head = materialize(loads.head_rows(o, 100), "head")
    found = head.join(o.withColumn("known", F.lit(1)), ORDER_COLS, "left")
    return found.agg(F.count(F.lit(1)).alias("rows"), (F.count("known") == F.count(F.lit(1))).alias("all_in_table"),
                     (F.countDistinct("o_orderkey") == F.count(F.lit(1))).alias("all_different"))


# --- JSON --------------------------------------------------------------------

# Products are written as documents {"products": [...]} of at most 100
# records (part keys of one hundred); products of size 1 carry no brand key.
_PRODUCTS_SQL = """products as (select coalesce(case when p_size = 1 then null else p_brand end, 'N/A') as brand,
  p_retailprice as price from part)"""


def _write_products(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "json")
    p = adapter.table(spark, sf_dir, "part")
    rec = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"),
                   F.when(F.col("p_size") != 1, F.col("p_brand")).alias("brand"),
                   F.col("p_retailprice").alias("price"))
    docs = p.groupBy(F.floor(F.col("p_partkey") / 100).alias("page")).agg(F.collect_list(rec).alias("products"))
    tables.write_json(docs.select("products"), path)
    return path


@gate("json_records", "with " + _PRODUCTS_SQL + "\nselect brand, price from products")
def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = files.read_json_records(spark, _write_products(spark, sf_dir), "products")
    kept = keep_columns(recs, ["brand", "price"])
    return kept.select("brand", F.col("price").try_cast("double").alias("price"))


@gate("json_record_nulls", """select p_partkey as id, case p_size when 1 then 'N/A' when 2 then null else p_brand end as brand,
  case when p_size = 3 then null else p_retailprice end as price, 'N/A' as colour from part""")
def json_record_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in which a key is absent (N/A) or explicitly null (NULL)."""
    path = scratch_dir(spark, "json-nulls")
    p = adapter.table(spark, sf_dir, "part")
    brand = F.when(F.col("p_size") != 2, F.col("p_brand")).alias("brand")
    price = F.when(F.col("p_size") != 3, F.col("p_retailprice")).alias("price")
    text = lambda *fields: F.to_json(F.struct(F.col("p_partkey").alias("id"), *fields), {"ignoreNullFields": "false"})
    rows = p.select(F.floor(F.col("p_partkey") / 100).alias("page"), F.when(F.col("p_size") == 1, text(price)).otherwise(text(brand, price)).alias("r"))
    docs = rows.groupBy("page").agg(F.concat(F.lit('{"products": ['), F.array_join(F.collect_list("r"), ", "), F.lit("]}")).alias("value"))
    docs.select("value").write.text(path)
    kept = keep_record_columns(files.read_json_variants(spark, path, "$.products"), ["id", "brand", "price", "colour"])
    return kept.select(F.col("id").cast("long").alias("id"), "brand", F.col("price").cast("double").alias("price"), "colour")


@gate("avg_price_by_brand", "with " + _PRODUCTS_SQL + """
select brand, cast((2 * sum(cast(cast(price as decimal(18,2)) * 100 as bigint)) + count(*))
                   // (2 * count(*)) as double) / 100 as avg_price
from products group by brand""")
def avg_price_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = files.read_json_records(spark, _write_products(spark, sf_dir), "products")
    kept = keep_columns(recs, ["brand", "price"])
    return kept.groupBy("brand").agg(avg_rounded("price", 2).alias("avg_price"))


# --- file names as data, month fan-in -------------------------------------------

@gate("rows_by_source_file", "with " + oracle.TRIPS + """
select lower(service_type) || '_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.csv' as filename,
       lower(service_type) as taxi, cast(year(pickup_datetime) as int) as file_year,
       cast(month(pickup_datetime) as int) as file_month, count(*) as rows
from trips group by all""")
def rows_by_source_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips written as one CSV file per (type, month), read back; the file
    name is parsed from each row's path and rows counted per file."""
    path = scratch_dir(spark, "files")
    t = adapter.trips(spark, sf_dir)
    name = F.concat(F.lower("service_type"), F.lit("_tripdata_"), F.date_format("pickup_datetime", "yyyy-MM"), F.lit(".csv"))
    rows = t.select("l_orderkey", "pickup_datetime", "fare_amount")
    named_files(t.select("l_orderkey", "pickup_datetime", "fare_amount", name.alias("source")), F.col("source"), path)
    # Files that only look like trip files are not read.
    decoy = F.concat(F.lit("old_yellow_tripdata_2020-0"), F.lit("1_bak.csv"))
    named_files(rows.limit(5), decoy, path + "-decoys")
    back = spark.read.option("header", True).schema("l_orderkey bigint, pickup_datetime timestamp_ntz, fare_amount decimal(18,2)") \
        .csv([path, path + "-decoys"])
    named = files.with_source_file(back)
    return named.groupBy("filename", "taxi", "file_year", "file_month").agg(F.count(F.lit(1)).alias("rows"))


FAN_START, FAN_END = _dt.date(1997, 6, 1), _dt.date(2001, 12, 31)
EXTRACTED_AT = _dt.datetime(2024, 2, 1)


@gate("month_fan_in", """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  case when year(o_orderdate) = 1999 then null else o_orderpriority end as o_orderpriority,
  case when year(o_orderdate) = 1998 then 'c-' || o_orderstatus end as o_comment,
  case year(o_orderdate) when 1998 then cast(o_custkey as double) when 1999 then cast(cast(o_totalprice as decimal(20,2)) as double)
    when 2000 then cast(cast(o_orderkey as decimal(18,4)) / 8 as double) end as o_extra,
  timestamp '2024-02-01 00:00:00' as extracted_at
from orders where o_orderdate >= timestamp '1997-06-01'""")
def month_fan_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as one Parquet folder per month; 1998 files carry an
    extra column and customer keys as DOUBLE, 1999 files lack a column and
    have customer keys as INT, months after the data have no file.  A column
    of the files only is BIGINT in 1998, DECIMAL(20,2) in 1999, DECIMAL(18,4)
    in 2000 and absent from the others."""
    root = scratch_dir(spark, "months")
    o = _orders(spark, sf_dir)
    fname = F.concat(F.lit("orders_tripdata_"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".parquet"))
    yr = F.year("o_orderdate")
    o.where(~yr.isin(1998, 1999, 2000)).withColumn("file", fname).write.partitionBy("file").parquet(root)
    o.where(yr == 2000).withColumn("o_extra", (F.col("o_orderkey") / 8).cast("decimal(18,4)")) \
        .withColumn("file", fname).write.mode("append").partitionBy("file").parquet(root)
    o.where(yr == 1998).withColumn("o_comment", F.concat(F.lit("c-"), "o_orderstatus")).withColumn("o_extra", F.col("o_custkey")) \
        .withColumn("o_custkey", F.col("o_custkey").cast("double")) \
        .withColumn("file", fname).write.mode("append").partitionBy("file").parquet(root)
    o.where(yr == 1999).drop("o_orderpriority").withColumn("o_custkey", F.col("o_custkey").cast("int")) \
        .withColumn("o_extra", F.col("o_totalprice").cast("decimal(20,2)")).withColumn("file", fname) \
        .write.mode("append").partitionBy("file").parquet(root)
    template = "{root}/file={taxi}_tripdata_{year:04d}-{month:02d}.parquet"
    found = files.read_months(spark, root, ["orders"], FAN_START, FAN_END, o.schema, EXTRACTED_AT, template)
    return found.withColumn("o_extra", F.col("o_extra").cast("double"))


# --- partitioned layout ----------------------------------------------------------

_VENDOR_SQL = "with " + oracle.TRIPS + f"""
select distinct vendor_id from trips
where dropoff_datetime >= timestamp '{RANGE_START}' and dropoff_datetime <= timestamp '{RANGE_END}'"""


def _clustered_trips(spark: SparkSession, sf_dir: str) -> str:
    db = scratch_database(spark, "clustered")
    name = f"{db}.trips_clustered"
    t = adapter.trips(spark, sf_dir).select("vendor_id", "pickup_datetime", "dropoff_datetime",
                                            "fare_amount", "total_amount")
    tables.write_clustered(t, name, "dropoff_datetime", ["vendor_id"], "dropoff_date")
    return name


@gate("distinct_vendors_in_range_partitioned", _VENDOR_SQL)
def distinct_vendors_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _clustered_trips(spark, sf_dir)
    return reports.distinct_in_range(spark.table(name), "vendor_id", "dropoff_datetime",
                                     RANGE_START, RANGE_END, date_col="dropoff_date")


def _in_days(df: DataFrame, date_col: str) -> DataFrame:
    from tripmart.functions.columns import ts_literal
    return df.where((F.col(date_col) >= ts_literal(RANGE_START).cast("date")) & (F.col(date_col) <= ts_literal(RANGE_END).cast("date")))


def _layouts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """What a scan of the range reads of a plain and of the date-partitioned copy of the trips."""
    plain = f"{scratch_database(spark, 'plain')}.trips_plain"
    adapter.trips(spark, sf_dir).select("vendor_id", "pickup_datetime", "dropoff_datetime", "fare_amount",
                                        "total_amount").write.format("parquet").saveAsTable(plain)
    return {"plain": spark.table(plain), "partitioned": _in_days(spark.table(_clustered_trips(spark, sf_dir)), "dropoff_date")}


def scan_report(spark: SparkSession, sf_dir: str) -> dict[str, dict[str, int]]:
    """Files and estimated bytes of the range scan on both layouts (INC-7), for the bench."""
    return {name: {"files_read": scanned.select(F.col("_metadata.file_path")).distinct().count(),
                   "estimated_bytes": estimated_bytes(scanned.select("vendor_id", "dropoff_datetime"))}
            for name, scanned in _layouts(spark, sf_dir).items()}


@gate("scan_estimate", "with " + oracle.TRIPS + f"""
select 'plain' as layout, count(*) as rows_scanned from trips
union all
select 'partitioned', count(*) from trips
where cast(dropoff_datetime as date) between date '{RANGE_START[:10]}' and date '{RANGE_END[:10]}'""")
def scan_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the scan of a date range has to read on a plain and on the date-partitioned copy of the trips (INC-7)."""
    parts = [scanned.agg(F.count(F.lit(1)).alias("rows_scanned")).select(F.lit(name).alias("layout"), "rows_scanned")
             for name, scanned in _layouts(spark, sf_dir).items()]
    return parts[0].unionByName(parts[1])


LAYOUT_FROM, LAYOUT_TO = "1998-02-01", "1998-05-31"
LAYOUT_KEYS = (100, 400)
LAYOUT_FILES = 32


def layout_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a query on a range of dates and customers reads of three copies of
    the orders (in no order, partitioned by month, in Z-order of both columns):
    layout, rows found, and files, row groups, rows and bytes by the footers;
    ``same_rows``: the reached files alone hold all rows found."""
    db = scratch_database(spark, "layouts")
    o = _orders(spark, sf_dir)
    o.repartition(LAYOUT_FILES, F.xxhash64("o_orderkey")).write.format("parquet").saveAsTable(f"{db}.plain")
    tables.write_replace(o.withColumn("order_month", month_start("o_orderdate")), f"{db}.partitioned", ["order_month"])
    layout.write_z_ordered(o, f"{db}.z_ordered", ["o_orderdate", "o_custkey"], LAYOUT_FILES)
    kinds = StructType([o.schema["o_orderdate"], o.schema["o_custkey"]])
    low, high = (F.lit(x).cast(kinds["o_orderdate"].dataType) for x in (f"{LAYOUT_FROM} 00:00:00", f"{LAYOUT_TO} 23:59:59"))
    keys = tuple(F.lit(k).cast("long") for k in LAYOUT_KEYS)
    found = F.col("o_orderdate").between(low, high) & F.col("o_custkey").between(*keys)
    out = None
    for name in ("plain", "partitioned", "z_ordered"):
        zones = layout.zone_map(spark, layout.files_of(spark, f"{db}.{name}"), kinds)
        hit = layout.reached(zones, {"o_orderdate": (low, high), "o_custkey": keys})
        n = spark.table(f"{db}.{name}").where(found).count()
        names = [r.file for r in hit.select("file").distinct().collect()]
        held = spark.read.schema(o.schema).parquet(*names).where(found).count() if names else 0
        row = layout.scan_cost(hit, kinds.names).select(F.lit(name).alias("layout"), F.lit(n).cast("long").alias("found"), "*",
                                                        F.lit(held == n).alias("same_rows"))
        out = row if out is None else out.unionByName(row)
    return out


@gate("layout_scan", f"""
with n as (select count(*) as found from orders where o_orderdate >= timestamp '{LAYOUT_FROM}' and o_orderdate <= timestamp '{LAYOUT_TO} 23:59:59'
  and o_custkey between {LAYOUT_KEYS[0]} and {LAYOUT_KEYS[1]})
select layout, found, less, less as fewer_files, less as fewer_groups, less as fewer_bytes, true as same_rows
from n, (values ('plain', false), ('partitioned', true), ('z_ordered', true)) as l(layout, less)""")
def layout_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from less than half the files, row groups and bytes of
    the plain copy, where the layout follows the query (INC-7, SNK-11)."""
    every = Window.partitionBy(F.lit(1))      # three rows
    less = {c: F.col(c) * 2 < F.max(F.when(F.col("layout") == "plain", F.col(c))).over(every) for c in ("files", "row_groups", "bytes")}
    return materialize(layout_costs(spark, sf_dir), "costs").select(
        "layout", "found", (less["files"] & less["row_groups"] & less["bytes"]).alias("less"), less["files"].alias("fewer_files"),
        less["row_groups"].alias("fewer_groups"), less["bytes"].alias("fewer_bytes"), "same_rows")


@gate("external_parquet_glob", """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  o_orderpriority from orders where o_orderdate >= timestamp '1998-01-01' and o_orderdate < timestamp '1999-01-01'""")
def external_parquet_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as one Parquet folder per month; a view over the glob
    of one year's files, schema read from the files (SRC-4)."""
    root = scratch_dir(spark, "glob")
    o = _orders(spark, sf_dir)
    fname = F.concat(F.lit("orders_tripdata_"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".parquet"))
    o.withColumn("file", fname).write.partitionBy("file").parquet(root)
    view = f"orders_1998_{abs(hash(root)) % 10**8}"
    return files.external_view(spark, view, f"{root}/file=orders_tripdata_1998-*.parquet").select(*ORDER_COLS)
