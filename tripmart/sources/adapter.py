"""Driver tables -> trip-shaped sources.

The test data is a TPC-H-like star schema.  The reference computes over taxi
trips, so this module derives trip sources from it with joins only (no row is
invented):

* ``trips``      - the conformed trip view every report query uses;
* ``raw_tripdata`` - TLC-file-like raw sources (green / yellow / fhv) that the
  staging models normalise;
* ``zones``      - the zone lookup, from nation and region.

All joins are equi-joins.  lineitem-orders is the only large-large join; the
customer and supplier sides are broadcast only behind a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Orders meet their customers before the lineitems do, which then move once.
    oc = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    j = l.join(oc, l["l_orderkey"] == oc["o_orderkey"], "inner")
    return j.join(s, j["l_suppkey"] == s["s_suppkey"], "inner")


def trip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined rows with the columns that raw sources are made of, for
    callers that store them once and make several sources of them."""
    return _joined(spark, sf_dir).select(
        "l_linenumber", "l_linestatus", "l_returnflag", "l_shipdate", "l_quantity", "l_extendedprice", "l_tax", "l_discount", "l_suppkey",
        "o_orderdate", "o_totalprice", "o_orderpriority", "c_custkey", "c_nationkey", "s_nationkey")


def _payment_code() -> F.Column:
    return F.nullif(F.substring("o_orderpriority", 1, 1).cast("int"), F.lit(5))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conformed trip view (same rows as the ``trips`` CTE of the oracle)."""
    j = _joined(spark, sf_dir)
    ln = F.col("l_linenumber")
    return j.select(
        F.when(ln == 7, F.lit(None).cast("int")).otherwise(ln % 5).alias("vendor_id"),
        F.when(F.col("l_linestatus") == "F", F.lit("Green")).otherwise(F.lit("Yellow")).alias("service_type"),
        F.when(ln == 6, F.lit(99)).otherwise(F.col("c_nationkey")).alias("pickup_location_id"),
        F.col("s_nationkey").alias("dropoff_location_id"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        F.col("l_quantity").cast("int").alias("passenger_count"),
        F.col("l_quantity").cast("decimal(18,2)").alias("trip_distance"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("fare_amount"),
        F.col("l_tax").cast("decimal(18,2)").alias("mta_tax"),
        F.col("l_discount").cast("decimal(18,2)").alias("tip_amount"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_amount"),
        _payment_code().alias("payment_type"),
        "l_orderkey", "l_partkey", "l_suppkey",
    )


def raw_tripdata(spark: SparkSession, sf_dir: str, taxi: str, joined: DataFrame | None = None) -> DataFrame:
    """A raw TLC-like source: BIGINT ids, DOUBLE amounts, ``lpep_``/``tpep_``
    timestamps.  Green rows are the lineitems with status 'F', yellow the
    rest; for-hire rows are all lineitems in the for-hire layout.  ``joined``:
    the stored ``trip_rows``, if the caller has them."""
    j = _joined(spark, sf_dir) if joined is None else joined
    ln = F.col("l_linenumber")
    vendor = F.when(ln == 7, F.lit(None).cast("bigint")).otherwise((ln % 5).cast("bigint"))
    pu = F.when(ln == 6, F.lit(99)).otherwise(F.col("c_nationkey")).cast("bigint")
    do = F.col("s_nationkey").cast("bigint")
    if taxi == "fhv":
        return j.select(
            F.when(ln == 7, F.lit(None).cast("string"))
             .otherwise(F.format_string("B%05d", F.col("l_suppkey"))).alias("dispatching_base_num"),
            F.format_string("B%05d", F.col("c_custkey") % 1000).alias("Affiliated_base_number"),
            F.col("o_orderdate").alias("pickup_datetime"),
            F.col("l_shipdate").alias("dropOff_datetime"),
            pu.alias("PUlocationID"), do.alias("DOlocationID"),
            F.when(F.col("l_returnflag") == "R", F.lit(1)).cast("bigint").alias("SR_Flag"),
        )
    if taxi not in ("green", "yellow"):
        raise ValueError(f"unknown taxi type {taxi!r}")
    prefix = "lpep" if taxi == "green" else "tpep"
    status = "F" if taxi == "green" else "O"
    j = j.where(F.col("l_linestatus") == status)
    cols = [
        vendor.alias("VendorID"),
        F.col("o_orderdate").alias(f"{prefix}_pickup_datetime"),
        F.col("l_shipdate").alias(f"{prefix}_dropoff_datetime"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        ln.cast("double").alias("RatecodeID"),
        pu.alias("PULocationID"), do.alias("DOLocationID"),
        F.col("l_quantity").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        ((ln % 3).cast("double") * F.lit(0.5)).alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        F.col("l_discount").alias("tip_amount"),
        F.when(F.col("c_nationkey") == F.col("s_nationkey"), F.lit(6.55))
         .otherwise(F.lit(0.0)).alias("tolls_amount"),
    ]
    if taxi == "green":
        cols.append(F.lit(None).cast("double").alias("ehail_fee"))
    cols += [
        F.lit(0.3).alias("improvement_surcharge"),
        F.col("o_totalprice").alias("total_amount"),
        _payment_code().cast("double").alias("payment_type"),
    ]
    if taxi == "green":
        cols.append(F.when(F.col("l_returnflag") == "A", F.lit(2.0)).otherwise(F.lit(1.0)).alias("trip_type"))
    cols.append(F.lit(0.0).alias("congestion_surcharge"))
    return j.select(*cols)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup in the seed layout (locationid, borough, zone, service_zone):
    one zone per nation, borough = its region."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"], "left").select(
        F.col("n_nationkey").alias("locationid"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.lit("Boro Zone").alias("service_zone"),
    )


def api_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips in the layout of the paged API load: text payment type
    ('Credit' for code 1), tip/fare/total amounts and a per-row load id
    (one load per pickup year)."""
    t = trips(spark, sf_dir)
    return t.select(
        F.when(F.col("payment_type") == 1, F.lit("Credit"))
         .otherwise(F.col("payment_type").cast("string")).alias("payment_type"),
        F.col("pickup_datetime").alias("trip_pickup_date_time"),
        F.col("dropoff_datetime").alias("trip_dropoff_date_time"),
        F.col("trip_distance"), F.col("fare_amount").alias("fare_amt"),
        F.col("tip_amount").alias("tip_amt"), F.col("total_amount").alias("total_amt"),
        F.concat(F.lit("load_"), F.year("pickup_datetime").cast("string")).alias("_dlt_load_id"),
        "l_orderkey", "l_partkey", "l_suppkey",
    )


def load_ledger(api: DataFrame, all_pending: bool = False) -> DataFrame:
    """Load ledger derived from the loads present in ``api``: one row per
    load id, inserted at its last dropoff.  Loads of even years are
    ' Loaded ' (mixed case, padded), others carry the status code '0'; with
    ``all_pending`` every load is '0' (no 'loaded' row at all)."""
    g = api.groupBy(F.col("_dlt_load_id").alias("load_id")).agg(
        F.max("trip_dropoff_date_time").alias("inserted_at"))
    year = F.substring("load_id", 6, 4).cast("int")
    status = F.lit("0") if all_pending else F.when(year % 2 == 0, F.lit(" Loaded ")).otherwise(F.lit("0"))
    return g.select("load_id", "inserted_at", status.alias("status"))
