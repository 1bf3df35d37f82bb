"""Monthly file loads of the orchestrated flows.

One lazy chain per file: typed read -> file name and row id columns ->
insert-only merge into the main table.  The staging tables of the flows
disappear: the staged frame is never materialised on its own.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.functions.columns import row_hash
from tripmart.sinks import tables
from tripmart.sources import files
from tripmart.sources.trips import trip_schema

# The fields of the load row id.  The row-store variant hashes
# seven fields, the warehouse variant five; both concatenate without a
# separator after replacing NULL by ''.
ROW_ID_FIELDS = {
    "rowstore": ["VendorID", "{p}_pickup_datetime", "{p}_dropoff_datetime", "PULocationID", "DOLocationID",
                 "fare_amount", "trip_distance"],
    "warehouse": ["VendorID", "{p}_pickup_datetime", "{p}_dropoff_datetime", "PULocationID", "DOLocationID"],
}
EPOCH = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)
#: Buckets of a load target on its row id: a merge then shuffles the month, not the table.
ROW_ID_BUCKETS = 16
PREFIX = {"yellow": "tpep", "green": "lpep"}


def trip_file_name(taxi: str, year: int, month: int, ext: str = ".csv") -> str:
    return f"{taxi}_tripdata_{year:04d}-{month:02d}{ext}"


def row_id_fields(taxi: str, variant: str = "rowstore") -> list[str]:
    """Row-id fields for a trip type (FLT-10).  For-hire trips have no layout
    in the merge flows (the reference falls back to the green names, which
    the for-hire files do not have), so they are refused."""
    if taxi not in PREFIX:
        raise ValueError(f"no merge layout for taxi type {taxi!r}")
    return [f.format(p=PREFIX[taxi]) for f in ROW_ID_FIELDS[variant]]


def stage_for_load(df: DataFrame, taxi: str, filename: str | Column, variant: str = "rowstore") -> DataFrame:
    """``unique_row_id`` and ``filename`` in front of the raw columns
    (SNK-16, FN-4, FN-5)."""
    fname = F.lit(filename) if isinstance(filename, str) else filename
    return df.select(row_hash(df.schema, row_id_fields(taxi, variant)).alias("unique_row_id"),
                     fname.alias("filename"), *df.columns)


def load_month(spark: SparkSession, raw: DataFrame, taxi: str, year: int, month: int, target: str,
               variant: str = "rowstore", mode: str = "merge") -> None:
    """Load one (type, month) file into ``target``: ``mode='merge'`` is the
    insert-only merge on the row id (re-runs insert nothing), ``'replace'``
    rebuilds the table from this file (the warehouse flow's CTAS)."""
    staged = stage_for_load(raw, taxi, trip_file_name(taxi, year, month), variant)
    if mode == "replace":
        tables.write_replace(staged, target)
        return
    tables.ensure_table(spark, target, staged.schema, bucket_by=(ROW_ID_BUCKETS, ["unique_row_id"]))
    tables.merge_insert_new(staged, target, ["unique_row_id"])


def load_files(spark: SparkSession, paths: Sequence[str], taxi: str, target: str, variant: str = "rowstore") -> None:
    """Merge several month files of a type into ``target`` by one job, with
    the rows that merging them one after another gives: a row id that occurs
    in several files comes from the first of them, with all its rows there."""
    raw = files.read_csv(spark, paths, trip_schema(taxi))
    # A file may be a folder of parts.
    name = F.regexp_extract("_metadata.file_path", rf"({taxi}_tripdata_\d{{4}}-\d{{2}}\.csv)(?:/[^/]*)?$", 1)
    staged = stage_for_load(raw.select("*", name.alias("__file")), taxi, F.col("__file"), variant).drop("__file")
    # Dealt out like the target's buckets, once for the window, the merge's join and the insert.
    staged = staged.repartition(ROW_ID_BUCKETS, "unique_row_id")
    first = F.min("filename").over(Window.partitionBy("unique_row_id"))
    kept = staged if len(paths) == 1 else staged.withColumn("__first", first).where(F.col("filename") == F.col("__first")).drop("__first")
    tables.ensure_table(spark, target, kept.schema, bucket_by=(ROW_ID_BUCKETS, ["unique_row_id"]))
    tables.merge_insert_new(kept, target, ["unique_row_id"], dealt=ROW_ID_BUCKETS)


#: Month files of a type that a backfill merges by one job.
MONTHS_AT_ONCE = 12


def backfill(spark: SparkSession, root: str, types: Sequence[str], start: _dt.date, end: _dt.date, db: str,
             variant: str = "rowstore", mode: str = "merge", template: str = "{root}/{name}", at_once: int = MONTHS_AT_ONCE) -> list[str]:
    """Load every existing month file of the range and types, oldest first,
    each into its type's table ``<db>.<taxi>_tripdata`` (INC-2), ``at_once``
    files by a job.  Files are typed by the shipped schemas; months without a
    file are left out; a second run inserts nothing.  With ``mode='replace'``
    each file replaces the table, so only the last one has to be read.
    Returns the names of the files found."""
    found = []
    for year, month, taxi in files.plan_months(start, end, types):
        name = trip_file_name(taxi, year, month)
        path = template.format(root=root, name=name)
        if files.path_exists(spark, path):
            found.append((taxi, year, month, name, path))
    for taxi in dict.fromkeys(types):
        own = [f for f in found if f[0] == taxi]
        target = f"{db}.{taxi}_tripdata"
        if mode == "replace" and own:
            _, year, month, _, path = own[-1]
            load_month(spark, files.read_csv(spark, path, trip_schema(taxi)), taxi, year, month, target, variant, mode)
        elif mode != "replace":
            for i in range(0, len(own), at_once):
                load_files(spark, [f[4] for f in own[i:i + at_once]], taxi, target, variant)
    return [f[3] for f in found]


def record_load(spark: SparkSession, ledger: str, load_id: str, status: str,
                inserted_at: _dt.datetime | None = None) -> None:
    """Append one ledger row (INC-4): load id, time, status."""
    at = F.current_timestamp()
    if inserted_at is not None:
        if inserted_at.tzinfo is None:  # a time without a zone is UTC
            inserted_at = inserted_at.replace(tzinfo=_dt.timezone.utc)
        at = F.timestamp_micros(F.lit((inserted_at - EPOCH) // _dt.timedelta(microseconds=1)))
    row = spark.range(1).select(F.lit(load_id).alias("load_id"), at.alias("inserted_at"), F.lit(status).alias("status"))
    tables.write_append(row, ledger)


def describe_table(df: DataFrame) -> DataFrame:
    """Column names and types with the row count (PRJ-8); the count is one
    aggregate (answered from Parquet footers for a plain scan)."""
    n = df.agg(F.count(F.lit(1)).alias("row_count"))
    cols = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                              F.lit(f.dataType.simpleString()).alias("data_type"))
                     for i, f in enumerate(df.schema.fields)])
    return n.select(F.explode(cols).alias("c"), "row_count").select("c.*", "row_count")


def head_rows(df: DataFrame, n: int = 100) -> DataFrame:
    """Row-limited scan (SRC-14): the first ``n`` rows the scan returns."""
    return df.limit(n)
