"""Row-set operators: normalisation, union, deduplication, enrichment.

All are compositions of DataFrame calls; the heavy work (joins, the shuffle of
the deduplication) is planned by Catalyst.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from tripmart.functions.columns import (
    cast_int, minutes_between, numeric, safe_cast, surrogate_key, vendor_name,
)

# --- staging (PRJ-1 .. PRJ-4) -----------------------------------------------

def _first_present(df: DataFrame, *names: str) -> Column:
    lower = {c.lower(): c for c in df.columns}
    for n in names:
        if n.lower() in lower:
            return F.col(lower[n.lower()])
    raise KeyError(f"none of {names} in {df.columns}")


def stage_green(df: DataFrame, dev_window: tuple | None = None) -> DataFrame:
    """Green raw -> common schema; rows without vendor dropped (FLT-1)."""
    c = lambda n: _first_present(df, n)
    out = df.where(c("vendorid").isNotNull()).select(
        cast_int(c("vendorid")).alias("vendor_id"),
        safe_cast(c("ratecodeid"), "int").alias("rate_code_id"),
        cast_int(c("pulocationid")).alias("pickup_location_id"),
        cast_int(c("dolocationid")).alias("dropoff_location_id"),
        c("lpep_pickup_datetime").alias("pickup_datetime"),
        c("lpep_dropoff_datetime").alias("dropoff_datetime"),
        c("store_and_fwd_flag").cast("string").alias("store_and_fwd_flag"),
        cast_int(c("passenger_count")).alias("passenger_count"),
        numeric(c("trip_distance")).alias("trip_distance"),
        safe_cast(c("trip_type"), "int").alias("trip_type"),
        numeric(c("fare_amount")).alias("fare_amount"),
        numeric(c("extra")).alias("extra"),
        numeric(c("mta_tax")).alias("mta_tax"),
        numeric(c("tip_amount")).alias("tip_amount"),
        numeric(c("tolls_amount")).alias("tolls_amount"),
        numeric(c("ehail_fee")).alias("ehail_fee"),
        numeric(c("improvement_surcharge")).alias("improvement_surcharge"),
        numeric(c("total_amount")).alias("total_amount"),
        safe_cast(c("payment_type"), "int").alias("payment_type"),
    )
    return sample_window(out, dev_window)


def stage_yellow(df: DataFrame, dev_window: tuple | None = None) -> DataFrame:
    """Yellow raw -> common schema (plain casts, no safe cast)."""
    c = lambda n: _first_present(df, n)
    out = df.where(c("vendorid").isNotNull()).select(
        cast_int(c("vendorid")).alias("vendor_id"),
        cast_int(c("ratecodeid")).alias("rate_code_id"),
        cast_int(c("pulocationid")).alias("pickup_location_id"),
        cast_int(c("dolocationid")).alias("dropoff_location_id"),
        c("tpep_pickup_datetime").alias("pickup_datetime"),
        c("tpep_dropoff_datetime").alias("dropoff_datetime"),
        c("store_and_fwd_flag").cast("string").alias("store_and_fwd_flag"),
        cast_int(c("passenger_count")).alias("passenger_count"),
        numeric(c("trip_distance")).alias("trip_distance"),
        numeric(c("fare_amount")).alias("fare_amount"),
        numeric(c("extra")).alias("extra"),
        numeric(c("mta_tax")).alias("mta_tax"),
        numeric(c("tip_amount")).alias("tip_amount"),
        numeric(c("tolls_amount")).alias("tolls_amount"),
        numeric(c("improvement_surcharge")).alias("improvement_surcharge"),
        numeric(c("total_amount")).alias("total_amount"),
        cast_int(c("payment_type")).alias("payment_type"),
    )
    return sample_window(out, dev_window)


def stage_fhv(df: DataFrame) -> DataFrame:
    """For-hire raw -> staged; keeps rows with a dispatching base (PRJ-3)."""
    c = lambda n: _first_present(df, n)
    return df.where(c("dispatching_base_num").isNotNull()).select(
        c("dispatching_base_num").cast("string").alias("dispatching_base_num"),
        c("affiliated_base_number").cast("string").alias("affiliated_base_number"),
        c("pickup_datetime").alias("pickup_datetime"),
        c("dropoff_datetime").alias("dropoff_datetime"),
        cast_int(c("pulocationid")).alias("pickup_location_id"),
        cast_int(c("dolocationid")).alias("dropoff_location_id"),
        cast_int(c("sr_flag")).alias("sr_flag"),
    )


def sample_window(df: DataFrame, window: tuple | None, column: str = "pickup_datetime") -> DataFrame:
    """Environment-gated deterministic sample (FLT-9): ``window=(start, end)``
    keeps ``start <= column < end``; ``None`` (production) keeps all rows."""
    if not window:
        return df
    from tripmart.functions.columns import in_window
    like = df.schema[column].dataType
    return df.where(in_window(column, window[0], window[1], like))


# Fixed value: the development sample window of the staging models.
DEV_SAMPLE_WINDOW = ("2019-01-01", "2021-01-01")


def env_window(env: str, window: tuple = DEV_SAMPLE_WINDOW) -> tuple | None:
    """The sample window of an environment (FLT-9): ``'dev'`` samples, any
    other target (production) keeps every row."""
    return window if env == "dev" else None

UNIONED_COLUMNS = [
    "vendor_id", "rate_code_id", "pickup_location_id", "dropoff_location_id",
    "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count",
    "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount",
    "payment_type", "service_type",
]


def union_trips(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """UNION ALL of staged green and yellow (UNI-1, PRJ-4); yellow gets
    ``trip_type = 1`` and ``ehail_fee = 0``; both get a service_type literal."""
    g = green.withColumn("service_type", F.lit("Green"))
    y = (yellow.withColumn("trip_type", F.lit(1).cast("int"))
               .withColumn("ehail_fee", numeric(F.lit(0)))
               .withColumn("service_type", F.lit("Yellow")))
    return g.select(*UNIONED_COLUMNS).unionByName(y.select(*UNIONED_COLUMNS))


# --- deduplication (WIN-1, WIN-2) ------------------------------------------

def _orderable(dt) -> bool:
    if isinstance(dt, MapType):
        return False
    if isinstance(dt, ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                 descending: bool = False, method: str = "window") -> DataFrame:
    """Keep one row per ``keys``: the first by ``order_by`` (ascending, NULLs
    first) or, with ``descending=True``, the last (descending, NULLs last).

    Ties are broken by the remaining columns in schema order, so the result
    is deterministic.

    ``method='window'`` (default) is ``row_number() = 1``: Spark plans a
    partial WindowGroupLimit in every map task before the shuffle, so a key
    holding a third of all rows sends one row per task.  ``method='aggregate'``
    takes ``min``/``max`` of a struct of (order columns, remaining columns)
    per key, which is equally protected by partial aggregation; the two
    measured the same at sf0.1 (6.7 s each for the whole first-trip model).
    """
    keys = list(keys)
    order_by = list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    fields = order_by + rest
    if method == "aggregate" and all(_orderable(df.schema[c].dataType) for c in fields):
        s = F.struct(*[F.col(c) for c in fields])
        agg = F.max(s) if descending else F.min(s)
        out = df.groupBy(*keys).agg(agg.alias("__best"))
        return out.select(*[F.col(c) if c in keys else F.col(f"__best.{c}").alias(c)
                            for c in df.columns])
    ordering = [(F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first())
                for c in fields if _orderable(df.schema[c].dataType)]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


# --- enrichment (JN-2 .. JN-5) ---------------------------------------------

def enrich_payment(trips: DataFrame, lookup: DataFrame, null_code: int | None = 0,
                   code_col: str = "payment_type", lookup_code: str = "payment_type",
                   lookup_name: str = "description", out_name: str = "payment_type_description",
                   unknown: str = "Unknown") -> DataFrame:
    """Left join to a payment lookup.

    ``null_code=0`` (JN-4): the key is ``coalesce(payment_type, 0)`` and the
    coalesced code replaces the column.  ``null_code=None`` (JN-5): raw key.
    A missing match gives ``unknown``.  The lookup is broadcast only behind a
    size check.
    """
    t = trips
    if null_code is not None:
        t = t.withColumn(code_col, F.coalesce(F.col(code_col), F.lit(null_code)))
    lk = lookup.select(F.col(lookup_code).alias("__code"), F.col(lookup_name).alias("__name"))
    j = t.join(lk, t[code_col] == lk["__code"], "left")
    return j.withColumn(out_name, F.coalesce(F.col("__name"), F.lit(unknown))).drop("__code", "__name")


def enrich_zones(trips: DataFrame, zones: DataFrame, how: str = "left",
                 pickup_col: str = "pickup_location_id",
                 dropoff_col: str = "dropoff_location_id") -> DataFrame:
    """Two joins to the same zone dimension, in the pickup and dropoff roles
    (JN-2 inner, JN-3 left).  Adds pickup_/dropoff_ borough and zone."""
    z = zones.select("location_id", "borough", "zone")
    pz = z.select(F.col("location_id").alias("__pz_id"),
                                  F.col("borough").alias("pickup_borough"),
                                  F.col("zone").alias("pickup_zone"))
    dz = z.select(F.col("location_id").alias("__dz_id"),
                                  F.col("borough").alias("dropoff_borough"),
                                  F.col("zone").alias("dropoff_zone"))
    j = trips.join(pz, trips[pickup_col] == pz["__pz_id"], how)
    j = j.join(dz, j[dropoff_col] == dz["__dz_id"], how)
    return j.drop("__pz_id", "__dz_id")


def keep_columns(df: DataFrame, columns: Sequence[str], default: str = "N/A") -> DataFrame:
    """Runtime column list (PRJ-6): present columns as text with missing
    values replaced by ``default``; absent columns filled with ``default``."""
    present = {c.lower(): c for c in df.columns}
    out = []
    for name in columns:
        if name.lower() in present:
            out.append(F.coalesce(F.col(present[name.lower()]).cast("string"), F.lit(default)).alias(name))
        else:
            out.append(F.lit(default).alias(name))
    return df.select(*out)


def keep_record_columns(records: DataFrame, columns: Sequence[str], default: str = "N/A", record: str = "record") -> DataFrame:
    """Runtime column list over VARIANT records (PRJ-6): a present key as text,
    an absent one as ``default``, an explicit null as NULL."""
    def kept(name: str) -> Column:
        quote = '"' if "'" in name else "'"
        if quote in name:
            raise ValueError(f"a path can't name {name}")
        path = f"$[{quote}{name}{quote}]"
        value = F.variant_get(record, path, "variant")
        return F.when(value.isNull(), F.lit(default)).when(~F.is_variant_null(value), F.try_variant_get(record, path, "string")).alias(name)
    return records.select(*[kept(c) for c in columns])


# --- models (Q-10, Q-11) ---------------------------------------------------

DEDUPE_KEYS = ["vendor_id", "pickup_datetime", "pickup_location_id", "service_type"]


def int_trips(unioned: DataFrame, payment_lookup: DataFrame) -> DataFrame:
    """Surrogate key, payment enrichment and first-trip deduplication.

    The deduplication runs *before* the lookup join; the lookup key is unique,
    so the rows are the same and the join sees fewer rows.
    """
    d = dedupe_first(unioned, DEDUPE_KEYS, ["dropoff_datetime"])
    d = d.withColumn("trip_id", surrogate_key(*DEDUPE_KEYS))
    e = enrich_payment(d, payment_lookup, null_code=0)
    return e.select(
        "trip_id", "vendor_id", "service_type", "rate_code_id", "pickup_location_id",
        "dropoff_location_id", "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag",
        "passenger_count", "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax",
        "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount",
        "payment_type", "payment_type_description")


def dim_zones(zone_seed: DataFrame) -> DataFrame:
    """Pass-through rename of the zone seed (PRJ-7)."""
    lower = {c.lower(): c for c in zone_seed.columns}
    return zone_seed.select(
        F.col(lower["locationid"]).cast("int").alias("location_id"),
        F.col(lower["borough"]).alias("borough"),
        F.col(lower["zone"]).alias("zone"),
        F.col(lower["service_zone"]).alias("service_zone"))


FCT_COLUMNS = [
    "trip_id", "vendor_id", "service_type", "rate_code_id", "pickup_location_id",
    "pickup_borough", "pickup_zone", "dropoff_location_id", "dropoff_borough",
    "dropoff_zone", "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag",
    "passenger_count", "trip_distance", "trip_type", "trip_duration_minutes",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
    "improvement_surcharge", "total_amount", "payment_type", "payment_type_description",
]


def fct_trips(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Fact table: zone names in both roles (left joins) and the duration in
    minute boundaries crossed."""
    j = enrich_zones(trips, zones, "left")
    j = j.withColumn("trip_duration_minutes", minutes_between("pickup_datetime", "dropoff_datetime"))
    return j.select(*FCT_COLUMNS)


def dim_vendors(fct: DataFrame) -> DataFrame:
    """Distinct vendors with their names (UNI-4, FN-10)."""
    return fct.select("vendor_id").distinct().select(
        "vendor_id", vendor_name("vendor_id").alias("vendor_name"))
