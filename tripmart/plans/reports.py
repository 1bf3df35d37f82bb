"""Ad-hoc analytic reports over a trip table (SURVEY Q-1..Q-4, Q-7, Q-8,
Q-14..Q-16).  Each takes DataFrames and parameters and returns a lazy result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.columns import (
    in_range_inclusive, in_window, is_credit, month_start, normalize_text, on_date,
    pct_where, sum_zero,
)
from tripmart.operators.aggregates import count_rows, in_order, top_by


def short_trips(trips: DataFrame, max_distance=1) -> DataFrame:
    """Trips with ``trip_distance <= max_distance`` (Q-1)."""
    return count_rows(trips, F.col("trip_distance") <= F.lit(max_distance), "short_trips")


def longest_trip_day(trips: DataFrame, below=100) -> DataFrame:
    """Pickup day with the longest trip shorter than ``below`` (Q-2)."""
    g = (trips.where(F.col("trip_distance") < F.lit(below))
              .groupBy(F.to_date("pickup_datetime").alias("pickup_day"))
              .agg(F.max("trip_distance").alias("max_distance")))
    return top_by(g, [F.col("max_distance").desc_nulls_last(), F.col("pickup_day").asc()], 1)


def top_zone_on_day(trips: DataFrame, zones: DataFrame, day) -> DataFrame:
    """Pickup zone *name* with the largest total on ``day`` (Q-3).  Zone ids
    sharing a name are merged, as the reference groups by name."""
    like = trips.schema["pickup_datetime"].dataType
    t = trips.where(on_date("pickup_datetime", day, like))
    z = zones.select("location_id", "zone")
    j = t.join(z, t["pickup_location_id"] == z["location_id"], "inner")
    g = j.groupBy(F.col("zone").alias("pickup_zone")).agg(F.sum("total_amount").alias("total_revenue"))
    return top_by(g, [F.col("total_revenue").desc_nulls_last(), F.col("pickup_zone").asc()], 1)


def top_tip_dropoff_zone(trips: DataFrame, zones: DataFrame, pickup_zone: str, start, end) -> DataFrame:
    """Dropoff zone of the largest tip from ``pickup_zone`` in ``[start, end)``
    (Q-4).  Two inner joins to the zone dimension; NULL tips sort last."""
    like = trips.schema["pickup_datetime"].dataType
    t = trips.where(in_window("pickup_datetime", start, end, like))
    pz = zones.where(F.col("zone") == pickup_zone).select(F.col("location_id").alias("__pz"))
    dz = zones.select(F.col("location_id").alias("__dz"), F.col("zone").alias("dropoff_zone"))
    j = t.join(pz, t["pickup_location_id"] == pz["__pz"], "inner")
    j = j.join(dz, j["dropoff_location_id"] == dz["__dz"], "inner")
    return top_by(j.select("dropoff_zone", "tip_amount"),
                  [F.col("tip_amount").desc_nulls_last(), F.col("dropoff_zone").asc()], 1)


def distinct_in_range(df: DataFrame, value: str, ts: str, start, end, date_col: str | None = None) -> DataFrame:
    """Distinct ``value`` with ``ts`` in the inclusive range (Q-8).  With a
    derived date partition column, the implied date range prunes partitions."""
    like = df.schema[ts].dataType
    pred = in_range_inclusive(ts, start, end, like)
    if date_col is not None:
        from tripmart.functions.columns import ts_literal
        pred = pred & (F.col(date_col) >= ts_literal(start).cast("date")) \
                    & (F.col(date_col) <= ts_literal(end).cast("date"))
    return df.where(pred).select(value).distinct()


def trips_by_month(trips: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    """Trips per month in order, months as DATE; trips without a time are not counted (AGG-5, SRT-4)."""
    months = trips.where(F.col(ts).isNotNull()).groupBy(month_start(ts).alias("month"))
    return in_order(months.agg(F.count(F.lit(1)).alias("trips")), "month")


def payment_mix(trips: DataFrame, col: str = "payment_type", unknown: str = "UNKNOWN") -> DataFrame:
    """Trips per payment category, the most frequent first, NULL counted as ``unknown`` (AGG-6, SRT-4)."""
    cat = F.coalesce(F.col(col).cast("string"), F.lit(unknown))
    mix = trips.groupBy(cat.alias("payment_type")).agg(F.count(F.lit(1)).alias("trips"))
    return in_order(mix, F.desc("trips"), "payment_type")


def distinct_payment_types(trips: DataFrame, col: str = "payment_type") -> DataFrame:
    """The payment types that occur, in order (Q-15)."""
    return in_order(trips.select(F.col(col).cast("string").alias("payment_type")).distinct(), F.col("payment_type").asc_nulls_last())


def date_range(trips: DataFrame, pickup: str = "pickup_datetime", dropoff: str = "dropoff_datetime") -> DataFrame:
    """Row count and the first/last pickup and dropoff (AGG-1, AGG-2)."""
    return trips.agg(F.count(F.lit(1)).alias("total_trips"),
                     F.min(pickup).alias("first_pickup"), F.max(pickup).alias("last_pickup"),
                     F.min(dropoff).alias("first_dropoff"), F.max(dropoff).alias("last_dropoff"))


def latest(trips: DataFrame, ts: str, n: int = 10, tie_breakers: tuple[str | Column, ...] = ()) -> DataFrame:
    """``ORDER BY ts DESC NULLS LAST LIMIT n`` with a total order (SRT-3)."""
    order = [F.col(ts).desc_nulls_last()] + [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in tie_breakers]
    return top_by(trips, order, n)


# --- load ledger metrics (Q-15, Q-16) ------------------------------------

def credit_share(trips: DataFrame, payment: str, tip: str, pickup: str) -> DataFrame:
    """First/last pickup date, credit-card share (%) and total tips (Q-15)."""
    d = F.to_date(pickup)
    return trips.agg(F.min(d).alias("start_date"), F.max(d).alias("end_date"),
                     pct_where(is_credit(payment)).alias("credit_card_pct"),
                     F.round(F.sum(tip), 2).alias("total_tip_amt"))


def normalized_ledger(loads: DataFrame) -> DataFrame:
    return loads.select("load_id", "inserted_at", normalize_text("status").alias("status_v"))


def latest_load(loads: DataFrame, loaded_status: str = "loaded") -> DataFrame:
    """The newest ledger row with status 'loaded', else the newest row of any
    status (SUB-3), as one ordered top-1 instead of a UNION ALL/NOT EXISTS."""
    n = normalized_ledger(loads)
    return top_by(n, [(F.col("status_v") == loaded_status).desc_nulls_last(),
                      F.col("inserted_at").desc_nulls_last(), F.col("load_id").desc()], 1)


def latest_load_metrics(trips: DataFrame, loads: DataFrame, load_col: str, payment: str, tip: str,
                        pickup: str, dropoff: str) -> DataFrame:
    """Metrics of the rows of the latest load (INC-5): date spans, the
    MATCH/DIFFER span flag, credit share and tips.

    The ledger is asked once for its one row; the load id then is a literal,
    which prunes the load's partition or reaches the file reader (JN-6).  The
    result has one row even when the load holds no trips or there is none."""
    newest = latest_load(loads).select("load_id", "status_v").first()
    load_id, status = newest if newest else (None, None)
    pd_, dd = F.to_date(pickup), F.to_date(dropoff)
    agg = trips.where(F.col(load_col) == F.lit(load_id)).agg(
        F.min(pd_).alias("pickup_start_date"), F.max(pd_).alias("pickup_end_date"),
        F.min(dd).alias("dropoff_start_date"), F.max(dd).alias("dropoff_end_date"),
        pct_where(is_credit(payment)).alias("credit_card_pct"),
        F.round(sum_zero(tip), 2).alias("total_tip_amt"))
    same = ((F.col("pickup_start_date") == F.col("dropoff_start_date"))
            & (F.col("pickup_end_date") == F.col("dropoff_end_date")))
    return agg.select(
        F.lit(load_id).cast("string").alias("latest_load_id"), F.lit(status).cast("string").alias("latest_status_normalized"),
        "pickup_start_date", "pickup_end_date", "dropoff_start_date", "dropoff_end_date",
        F.when(same, F.lit("MATCH")).otherwise(F.lit("DIFFER")).alias("date_span_check"),
        "credit_card_pct", "total_tip_amt")


def cumulative_metrics(trips: DataFrame, payment: str, tip: str) -> DataFrame:
    """The same metrics over all loads (Q-16, comparison row)."""
    return trips.agg(pct_where(is_credit(payment)).alias("cumulative_credit_card_pct"),
                     F.round(sum_zero(tip), 2).alias("cumulative_total_tip_amt"))


def recent_loads(loads: DataFrame, n: int = 10) -> DataFrame:
    """Newest ledger rows with the raw status text (SRT-5)."""
    return top_by(loads.select("load_id", "inserted_at", F.col("status").cast("string").alias("status_raw")),
                  [F.col("inserted_at").desc_nulls_last(), F.col("load_id").desc()], n)
