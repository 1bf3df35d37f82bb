"""Aggregations of the marts and reports (AGG-*).

Every aggregate here is decomposable (sum / count / min / max), so Spark runs
a partial aggregation in each map task and shuffles one row per group per
task: a group holding a third of all rows costs no more shuffle than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.functions.columns import month_start


def _avg(c: str) -> Column:
    """Average as DOUBLE: ``CAST(SUM(c) AS DOUBLE) / COUNT(c)`` (NULL on an
    all-null group).  Summing the exact value first keeps the result
    independent of row order."""
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


REVENUE_SUMS = [
    ("fare_amount", "revenue_monthly_fare"),
    ("extra", "revenue_monthly_extra"),
    ("mta_tax", "revenue_monthly_mta_tax"),
    ("tip_amount", "revenue_monthly_tip_amount"),
    ("tolls_amount", "revenue_monthly_tolls_amount"),
    ("ehail_fee", "revenue_monthly_ehail_fee"),
    ("improvement_surcharge", "revenue_monthly_improvement_surcharge"),
    ("total_amount", "revenue_monthly_total_amount"),
]


def monthly_zone_revenue(fct: DataFrame, unknown_zone: str = "Unknown Zone") -> DataFrame:
    """Monthly revenue by pickup zone and service (AGG-7, FN-12).

    Groups on the coalesced zone expression (not on the raw column), months
    as DATE.  Sums keep the NUMERIC type; averages are DOUBLE.
    """
    zone = F.coalesce(F.col("pickup_zone"), F.lit(unknown_zone))
    g = fct.groupBy(zone.alias("pickup_zone"), month_start("pickup_datetime").alias("revenue_month"),
                    F.col("service_type"))
    aggs = [F.sum(src).alias(dst) for src, dst in REVENUE_SUMS]
    aggs += [F.count("trip_id").alias("total_monthly_trips"),
             _avg("passenger_count").alias("avg_monthly_passenger_count"),
             _avg("trip_distance").alias("avg_monthly_trip_distance")]
    return g.agg(*aggs)


def _avg_exact(c: str) -> Column:
    """Average of a DOUBLE column summed exactly in DECIMAL(38,6)."""
    return F.try_divide(F.sum(F.col(c).cast("decimal(38,6)")).cast("double"), F.count(c).cast("double"))


def daily_report(staged: DataFrame) -> DataFrame:
    """Daily report by (date, payment name): COUNT, SUM, 3 averages (AGG-8).
    Money is summed as DECIMAL(18,2), so totals do not depend on the order in
    which partial sums meet.  The caller restricts ``staged`` to the window
    (see ``in_date_window``)."""
    return staged.groupBy(F.to_date("pickup_datetime").alias("report_date"), "payment_type_name").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("total_revenue"),
        _avg_exact("fare_amount").alias("avg_fare"),
        _avg_exact("trip_distance").alias("avg_trip_distance"),
        _avg_exact("passenger_count").alias("avg_passenger_count"),
    )


def count_rows(df: DataFrame, pred: Column | None = None, name: str = "n") -> DataFrame:
    """Global ``COUNT(*)``, optionally filtered (AGG-1).  Parquet answers an
    unfiltered count from footers; a filter is pushed to the reader."""
    if pred is not None:
        df = df.where(pred)
    return df.agg(F.count(F.lit(1)).alias(name))


def duplicate_keys(df: DataFrame, keys: Sequence[str], skip_null_keys: bool = True) -> DataFrame:
    """Keys that occur more than once (AGG-13), with their count."""
    if skip_null_keys:
        cond = None
        for k in keys:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        df = df.where(cond)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def top_by(df: DataFrame, order: Sequence[Column], n: int = 1) -> DataFrame:
    """Top-n rows by a total order (SRT-*): ``orderBy(...).limit(n)`` becomes
    TakeOrderedAndProject, a per-task top-n followed by a merge of n rows per
    task; the full input is never sorted."""
    return df.orderBy(*order).limit(n)


def in_order(df: DataFrame, *order) -> DataFrame:
    """A small result (one row per group of a report) in full order, with the
    place of each row as ``position`` (SRT-4)."""
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    return df.withColumn("position", F.row_number().over(Window.orderBy(*keys))).orderBy("position")
