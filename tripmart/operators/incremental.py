"""Incremental processing: high-water mark filter and the incremental fact
build (INC-1, SUB-2, SNK-8, SNK-12)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tripmart.sinks import tables


def high_water_mark(df: DataFrame, key: str, partition_col: str | None = None) -> Column | None:
    """``max(key)`` as a literal of the key's type; None for a table without a key.

    A timestamp never becomes a Python value, which would shift it by the
    driver's zone: it travels as microseconds since the epoch, a zone-less one
    as text.  With ``partition_col``, whose values grow with the key, only the
    newest partition is read (all, if that one has no key).
    """
    kind = df.schema[key].dataType
    top = F.max(key)
    carried = (F.unix_micros(top) if isinstance(kind, TimestampType)
               else top.cast("string") if isinstance(kind, TimestampNTZType) else top)
    parts = [df]
    if partition_col is not None:
        newest = df.agg(F.max(partition_col).alias("newest"))
        parts = [df.join(newest, df[partition_col] == newest["newest"], "left_semi"), df]
    for rows in parts:
        value = rows.agg(carried.alias("mark")).first()["mark"]
        if value is not None:
            mark = F.lit(value)
            return F.timestamp_micros(mark) if isinstance(kind, TimestampType) else mark.cast(kind)
    return None


def incremental_filter(df: DataFrame, target: str, key: str, on_empty: str = "reference",
                       lookback: _dt.timedelta | None = None, partition_col: str | None = None,
                       partition_of=None) -> DataFrame:
    """Rows of ``df`` newer than the target's high-water mark (strict ``>``).

    Target absent: all rows (first build).  Target present but empty: the
    reference's scalar subquery is NULL and nothing passes
    (``on_empty='reference'``); ``on_empty='all'`` passes everything.  The
    mark is applied as a literal, so it reaches the Parquet reader; with
    ``partition_col`` the implied partition bound is added for pruning.
    ``lookback`` re-admits rows up to that much older than the mark (late data
    then needs an upsert, which the fact build does)."""
    spark = df.sparkSession
    if not tables.table_exists(spark, target):
        return df
    stored = spark.table(target)
    mark = high_water_mark(stored, key, partition_col if partition_col in stored.columns else None)
    if mark is None:
        return df if on_empty == "all" else df.where(F.lit(False))
    if lookback is not None:
        mark = mark - F.lit(lookback)
    pred = F.col(key) > mark
    if partition_col is not None and partition_col in df.columns:
        pred = pred & (F.col(partition_col) >= (partition_of or F.to_date)(mark))
    return df.where(pred)


def build_incremental(df: DataFrame, target: str, unique_key: str, key: str, partition_col: str,
                      partition_of=None, on_empty: str = "reference") -> None:
    """Incremental table (the fact's materialisation): first run writes the
    table partitioned by ``partition_col``; later runs upsert the rows past
    the high-water mark on ``unique_key``, appending new columns first."""
    spark = df.sparkSession
    if not tables.table_exists(spark, target):
        tables.write_replace(df, target, [partition_col])
        return
    new = incremental_filter(df, target, key, on_empty, partition_col=partition_col, partition_of=partition_of)
    have = set(spark.table(target).columns)
    added = [f for f in df.schema.fields if f.name not in have]
    if added:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({cols})")
        spark.catalog.refreshTable(target)
    tables.merge_upsert(new, target, [unique_key], partition_col)
