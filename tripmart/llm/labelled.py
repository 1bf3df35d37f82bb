"""Labelled rows: folds and bounded samples shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_of(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a NULL id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(folds)).cast("int")


def usable(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(label_id, label): one row for each id with a label; of several labels the largest."""
    return (labels.select(F.col(id_col).alias("label_id"), F.col(label).cast("int").alias("label")).dropna()
            .groupBy("label_id").agg(F.max("label").alias("label")))


def sample(labels: DataFrame, most: int) -> DataFrame:
    """At most ``most`` labelled ids, chosen by a hash, so that they are small enough to broadcast."""
    return labels.orderBy(F.xxhash64("label_id"), "label_id").limit(most)
