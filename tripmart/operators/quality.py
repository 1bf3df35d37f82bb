"""Data-quality checks (DQ-1 .. DQ-11).

A suite runs every row-level check of one table in a single pass (one
aggregate of conditional counts) and all its uniqueness checks in another (one
shuffle by key); relationship checks are an anti join each.  The result is a DataFrame with one row per
check: (table_name, check_name, column_name, violations, passed).  Nothing is
collected to the driver except by ``custom_value`` and ``freshness``, which
read one value.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, DoubleType, FloatType, StringType, TimestampType


RESULT_SCHEMA = "table_name string, check_name string, column_name string, violations bigint, passed boolean"


@dataclass
class Check:
    kind: str                       # not_null | accepted_values | non_negative | positive |
    columns: tuple[str, ...]        # unique | unique_combination | relationships
    values: tuple = ()
    parent: DataFrame | None = field(default=None, compare=False, repr=False)
    parent_column: str | None = None


def not_null(c: str) -> Check:
    return Check("not_null", (c,))


def unique(c: str) -> Check:
    return Check("unique", (c,))


def accepted_values(c: str, values: Sequence) -> Check:
    return Check("accepted_values", (c,), tuple(values))


def non_negative(c: str) -> Check:
    return Check("non_negative", (c,))


def positive(c: str) -> Check:
    return Check("positive", (c,))


def unique_combination(*cols: str) -> Check:
    return Check("unique_combination_of_columns", tuple(cols))


def relationships(c: str, parent: DataFrame, parent_column: str) -> Check:
    return Check("relationships", (c,), parent=parent, parent_column=parent_column)


KEY_KINDS = ("unique", "unique_combination_of_columns")
ROW_KINDS = ("not_null", "accepted_values", "non_negative", "positive")


def _violation(check: Check) -> Column:
    c = F.col(check.columns[0])
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":           # NULL passes
        return c.isNotNull() & ~c.isin(list(check.values))
    if check.kind == "non_negative":              # NULL passes
        return c < 0
    if check.kind == "positive":
        return c <= 0
    raise ValueError(check.kind)


def _one(table: str, check: Check, violations: DataFrame) -> DataFrame:
    """One result row from a one-row frame holding ``n``."""
    return violations.select(
        F.lit(table).alias("table_name"), F.lit(check.kind).alias("check_name"),
        F.lit(",".join(check.columns)).alias("column_name"),
        F.col("n").cast("bigint").alias("violations"), (F.col("n") == 0).alias("passed"))


def duplicated_groups(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Groups of ``cols`` occurring more than once; rows with a NULL in any
    column are ignored (DQ-2, DQ-5).  Partial aggregation keeps a hot key
    cheap."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    g = df.where(cond).groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    return g.where(F.col("__n") > 1)


def _key_text(df: DataFrame, cols: Sequence[str]) -> Column | None:
    """A text that is equal exactly for equal keys, NULL if a column is; None
    where a column's type has no such text."""
    parts = []
    for c in cols:
        kind = df.schema[c].dataType
        if isinstance(kind, (FloatType, DoubleType)):
            value = (F.col(c) + F.lit(0).cast(kind)).cast("string")       # -0.0 equals 0.0
        elif isinstance(kind, BinaryType):
            value = F.hex(c)
        elif isinstance(kind, TimestampType):
            value = F.unix_micros(c).cast("string")                       # local times repeat when clocks go back
        elif isinstance(kind, AtomicType) and (not isinstance(kind, StringType) or kind == StringType()):
            value = F.col(c).cast("string")
        else:
            return None
        parts += [F.char_length(value).cast("string"), F.lit(":"), value] if len(cols) > 1 else [value]
    return F.concat(*parts)


def duplicate_counts(df: DataFrame, key_sets: Sequence[Sequence[str]]) -> DataFrame:
    """One row of ``d0``, ``d1``, ...: for each key set the number of keys that
    occur more than once (NULLs as in ``duplicated_groups``).  The rows are
    expanded to one for each key set and meet in one shuffle by (set, key)."""
    keys = [F.struct(F.lit(i).alias("set"), _key_text(df, cols).alias("key")) for i, cols in enumerate(key_sets)]
    grouped = (df.select(F.explode(F.array(*keys)).alias("k")).where(F.col("k.key").isNotNull())
               .groupBy("k.set", "k.key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
    return grouped.agg(*[F.count(F.when(F.col("set") == i, 1)).alias(f"d{i}") for i in range(len(key_sets))])


def _rows_of_counts(counts: DataFrame, checks: Sequence[Check], names: Sequence[str], table: str) -> DataFrame:
    """Result rows from one row with a count per check."""
    rows = F.array(*[F.struct(F.lit(c.kind).alias("check_name"), F.lit(",".join(c.columns)).alias("column_name"),
                              F.col(n).alias("violations")) for c, n in zip(checks, names)])
    return counts.select(F.explode(rows).alias("r")).select(
        F.lit(table).alias("table_name"), "r.check_name", "r.column_name",
        F.col("r.violations").cast("bigint").alias("violations"), (F.col("r.violations") == 0).alias("passed"))


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key is absent from the parent (DQ-4)."""
    keys = parent.select(F.col(parent_column).alias("__pk")).distinct()
    return df.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("__pk"), "left_anti")


def run_checks(df: DataFrame, checks: Sequence[Check], table: str) -> DataFrame:
    """All checks of one table as a result frame (DQ-11)."""
    spark = df.sparkSession
    parts: list[DataFrame] = []
    row_checks = [c for c in checks if c.kind in ROW_KINDS]
    if row_checks:
        names = [f"v{i}" for i in range(len(row_checks))]
        counts = df.agg(*[F.count(F.when(_violation(c), 1)).alias(n) for c, n in zip(row_checks, names)])
        parts.append(_rows_of_counts(counts, row_checks, names, table))
    key_checks = [c for c in checks if c.kind in KEY_KINDS and _key_text(df, c.columns) is not None]
    if key_checks:
        counts = duplicate_counts(df, [c.columns for c in key_checks])
        parts.append(_rows_of_counts(counts, key_checks, [f"d{i}" for i in range(len(key_checks))], table))
    for c in checks:
        if c.kind in KEY_KINDS:
            if c in key_checks:
                continue
            parts.append(_one(table, c, duplicated_groups(df, c.columns).agg(F.count(F.lit(1)).alias("n"))))
        elif c.kind == "relationships":
            o = orphans(df, c.columns[0], c.parent, c.parent_column)
            parts.append(_one(table, c, o.agg(F.count(F.lit(1)).alias("n"))))
        elif c.kind not in ROW_KINDS:
            raise ValueError(f"unknown check {c.kind}")
    if not parts:
        return spark.createDataFrame([], RESULT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def custom_value(spark: SparkSession, name: str, query: str, expected, table: str = "") -> DataFrame:
    """Custom SQL returning one value, compared with ``expected`` (DQ-8)."""
    q = spark.sql(query)
    first = q.columns[0]
    return q.select(F.lit(table).alias("table_name"), F.lit(name).alias("check_name"),
                    F.lit(None).cast("string").alias("column_name"),
                    F.col(first).cast("bigint").alias("violations"),
                    (F.col(first) == F.lit(expected)).alias("passed"))


def freshness(df: DataFrame, loaded_at: str, now, warn_after_hours: float = 24,
              error_after_hours: float = 48, table: str = "") -> DataFrame:
    """Source freshness (DQ-9): age of ``max(loaded_at)`` at ``now`` (a run
    argument, so reruns agree); 'warn' past ``warn_after_hours``, 'error'
    past ``error_after_hours``."""
    from tripmart.functions.columns import ts_literal
    like = df.schema[loaded_at].dataType
    m = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), ts_literal(now, like)).cast("double") / 3600.0
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
               .when(F.col("age_hours") > error_after_hours, F.lit("error"))
               .when(F.col("age_hours") > warn_after_hours, F.lit("warn"))
               .otherwise(F.lit("pass")))
    return m.select(F.lit(table).alias("table_name"), "max_loaded_at", age.alias("age_hours")) \
            .withColumn("status", status)
