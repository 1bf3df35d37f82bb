"""A stored rollup of sums and counts, kept up to date by increments (AGG-7 with INC-1).

The rollup's state holds, for every group, the exact sum and the number of
non-NULL values of each measure and the number of rows: all of them can be
added and taken back.  An increment of the fact table changes it by
``state(new rows) - state(the rows they replace)``, so only the replaced rows
and the state's partitions that the change reaches are read, and only these
partitions are written.  A row that moves to another month is taken from its old
one and added to the new one.

An increment has a number.  Its change is stored before the fact table is
touched, and each partition of the state keeps the number of its last
increment; so an increment that failed anywhere can be run again and is counted
once.  Numbers must rise; one writer at a time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from tripmart.functions.columns import month_start
from tripmart.operators.aggregates import REVENUE_SUMS
from tripmart.operators.joins import semi_join
from tripmart.session import work_root
from tripmart.sinks import tables

#: The type of stored sums.
EXACT = DecimalType(38, 9)


@dataclass(frozen=True)
class Rollup:
    """Groups (name -> expression over the fact's rows), of which ``partition``
    partitions the state, measures to sum, and a column whose values are counted."""

    keys: Mapping[str, Column]
    partition: str
    measures: Sequence[str]
    counted: str

    def state(self, rows: DataFrame, sign: int = 1) -> DataFrame:
        """The rows' state, or what taking them away adds."""
        wrong = [m for m in self.measures if not isinstance(rows.schema[m].dataType, (DecimalType, IntegralType))]
        if wrong:
            raise TypeError(f"sums of these can't be taken back exactly: {wrong}")
        value = lambda m: F.col(m).cast(EXACT) if sign > 0 else -F.col(m).cast(EXACT)
        sums = [x for m in self.measures for x in (F.sum(value(m)).cast(EXACT).alias(f"sum_{m}"), (F.count(m) * sign).alias(f"n_{m}"))]
        return rows.groupBy(*[c.alias(k) for k, c in self.keys.items()]).agg(
            *sums, (F.count(self.counted) * sign).alias("n_counted"), (F.count(F.lit(1)) * sign).alias("n_rows"))

    def added(self, states: DataFrame) -> DataFrame:
        """Several states as one; groups without a row are gone."""
        columns = [c for m in self.measures for c in (f"sum_{m}", f"n_{m}")] + ["n_counted", "n_rows"]
        total = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0))) if c.startswith("sum_") else F.sum(c)
        return states.groupBy(*self.keys).agg(*[total(c).cast(states.schema[c].dataType).alias(c) for c in columns])


def zone_revenue(unknown_zone: str = "Unknown Zone") -> Rollup:
    """The monthly revenue by zone and service as a rollup."""
    return Rollup({"pickup_zone": F.coalesce(F.col("pickup_zone"), F.lit(unknown_zone)), "revenue_month": month_start("pickup_datetime"),
                   "service_type": F.col("service_type")},
                  "revenue_month", (*[m for m, _ in REVENUE_SUMS], "passenger_count", "trip_distance"), "trip_id")


def zone_revenue_report(state: DataFrame) -> DataFrame:
    """The mart's columns from a stored ``zone_revenue`` state."""
    total = lambda m: F.when(F.col(f"n_{m}") > 0, F.col(f"sum_{m}"))
    mean = lambda m: F.try_divide(total(m).cast("double"), F.col(f"n_{m}").cast("double"))
    return state.select("pickup_zone", "revenue_month", "service_type", *[total(m).alias(name) for m, name in REVENUE_SUMS],
                        F.col("n_counted").alias("total_monthly_trips"), mean("passenger_count").alias("avg_monthly_passenger_count"),
                        mean("trip_distance").alias("avg_monthly_trip_distance"))


def _stored_once(spark: SparkSession, path: str, change) -> DataFrame:
    """The frame that ``change()`` gives, stored under ``path``; a complete store is read, not made again."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    done = hadoop.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        change().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _forget(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def add_increment(new: DataFrame, fact: str, state: str, rollup: Rollup, unique_key: str, fact_partition: str, number: int) -> None:
    """Upsert ``new`` (one row for a key, none NULL) into the fact table and
    bring the rollup's state up to date.  Tables that are absent are made."""
    spark = new.sparkSession
    changes = f"{work_root(spark)}/changes/{state}"

    def change() -> DataFrame:
        parts = rollup.state(new)
        if tables.table_exists(spark, fact):
            stored = spark.table(fact)
            old = semi_join(stored, new, [unique_key])
            parts = parts.unionByName(rollup.state(old, -1))
        return rollup.added(parts)
    delta = _stored_once(spark, f"{changes}/{number}", change)

    if not tables.table_exists(spark, fact):
        tables.write_replace(new, fact, [fact_partition])
    else:
        tables.merge_upsert(new, fact, [unique_key], fact_partition)

    marked = lambda rows: rollup.added(rows).where(F.col("n_rows") > 0).withColumn("increment", F.lit(number).cast("long"))
    part = rollup.partition
    if not tables.table_exists(spark, state):
        tables.write_replace(marked(delta), state, [part])
    else:
        stored = spark.table(state)
        done = set(tables.partition_values(stored.where(F.col("increment") >= number).select(part)))
        due = [v for v in tables.partition_values(delta.select(part)) if v not in done]
        if due:
            before = tables.rows_of_partitions(stored, part, due).drop("increment")
            after = marked(before.unionByName(tables.rows_of_partitions(delta, part, due)))
            tables.swap_partitions(after.select(*stored.columns), state, part, due)
    # Changes of earlier increments are in the state for good.
    _forget(spark, f"{changes}/{number - 1}")
