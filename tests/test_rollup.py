"""The incremental rollup against a full one, replays and interrupted runs included."""

import decimal

import pytest
from pyspark.sql import functions as F

from tripmart.functions.columns import month_start
from tripmart.operators import aggregates, rollup
from tripmart.sinks import tables

D = decimal.Decimal
MEASURES = "fare_amount extra mta_tax tip_amount tolls_amount ehail_fee improvement_surcharge total_amount trip_distance".split()
SCHEMA = "trip_id string, pickup_zone string, service_type string, pickup_datetime string, passenger_count int, v decimal(38,9)"


def trips(spark, rows):
    """Rows (id, zone, day, passengers, money) as a fact frame; some measures are NULL throughout."""
    df = spark.createDataFrame([(i, z, "Green", d, p, None if v is None else D(v)) for i, z, d, p, v in rows], SCHEMA)
    df = df.withColumn("pickup_datetime", F.col("pickup_datetime").cast("timestamp_ntz")).withColumn("pickup_month", month_start("pickup_datetime"))
    return df.select("*", *[(F.lit(None).cast("decimal(38,9)") if m in ("ehail_fee", "extra") else F.col("v")).alias(m) for m in MEASURES]).drop("v")


FIRST = [("a", "x", "2024-01-05", 1, "1.5"), ("b", "x", "2024-01-06", None, "2.25"), ("c", None, "2024-02-01", 2, None), ("z", "y", None, 1, "9")]
SECOND = [("d", "x", "2024-02-02", 3, "4"), ("b", "x", "2024-03-01", 5, "2.25")]           # b moves to another month
THIRD = [("c", None, "2024-04-01", 2, "7"), ("z", "y", "2024-04-02", 1, "9"), ("a", "w", "2024-01-05", 1, "1.000000001")]   # February loses c, the NULL month z


def check(spark, db):
    report = rollup.zone_revenue_report(spark.table(f"{db}.state"))
    want = aggregates.monthly_zone_revenue(spark.table(f"{db}.fact"))
    key = lambda r: str(tuple(r))
    assert sorted(map(key, report.select(*want.columns).collect())) == sorted(map(key, want.collect()))


def add(spark, db, rows, number):
    rollup.add_increment(trips(spark, rows), f"{db}.fact", f"{db}.state", rollup.zone_revenue(), "trip_id", "pickup_month", number)


def test_three_increments_equal_a_rebuild(spark, db):
    for number, rows in enumerate([FIRST, SECOND, THIRD]):
        for _ in range(2):                       # every one is run again
            add(spark, db, rows, number)
            check(spark, db)
    assert {str(r[0]) for r in spark.table(f"{db}.state").select("revenue_month").distinct().collect()} == {
        "2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"}
    add(spark, db, [], 3)
    check(spark, db)


@pytest.mark.parametrize("step", ["merge_upsert", "swap_partitions"])
def test_an_interrupted_increment_is_counted_once(spark, db, monkeypatch, step):
    add(spark, db, FIRST, 0)
    real = getattr(tables, step)

    def dies(*args, **options):
        if step == "merge_upsert":
            real(*args, **options)               # the fact is written, the state not
        raise RuntimeError("lost")
    monkeypatch.setattr(tables, step, dies)
    with pytest.raises(RuntimeError):
        add(spark, db, SECOND, 1)
    monkeypatch.setattr(tables, step, real)
    add(spark, db, SECOND, 1)
    check(spark, db)


def test_only_reached_months_are_written(spark, db):
    add(spark, db, FIRST, 0)
    files = lambda: {r.f: str(r.m) for r in spark.table(f"{db}.state").select(F.input_file_name().alias("f"), F.col("revenue_month").alias("m")).distinct().collect()}
    before = files()
    add(spark, db, [("e", "x", "2024-02-03", 1, "1")], 1)
    after = files()
    assert {m for f, m in before.items() if f in after} == {"2024-01-01", "None"}


def test_doubles_are_refused(spark):
    df = trips(spark, FIRST).withColumn("fare_amount", F.col("fare_amount").cast("double"))
    with pytest.raises(TypeError):
        rollup.zone_revenue().state(df)
