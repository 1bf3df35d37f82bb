"""Merges lose nothing: the partition of NULL, NULL keys, zones, file counts, scratch folders."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from tripmart.operators import incremental
from tripmart.plans import loads
from tripmart.session import work_root
from tripmart.sinks import tables as S

ROWS = "id int, v string, p string"


def table(spark, db, rows, name="t"):
    S.write_replace(spark.createDataFrame(rows, ROWS), f"{db}.{name}", ["p"])
    return f"{db}.{name}"


def content(spark, t):
    return sorted(((r.id, r.v, r.p) for r in spark.table(t).collect()), key=str)


def test_upsert_keeps_the_rows_of_the_null_partition(spark, db):
    t = table(spark, db, [(1, "a", "x"), (2, "b", None), (3, "c", None)])
    S.merge_upsert(spark.createDataFrame([(4, "d", None)], ROWS), t, ["id"], "p")
    assert content(spark, t) == [(1, "a", "x"), (2, "b", None), (3, "c", None), (4, "d", None)]


def test_rows_move_out_of_the_null_partition_and_into_it(spark, db):
    t = table(spark, db, [(1, "a", "x"), (2, "b", None)])
    S.merge_upsert(spark.createDataFrame([(2, "B", "y"), (1, "A", None)], ROWS), t, ["id"], "p")
    assert content(spark, t) == [(1, "A", None), (2, "B", "y")]
    S.merge_upsert(spark.createDataFrame([(1, "z", "y")], ROWS), t, ["id"], "p")  # empties the NULL partition
    assert content(spark, t) == [(1, "z", "y"), (2, "B", "y")]
    S.write_delete_insert(spark.createDataFrame([(2, "n", None)], ROWS), t, ["id"], "p")
    assert content(spark, t) == [(1, "z", "y"), (2, "n", None)]


def test_null_keys_are_inserted_not_refused(spark, db):
    t = table(spark, db, [(None, "old", "x"), (1, "a", "x")])
    S.merge_upsert(spark.createDataFrame([(None, "n1", "x"), (None, "n2", "x"), (1, "A", "x")], ROWS), t, ["id"], "p")
    assert content(spark, t) == sorted([(None, "old", "x"), (None, "n1", "x"), (None, "n2", "x"), (1, "A", "x")], key=str)


def test_the_callers_session_setting_stays(spark, db):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    t = table(spark, db, [(1, "a", "x"), (2, "b", "y")])
    S.merge_upsert(spark.createDataFrame([(1, "A", "x")], ROWS), t, ["id"], "p")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static") == before
    assert content(spark, t) == [(1, "A", "x"), (2, "b", "y")]


def test_a_partitioned_write_makes_few_files_per_partition(spark, db):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(0, 4000, 1, 16).selectExpr("cast(id as int) id", "'v' v", "cast(id % 10 as string) p")
        S.write_replace(rows, f"{db}.files", ["p"])
        S.write_append(rows, f"{db}.files", ["p"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.table(f"{db}.files").groupBy("p").agg(F.countDistinct("_metadata.file_path").alias("n")).collect()
    assert len(files) == 10 and all(r.n <= 2 for r in files)


def test_merges_leave_no_scratch_folders(spark, db):
    root = work_root(spark).removeprefix("file:")
    t = table(spark, db, [(1, "a", "x"), (2, "b", None)])
    before = set(os.listdir(root))
    S.merge_upsert(spark.createDataFrame([(1, "A", None)], ROWS), t, ["id"], "p")
    assert set(os.listdir(root)) == before


@pytest.fixture()
def far_zone():
    """The driver's own zone is west of the session's."""
    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    yield
    if old is None:
        del os.environ["TZ"]
    else:
        os.environ["TZ"] = old
    time.tzset()


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_high_water_mark_under_another_driver_zone(spark, db, far_zone, kind):
    hours = ["2024-01-01 09:00:00", "2024-01-01 12:00:00", "2024-01-01 13:00:00", "2024-02-01 00:00:00.000001"]
    rows = spark.createDataFrame([(h,) for h in hours], "h string").select(F.col("h").cast(kind).alias("ts"), F.to_date("h").alias("d"))
    S.write_replace(rows.limit(0).union(rows.where(F.col("ts") <= F.lit(hours[1]).cast(kind))), f"{db}.mark", ["d"])
    new = incremental.incremental_filter(rows, f"{db}.mark", "ts", partition_col="d")
    assert [r.s for r in new.select(F.col("ts").cast("string").alias("s")).orderBy("ts").collect()] == hours[2:]
    again = incremental.incremental_filter(rows, f"{db}.mark", "ts", lookback=dt.timedelta(hours=4))
    assert again.count() == 4


def test_ledger_times_do_not_shift(spark, db, far_zone):
    utc = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)
    loads.record_load(spark, f"{db}.ledger", "a", "loaded", utc)
    loads.record_load(spark, f"{db}.ledger", "b", "loaded", utc.replace(tzinfo=None))
    loads.record_load(spark, f"{db}.ledger", "c", "loaded", utc.astimezone(dt.timezone(dt.timedelta(hours=5))))
    got = spark.table(f"{db}.ledger").select("load_id", F.col("inserted_at").cast("string").alias("at")).collect()
    assert {(r.load_id, r.at) for r in got} == {(x, "2024-01-01 12:00:00") for x in "abc"}
    loads.record_load(spark, f"{db}.ledger", "now", "loaded")
    assert spark.table(f"{db}.ledger").where("load_id = 'now' and abs(unix_micros(inserted_at) - unix_micros(current_timestamp())) < 6e7").count() == 1



def test_a_merge_writes_its_output_once(spark, db, monkeypatch):
    """No stored copy of a plain source, of the touched partitions or of the output."""
    t = table(spark, db, [(i, "a", str(i % 4)) for i in range(40)])
    table(spark, db, [(i, "b", str(i % 2)) for i in range(0, 60, 5)], "src")
    copies = []
    monkeypatch.setattr(S, "staged", lambda df, label: copies.append(label))
    S.merge_upsert(spark.table(f"{db}.src"), t, ["id"], "p")
    want = {**{i: ("a", str(i % 4)) for i in range(40)}, **{i: ("b", str(i % 2)) for i in range(0, 60, 5)}}
    assert content(spark, t) == sorted(((i, *v) for i, v in want.items()), key=str)
    S.write_delete_insert(spark.table(f"{db}.src").where("id > 30"), t, ["id"], "p")
    assert copies == []


def test_untouched_partitions_are_neither_read_nor_written(spark, db):
    t = table(spark, db, [(i, "a", str(i % 4)) for i in range(40)])
    files = lambda: {r.f: r.p for r in spark.table(t).select(F.input_file_name().alias("f"), "p").distinct().collect()}
    before = files()
    S.merge_upsert(spark.createDataFrame([(1, "x", "1"), (100, "y", "3")], ROWS), t, ["id"], "p")
    after = files()
    assert {p for f, p in before.items() if f in after} == {"0", "2"}
    plan = S.rows_of_partitions(spark.table(t), "p", ["1", "it's"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [p#" in plan and "it's" in plan


def test_odd_partition_values_are_emptied(spark, db):
    odd = ["it's", "a\\b", "x=y/z", "ü %"]
    t = table(spark, db, [(i, "a", p) for i, p in enumerate(odd)])
    S.merge_upsert(spark.createDataFrame([(i, "b", "new") for i in range(4)], ROWS), t, ["id"], "p")
    assert content(spark, t) == [(i, "b", "new") for i in range(4)]


def test_an_overwrite_without_a_row(spark, db):
    """The window's only partition is emptied; an empty source touches nothing."""
    rows = spark.createDataFrame([(1, "2024-01-02 10:00:00")], "id int, s string").select(
        "id", F.col("s").cast("timestamp_ntz").alias("ts"), F.to_date("s").alias("d"))
    S.write_replace(rows, f"{db}.w", ["d"])
    S.merge_upsert(rows.where("id = 9"), f"{db}.w", ["id"], "d")
    assert spark.table(f"{db}.w").count() == 1
    S.write_time_interval(rows.where("id = 9"), f"{db}.w", "ts", "2024-01-02", "2024-01-03", "d")
    assert spark.table(f"{db}.w").count() == 0


def test_a_failed_refresh_leaves_the_table(spark, db):
    """A row outside the window or in a partition beyond it fails the write; nothing is replaced."""
    rows = spark.createDataFrame([(1, "2024-01-02 10:00:00"), (2, "2024-01-05 10:00:00")], "id int, s string").select(
        "id", F.col("s").cast("timestamp_ntz").alias("ts"), F.to_date("s").alias("d"))
    S.write_replace(rows, f"{db}.w", ["d"])
    beyond = rows.where("id = 1").withColumn("d", F.lit("2024-01-05").cast("date"))
    for bad in (rows, rows.withColumn("ts", F.lit(None).cast("timestamp_ntz")), beyond):
        with pytest.raises(ValueError):
            S.write_time_interval(bad, f"{db}.w", "ts", "2024-01-02", "2024-01-03", "d")
        assert sorted(r.id for r in spark.table(f"{db}.w").collect()) == [1, 2]


def test_the_writing_session_has_the_callers_settings(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        with S.session_like(spark, **{"spark.sql.sources.partitionOverwriteMode": "dynamic"}) as own:
            assert own.conf.get("spark.sql.shuffle.partitions") == "13"
            assert own.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
