import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripmart.sinks import tables as S

D = dt.datetime


def test_merge_insert_new_idempotent_and_keeps_batch_dups(spark, db):
    t = f"{db}.loaded"
    S.ensure_table(spark, t, spark.createDataFrame([], "k string, v int").schema)
    b1 = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    b2 = spark.createDataFrame([("b", 20), ("c", 3), ("c", 3)], "k string, v int")
    S.merge_insert_new(b1, t, ["k"])
    S.merge_insert_new(b2, t, ["k"])
    once = sorted(tuple(r) for r in spark.table(t).collect())
    S.merge_insert_new(b2, t, ["k"])
    S.merge_insert_new(b1, t, ["k"])
    assert sorted(tuple(r) for r in spark.table(t).collect()) == once
    assert once == [("a", 1), ("b", 2), ("c", 3), ("c", 3)]


def test_merge_insert_dedupe_source_option(spark, db):
    t = f"{db}.loaded2"
    S.ensure_table(spark, t, spark.createDataFrame([], "k string, v int").schema)
    S.merge_insert_new(spark.createDataFrame([("c", 3), ("c", 3)], "k string, v int"), t, ["k"], dedupe_source=True)
    assert spark.table(t).count() == 1


def _orders(spark):
    return spark.createDataFrame(
        [(1, 10.0, dt.date(2024, 1, 1)), (2, 20.0, dt.date(2024, 1, 2)), (3, 30.0, dt.date(2024, 1, 3))],
        "id int, amount double, d date")


def test_upsert_replaces_and_moves_partition(spark, db):
    t = f"{db}.fact"
    S.write_replace(_orders(spark), t, ["d"])
    src = spark.createDataFrame([(2, 21.0, dt.date(2024, 1, 3)), (4, 40.0, dt.date(2024, 1, 4))],
                                "id int, amount double, d date")
    S.merge_upsert(src, t, ["id"], "d")
    got = sorted(tuple(r) for r in spark.table(t).select("id", "amount", "d").collect())
    assert got == [(1, 10.0, dt.date(2024, 1, 1)), (2, 21.0, dt.date(2024, 1, 3)),
                   (3, 30.0, dt.date(2024, 1, 3)), (4, 40.0, dt.date(2024, 1, 4))]
    # the emptied partition of the moved row is gone
    assert [r[0] for r in spark.sql(f"show partitions {t}").collect()].count("d=2024-01-02") == 0
    S.merge_upsert(src, t, ["id"], "d")  # re-run: same table
    assert sorted(tuple(r) for r in spark.table(t).select("id", "amount", "d").collect()) == got


def test_upsert_rejects_duplicate_source_keys(spark, db):
    t = f"{db}.fact2"
    S.write_replace(_orders(spark), t, ["d"])
    src = spark.createDataFrame([(2, 1.0, dt.date(2024, 1, 2)), (2, 2.0, dt.date(2024, 1, 2))],
                                "id int, amount double, d date")
    with pytest.raises(S.MergeKeyError):
        S.merge_upsert(src, t, ["id"], "d")


def test_delete_insert_by_non_unique_key(spark, db):
    t = f"{db}.fact3"
    df = spark.createDataFrame([(1, "x", dt.date(2024, 1, 1)), (2, "x", dt.date(2024, 1, 2)),
                                (3, "y", dt.date(2024, 1, 2))], "id int, cust string, d date")
    S.write_replace(df, t, ["d"])
    src = spark.createDataFrame([(9, "x", dt.date(2024, 1, 5))], "id int, cust string, d date")
    S.write_delete_insert(src, t, ["cust"], "d")
    assert sorted(r.id for r in spark.table(t).collect()) == [3, 9]


def test_time_interval_edges_and_emptied_day(spark, db):
    t = f"{db}.events"
    rows = [(1, D(2024, 1, 1, 23)), (2, D(2024, 1, 2, 0)), (3, D(2024, 1, 2, 12)), (4, D(2024, 1, 3, 0)),
            (5, D(2024, 1, 3, 6))]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz").withColumn("d", F.to_date("ts"))
    S.write_replace(df, t, ["d"])
    # window [2024-01-02 00:00, 2024-01-03 00:00): start inclusive, end exclusive
    new = spark.createDataFrame([(30, D(2024, 1, 2, 12))], "id int, ts timestamp_ntz").withColumn("d", F.to_date("ts"))
    S.write_time_interval(new, t, "ts", "2024-01-02", "2024-01-03", "d")
    assert sorted(r.id for r in spark.table(t).collect()) == [1, 4, 5, 30]
    # a refresh with no rows empties the day
    empty = new.where("false")
    S.write_time_interval(empty, t, "ts", "2024-01-02", "2024-01-03", "d")
    assert sorted(r.id for r in spark.table(t).collect()) == [1, 4, 5]
    with pytest.raises(ValueError):
        S.write_time_interval(df, t, "ts", "2024-01-02", "2024-01-03", "d")


def test_truncate_insert_and_create_like(spark, db):
    t = f"{db}.n"
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    S.write_replace(df.union(df), t)
    S.write_truncate_insert(df, t)
    assert spark.table(t).count() == 1
    S.create_like(df, f"{db}.n_like")
    assert spark.table(f"{db}.n_like").count() == 0 and spark.table(f"{db}.n_like").columns == ["k", "v"]


def test_append_twice_duplicates(spark, db):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    S.write_append(df, f"{db}.a")
    S.write_append(df, f"{db}.a")
    assert spark.table(f"{db}.a").count() == 2


def test_conform_and_evolve(spark, db):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    want = StructType([StructField("k", IntegerType()), StructField("v", StringType())])
    ok = spark.createDataFrame([(1, "a")], want)
    assert S.conform(ok, want) is ok
    bad = spark.createDataFrame([("a", 1)], "v string, k long")
    with pytest.raises(S.ContractError):
        S.conform(bad, want)
    assert S.conform(bad, want, strict=False).schema == want
    t = f"{db}.evo"
    S.evolve_append(ok, t)
    S.evolve_append(spark.createDataFrame([(2, "b", 3.5)], "k int, v string, extra double"), t)
    S.evolve_append(spark.createDataFrame([(3,)], "k int"), t)
    got = sorted(tuple(r) for r in spark.table(t).collect())
    assert got == [(1, "a", None), (2, "b", 3.5), (3, None, None)]


def test_clustered_layout_prunes(spark, db):
    df = spark.createDataFrame([(i % 3, D(2024, 1, 1 + i % 5, 1)) for i in range(50)], "vendor int, ts timestamp_ntz")
    S.write_clustered(df, f"{db}.c", "ts", ["vendor"], "ts_date")
    q = spark.table(f"{db}.c").where("ts_date = date'2024-01-02'")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ts_date" in plan
    assert q.count() == 10


def test_bucketed_target_merge_shuffles_only_the_batch(spark, db, monkeypatch):
    from tripmart.operators import joins
    monkeypatch.setattr(joins, "BROADCAST_LIMIT_BYTES", -1)
    monkeypatch.setattr(S, "is_bounded", lambda df, limit_bytes=-1: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = f"{db}.bkt"
        S.ensure_table(spark, t, spark.createDataFrame([], "k string, v long").schema, bucket_by=(8, ["k"]))
        S.merge_insert_new(spark.range(100).selectExpr("cast(id as string) k", "id v"), t, ["k"])
        src = spark.range(50, 150).selectExpr("cast(id as string) k", "id v")
        new = S.new_rows(src, t, ["k"])
        new.count()
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        S.merge_insert_new(src, t, ["k"])
        assert spark.table(t).count() == 150
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_merge_null_key_never_matches(spark, db):
    """As with MERGE ... ON s.k = t.k, a NULL key matches nothing: the row is
    inserted by every run (row ids are md5 values, so never NULL in the flows)."""
    t = f"{db}.nk"
    S.ensure_table(spark, t, spark.createDataFrame([], "k string, v int").schema)
    b = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    S.merge_insert_new(b, t, ["k"])
    S.merge_insert_new(b, t, ["k"])
    got = sorted((r.k or "", r.v) for r in spark.table(t).collect())
    assert got == [("", 1), ("", 1), ("a", 2)]
