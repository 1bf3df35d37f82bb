"""The key index names every partition that holds a batch's key, and few others."""

import pytest
from pyspark.sql import functions as F

from tripmart.sinks import key_index, tables as S


def rows(spark, ids, text=False):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    df = df.select("id", F.concat(F.lit("k"), "id").alias("k"), F.when(F.col("id") < 90_000, F.floor(F.col("id") / 10_000).cast("string")).alias("p"))
    return df


@pytest.mark.parametrize("keys", [["id"], ["k"], ["id", "k"]])
def test_merges_as_without_an_index(spark, db, keys):
    batches = [list(range(0, 100_000, 7)), [7, 8, 8, 15, 50_001, None, -3], [8, 95_000, 95_001, -3, None, -40_000, 2 ** 62]]
    for name, indexed in (("plain", False), ("indexed", True)):
        t = f"{db}.{name}"
        S.ensure_table(spark, t, rows(spark, []).schema, ["p"])
        if indexed:
            S.build_key_index(spark, t, keys)
        for ids in batches:
            S.merge_insert_new(rows(spark, ids), t, keys)
        assert S.has_key_index(spark, t, keys) == indexed
    got = [sorted(spark.table(f"{db}.{n}").select("id", "k", "p").collect(), key=str) for n in ("plain", "indexed")]
    assert got[0] == got[1]


def test_a_batch_reads_only_the_partitions_of_its_keys(spark, db):
    t = f"{db}.t"
    S.write_replace(rows(spark, range(0, 100_000, 3)), t, ["p"])
    S.build_key_index(spark, t, ["id"])
    batch = rows(spark, [30_000, 30_001, 99_999, 5_000_000])
    index = spark.table(key_index.name_of(t))
    assert sorted(S.partition_values(key_index.partitions_with(index, batch, ["id"])), key=str) == ["3", None]
    fresh = S.new_rows(batch, t, ["id"])
    assert sorted(r.id for r in fresh.collect()) == [30_001, 5_000_000]
    read = {p for f in S.rows_of_partitions(spark.table(t), "p", ["3", None]).inputFiles() for p in [f.split("/p=")[1].split("/")[0]]}
    assert read == {"3", "__HIVE_DEFAULT_PARTITION__"}
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((p#" in plan or "PartitionFilters: [(p#" in plan or "PartitionFilters: [p#" in plan


def test_bits_from_a_failed_run_do_no_harm(spark, db, monkeypatch):
    t = f"{db}.t"
    S.write_replace(rows(spark, range(100)), t, ["p"])
    S.build_key_index(spark, t, ["id"])
    real = S._insert

    def dies(*args, **options):
        raise RuntimeError("lost")
    monkeypatch.setattr(S, "_insert", dies)
    with pytest.raises(RuntimeError):
        S.merge_insert_new(rows(spark, [50, 200]), t, ["id"])
    monkeypatch.setattr(S, "_insert", real)
    S.merge_insert_new(rows(spark, [50, 200]), t, ["id"])
    assert sorted(r.id for r in spark.table(t).collect()) == [*range(100), 200]
    bits = spark.table(key_index.name_of(t)).agg(F.sum(F.bitmap_count("map")).alias("n")).first().n
    S.build_key_index(spark, t, ["id"])
    assert (bits, spark.table(key_index.name_of(t)).agg(F.sum(F.bitmap_count("map")).alias("n")).first().n) == (102, 101)


@pytest.mark.parametrize("write", [
    lambda s, t, df: S.write_append(df, t), lambda s, t, df: S.merge_upsert(df, t, ["id"], "p"), lambda s, t, df: S.write_truncate_insert(df, t),
    lambda s, t, df: S.write_replace(df, t, ["p"]), lambda s, t, df: S.write_delete_insert(df, t, ["id"], "p")])
def test_other_writers_drop_the_index(spark, db, write):
    t = f"{db}.t"
    S.write_replace(rows(spark, range(50)), t, ["p"])
    S.build_key_index(spark, t, ["id"])
    write(spark, t, rows(spark, [400, 401]))
    assert not S.has_key_index(spark, t, ["id"])
    before = spark.table(t).count()
    S.merge_insert_new(rows(spark, [400, 401, 402]), t, ["id"])
    assert spark.table(t).count() == before + 1
