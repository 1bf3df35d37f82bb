"""Work that must not grow with the batches, files or sources of a query."""

import gzip
import json
import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tripmart.plans import gate_loads, gate_sources
from tripmart.session import scratch_dir
from tripmart.sinks import key_index, tables as S
from tripmart.sources import adapter, pages
from tripmart.streaming import ingest


def jobs_of(spark, work):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "test")
    work()
    spark.sparkContext.setJobGroup("other", "test")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_a_tables_layout_is_known_without_a_job(spark, db):
    df = spark.range(5).select("id", F.lit("a").alias("p_x"))
    S.write_replace(df, f"{db}.a", ["p_x"])
    S.write_replace(df, f"{db}.b", bucket_by=(2, ["id", "p_x"]))
    found = {}
    assert jobs_of(spark, lambda: found.update(a=S.partition_columns(spark, f"{db}.a"), b=S.bucket_columns(spark, f"{db}.b"))) == 0
    assert found == {"a": ["p_x"], "b": ["id", "p_x"]}
    assert S.bucket_columns(spark, f"{db}.a") == [] and S.partition_columns(spark, f"{db}.b") == []


def land(landing, numbers, rows=5):
    os.makedirs(landing, exist_ok=True)
    for n in numbers:
        with open(f"{landing}/p{n}.json", "w") as f:
            f.write("\n".join(json.dumps({"id": n * rows + i}) for i in range(rows)))


def test_a_merged_batch_is_one_file(spark, db):
    landing, t = scratch_dir(spark, "t-land").removeprefix("file:"), f"{db}.m"
    schema = spark.createDataFrame([], "id long").schema
    S.ensure_table(spark, t, schema)
    empty = len(spark.table(t).inputFiles())
    land(landing, range(16))
    ingest.merge_stream(ingest.page_stream(spark, landing, schema, 8), t, ["id"], scratch_dir(spark, "t-ckpt"))
    assert len(spark.table(t).inputFiles()) - empty == 2
    assert sorted(r.id for r in spark.table(t).collect()) == list(range(80))


@pytest.mark.parametrize("key,indexed", [("id", False), ("name", False), ("id", True)])
def test_only_batches_with_known_keys_read_the_target(spark, db, monkeypatch, key, indexed):
    landing, ckpt, t = scratch_dir(spark, "t-land").removeprefix("file:"), scratch_dir(spark, "t-ckpt"), f"{db}.k"
    schema = spark.createDataFrame([], "id long").schema
    rows = lambda: ingest.page_stream(spark, landing, schema, 2).select("id", F.concat(F.lit("n"), "id").alias("name"), F.floor(F.col("id") / 10).alias("p"))
    land(landing, range(8))
    S.ensure_table(spark, t, rows().schema, ["p"] if indexed else [])
    if indexed:
        S.build_key_index(spark, t, [key])
    read, real = [], S.anti_join
    monkeypatch.setattr(S, "anti_join", lambda *a: read.append(1) or real(*a))
    ingest.merge_stream(rows(), t, [key], ckpt)
    assert read == [] and sorted(r.id for r in spark.table(t).collect()) == list(range(40))
    # Another run: known keys, then new ones, twice within their batch.
    land(landing, [100, 101, 102, 103])
    for n, ids in ((200, [3, 4, 900]), (201, [900, 901]), (202, [901, 902, None]), (203, [903])):
        with open(f"{landing}/p{n}.json", "w") as f:
            f.write("\n".join(json.dumps({"id": i}) for i in ids))
        os.utime(f"{landing}/p{n}.json", (time.time() + n, time.time() + n))
    ingest.merge_stream(rows(), t, [key], ckpt)
    assert sorted((r.id for r in spark.table(t).collect()), key=str) == sorted([*range(40), *range(500, 520), 900, 900, 901, 902, 903, None], key=str)
    assert 0 < len(read) <= 3 and S.has_key_index(spark, t, [key]) == indexed


def test_seen_keys_are_bounded_and_told_apart(spark, monkeypatch):
    frame = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    seen = key_index.Seen(["id"])
    seen.add(seen.places(frame(-1, 0, 63, 2 ** 62, None)))
    seen.add(seen.places(frame(64, 65, -64)))
    for known in (-64, -1, 0, 63, 64, 65, 2 ** 62):
        assert seen.holds_some(seen.places(frame(1000, known, None)))
    assert not seen.holds_some(seen.places(frame(1, 62, 66, -2, -65, 2 ** 62 + 1, None))) and not seen.holds_some(seen.places(frame()))
    monkeypatch.setattr(key_index, "MOST_WORDS", 2)
    places = seen.places(frame(1000, 2000, 3000))
    assert places is None and seen.holds_some(places)
    seen.add(places)
    assert seen.full and len(seen.words) == 0 and seen.holds_some(seen.places(frame(5)))
    of = lambda kind: spark.createDataFrame([], f"a {kind}, b {kind}").schema
    tells = lambda x, y, *keys: key_index.Seen.can_tell(of(x), of(y), keys)
    assert tells("int", "long", "a") and not tells("int", "long", "a", "b") and not tells("double", "double", "a")
    assert tells("string", "string", "a", "b") and not tells("string", "int", "a")


def test_an_append_is_counted_while_it_passes(spark, db):
    t = f"{db}.c"
    df = spark.range(7).select("id", F.lit(1).alias("p"))
    S.ensure_table(spark, t, df.schema, ["p"])
    assert S.write_append_counted(df, t) == 7
    assert S.write_append_counted(df.where("id > 100"), t) == 0
    assert S.write_append_counted(df.limit(0), t) == 0
    assert spark.table(t).count() == 7


def test_new_keys_of_an_indexed_table_are_not_stored_twice(spark, db, monkeypatch):
    t = f"{db}.i"
    ids = S.materialize(spark.range(500), "ids")
    rows = lambda a, b: ids.where(f"id >= {a} and id < {b}").select("id", F.floor(F.col("id") / 100).alias("p"))
    S.write_replace(rows(0, 300), t, ["p"])
    S.build_key_index(spark, t, ["id"])
    stored = []
    real = S.staged
    monkeypatch.setattr(S, "staged", lambda df, label: stored.append(label) or real(df, label))
    S.merge_insert_new(rows(300, 400), t, ["id"])
    assert stored == [] and S.has_key_index(spark, t, ["id"])
    S.merge_insert_new(rows(250, 500), t, ["id"])
    assert stored == ["new"] and sorted(r.id for r in spark.table(t).collect()) == list(range(500))
    assert spark.table(key_index.name_of(t)).agg(F.sum(F.bitmap_count("map")).alias("n")).first().n == 500


def test_pages_beyond_the_end_are_not_opened(spark):
    root = scratch_dir(spark, "t-far").removeprefix("file:")
    for number, n in {1: 5, 2: 5, 3: 2}.items():
        os.makedirs(f"{root}/page={number}")
        with open(f"{root}/page={number}/a.json", "w") as f:
            f.write("".join(f'{{"id": {i}}}\n' for i in range(n)))
    os.makedirs(f"{root}/page=5000")
    with open(f"{root}/page=5000/a.json.gz", "wb") as f:
        f.write(gzip.compress(b'{"id": 1}\n' * 500)[:30])
    assert pages.last_page(spark, root, 5) == (3, False)


@pytest.mark.parametrize("sizes,want", [({n: 5 for n in range(1, 20)}, (19, True)), ({**{n: 5 for n in range(1, 20)}, 17: 1}, (17, False)),
                                        ({1: 5, 2: 5}, (2, True)), ({n: 5 for n in range(1, 17)}, (16, True))])
def test_the_end_beyond_the_first_look(spark, monkeypatch, sizes, want):
    monkeypatch.setattr(pages, "FIRST_LOOK", 2)
    root = scratch_dir(spark, "t-look").removeprefix("file:")
    os.makedirs(root)
    for number, n in sizes.items():
        with open(f"{root}/page_{number}.json", "w") as f:
            f.write("".join(f'{{"id": {i}}}\n' for i in range(n)))
    assert pages.last_page(spark, root, 5) == want


@pytest.mark.parametrize("name", ["page={}/a.json", "page_{}.json"])
def test_pages_beyond_the_look_are_not_listed(spark, monkeypatch, name):
    monkeypatch.setattr(pages, "FIRST_LOOK", 2)
    root = scratch_dir(spark, "t-list").removeprefix("file:")
    for number in range(1, 401):
        file = f"{root}/{name.format(number)}"
        os.makedirs(os.path.dirname(file), exist_ok=True)
        with open(file, "w") as f:
            f.write("".join(f'{{"id": {number * 10 + i}}}\n' for i in range(2 if number == 3 else 5)))
    listed, real = [], pages._reader
    monkeypatch.setattr(pages, "_reader", lambda s, landing, paths: listed.append(len(paths) if paths != [landing] else 400) or real(s, landing, paths))
    rows, start = pages.read_pages(spark, root, spark.createDataFrame([], "id long").schema, 5)
    assert start == 3 and sorted({r.page for r in rows.collect()}) == [1, 2, 3] and rows.count() == 12
    assert sum(listed) <= 2 + 16 + 3


def test_landed_pages_are_files_of_one_folder(spark):
    root = scratch_dir(spark, "t-landed").removeprefix("file:")
    rows = spark.range(25).select("id", F.lit(None).cast("string").alias("v"), F.when(F.col("id") < 23, F.floor(F.col("id") / 5)).alias("page"))
    pages.land_pages(rows.where("id <> 17"), root)
    pages.land_pages(rows.where("id = 17"), root)
    names = [n for n in os.listdir(root) if not n.startswith(".")]
    assert sorted(n.split("page_")[1] for n in names) == ["0.json", "1.json", "2.json", "3.json", "3.json", "4.json", "none.json"]
    assert sorted((r.id, r.page) for r in spark.read.schema("id long, page long").json(root).collect()) == [(r.id, r.page) for r in rows.collect()]
    read, start = pages.read_pages(spark, root, rows.select("id").schema, 5, 0)
    assert sorted((r.id, r.page) for r in read.collect()) == [(i, i // 5) for i in range(23)] and start == 4


@pytest.mark.parametrize("query", [gate_loads.flow_month_load, gate_sources.header_trip_types])
def test_sources_share_one_join(spark, monkeypatch, query):
    joins, real = [], adapter._joined
    monkeypatch.setattr(adapter, "_joined", lambda *a: joins.append(1) or real(*a))
    query(spark, SF)
    assert len(joins) == 1


def test_a_backfill_reads_stored_trips(spark, monkeypatch):
    plans, real = [], gate_loads._months_around
    monkeypatch.setattr(gate_loads, "_months_around", lambda raw, c: plans.append(raw._jdf.queryExecution().analyzed().toString()) or real(raw, c))
    gate_loads.flow_backfill(spark, SF)
    assert len(plans) == 2 and not any("Join" in p for p in plans)
