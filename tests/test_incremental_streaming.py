import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tripmart.operators.incremental import build_incremental, incremental_filter
from tripmart.session import scratch_dir
from tripmart.sinks import tables as S
from tripmart.streaming import ingest

D = dt.datetime


def _df(spark, rows):
    return spark.createDataFrame(rows, "id string, ts timestamp_ntz").withColumn("m", F.to_date("ts"))


def test_high_water_mark_strict_and_late_rows(spark, db):
    t = f"{db}.fct"
    build_incremental(_df(spark, [("a", D(2024, 1, 1)), ("b", D(2024, 1, 5))]), t, "id", "ts", "m")
    # late row (before the mark), a row equal to the mark, and a new one
    nxt = _df(spark, [("late", D(2024, 1, 3)), ("eq", D(2024, 1, 5)), ("new", D(2024, 1, 6))])
    assert [r.id for r in incremental_filter(nxt, t, "ts").collect()] == ["new"]
    build_incremental(nxt, t, "id", "ts", "m")
    assert sorted(r.id for r in spark.table(t).collect()) == ["a", "b", "new"]


def test_empty_existing_target(spark, db):
    t = f"{db}.fct0"
    S.ensure_table(spark, t, _df(spark, []).schema, ["m"])
    src = _df(spark, [("a", D(2024, 1, 1))])
    assert incremental_filter(src, t, "ts").count() == 0
    assert incremental_filter(src, t, "ts", on_empty="all").count() == 1
    assert incremental_filter(src, f"{db}.absent", "ts").count() == 1


def _land(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))


def test_stream_ledger_exactly_once(spark, db):
    landing, ckpt = scratch_dir(spark, "t-land"), scratch_dir(spark, "t-ckpt")
    _land(landing, "page1.json", [{"id": i, "rate_code": 1} for i in range(3)])
    _land(landing, "page2.json", [{"id": 10, "rate_code": 2}])  # a short last page
    _land(landing, "page3.json", [])                             # an empty page
    schema = ingest.schema_with_hints(spark.createDataFrame([], "id long, rate_code long").schema,
                                      {"rate_code": spark.createDataFrame([], "x string").schema["x"].dataType})
    for _ in range(2):
        ingest.append_with_ledger(ingest.page_stream(spark, landing, schema, 1), f"{db}.rows", f"{db}.loads", ckpt)
    assert spark.table(f"{db}.rows").count() == 4
    loads = spark.table(f"{db}.loads").collect()
    assert len(loads) == 2 and sum(r.row_count for r in loads) == 4
    assert dict(spark.table(f"{db}.rows").dtypes)["rate_code"] == "string"


def test_stream_merge_redelivery(spark, db):
    landing, ckpt = scratch_dir(spark, "t-land2"), scratch_dir(spark, "t-ckpt2")
    t = f"{db}.m"
    S.ensure_table(spark, t, spark.createDataFrame([], "id long, v string").schema)
    schema = spark.table(t).schema
    _land(landing, "p1.json", [{"id": 1, "v": "a"}, {"id": 2, "v": "b"}])
    ingest.merge_stream(ingest.page_stream(spark, landing, schema), t, ["id"], ckpt)
    _land(landing, "p2.json", [{"id": 2, "v": "b2"}, {"id": 3, "v": "c"}])
    ingest.merge_stream(ingest.page_stream(spark, landing, schema), t, ["id"], ckpt)
    assert sorted(tuple(r) for r in spark.table(t).collect()) == [(1, "a"), (2, "b"), (3, "c")]
