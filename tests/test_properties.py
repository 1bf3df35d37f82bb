"""Property tests: merge twice = once, interval refresh =
filter-out ∪ insert, dedupe key unique and equal to a brute-force pick."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.operators.transforms import dedupe_first
from tripmart.session import scratch_database
from tripmart.sinks import tables as S

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
rows_kv = st.lists(st.tuples(st.sampled_from("abcdef"), st.integers(0, 3)), min_size=0, max_size=12)


@SETTINGS
@given(first=rows_kv, second=rows_kv)
def test_merge_twice_equals_once(spark, first, second):
    db = scratch_database(spark, "prop")
    t = f"{db}.t"
    schema = "k string, v int"
    S.ensure_table(spark, t, spark.createDataFrame([], schema).schema)
    a, b = spark.createDataFrame(first, schema), spark.createDataFrame(second, schema)
    S.merge_insert_new(a, t, ["k"])
    S.merge_insert_new(b, t, ["k"])
    once = sorted(tuple(r) for r in spark.table(t).collect())
    S.merge_insert_new(b, t, ["k"])
    assert sorted(tuple(r) for r in spark.table(t).collect()) == once
    keys_a = {k for k, _ in first}
    expect = sorted(first + [r for r in second if r[0] not in keys_a])
    assert once == expect


hours = st.lists(st.integers(0, 95), min_size=1, max_size=15)


@SETTINGS
@given(old=hours, new=hours, start=st.integers(0, 80), span=st.integers(1, 40))
def test_interval_refresh_is_filter_out_union_insert(spark, old, new, start, span):
    base = dt.datetime(2024, 1, 1)
    s, e = base + dt.timedelta(hours=start), base + dt.timedelta(hours=start + span)
    db = scratch_database(spark, "prop")
    t = f"{db}.ev"
    mk = lambda hs, tag: spark.createDataFrame(
        [(f"{tag}{i}", base + dt.timedelta(hours=h)) for i, h in enumerate(hs)], "id string, ts timestamp_ntz"
    ).withColumn("d", F.to_date("ts"))
    S.write_replace(mk(old, "o"), t, ["d"])
    fresh = mk(new, "n").where((F.col("ts") >= F.lit(s)) & (F.col("ts") < F.lit(e)))
    S.write_time_interval(fresh, t, "ts", s, e, "d")
    got = sorted(r.id for r in spark.table(t).collect())
    kept = [f"o{i}" for i, h in enumerate(old) if not (s <= base + dt.timedelta(hours=h) < e)]
    ins = [f"n{i}" for i, h in enumerate(new) if s <= base + dt.timedelta(hours=h) < e]
    assert got == sorted(kept + ins)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 9)),
                     min_size=1, max_size=25),
       descending=st.booleans())
def test_dedupe_matches_brute_force(spark, rows, descending):
    df = spark.createDataFrame(rows, "k int, o int, v int")
    for method in ("window", "aggregate"):
        got = sorted(tuple(r) for r in dedupe_first(df, ["k"], ["o"], descending, method).collect())
        want = []
        for k in sorted({r[0] for r in rows}):
            grp = [r for r in rows if r[0] == k]
            # ascending NULLs first / descending NULLs last, ties by remaining column
            key = lambda r: (r[1] is not None, r[1] if r[1] is not None else 0, r[2])
            want.append(max(grp, key=key) if descending else min(grp, key=key))
        assert got == sorted(want)


@SETTINGS
@given(target=st.dictionaries(st.integers(0, 9), st.tuples(st.integers(0, 3), st.integers(0, 99)), max_size=8),
       batch=st.dictionaries(st.integers(0, 12), st.tuples(st.integers(0, 3), st.integers(0, 99)), max_size=6))
def test_upsert_is_replace_by_key(spark, target, batch):
    db = scratch_database(spark, "prop")
    t = f"{db}.u"
    schema = "id int, v int, p int"
    rows = lambda d: [(k, v, p) for k, (p, v) in d.items()]
    S.write_replace(spark.createDataFrame(rows(target), schema), t, ["p"])
    S.merge_upsert(spark.createDataFrame(rows(batch), schema), t, ["id"], "p")
    got = sorted(tuple(r) for r in spark.table(t).select("id", "v", "p").collect())
    want = sorted(rows({**target, **batch}))
    assert got == want
