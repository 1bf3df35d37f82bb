import datetime as dt

from tripmart.operators import transforms as T
from tripmart.sources import seeds

D = dt.datetime


def test_dedupe_first_ties_and_nulls(spark):
    rows = [(1, "a", D(2024, 1, 1, 0, 5), 10), (1, "a", None, 11), (1, "a", D(2024, 1, 1, 0, 1), 12),
            (2, "b", D(2024, 1, 1), 5), (2, "b", D(2024, 1, 1), 4), (None, "c", D(2024, 1, 1), 1)]
    df = spark.createDataFrame(rows, "k int, s string, d timestamp_ntz, v int")
    for method in ("aggregate", "window"):
        out = {(r.k, r.s): (r.d, r.v) for r in T.dedupe_first(df, ["k", "s"], ["d"], method=method).collect()}
        assert out[(1, "a")] == (None, 11)          # ascending, NULLs first
        assert out[(2, "b")] == (D(2024, 1, 1), 4)  # tie broken by remaining columns
        assert (None, "c") in out                   # NULL keys form a group
        last = {(r.k, r.s): r.v for r in T.dedupe_first(df, ["k", "s"], ["d"], True, method).collect()}
        assert last[(1, "a")] == 10                 # descending, NULLs last
        assert last[(2, "b")] == 5


def test_dedupe_key_unique(spark):
    df = spark.range(1000).selectExpr("id % 7 as k", "id as v")
    out = T.dedupe_first(df, ["k"], ["v"])
    assert out.count() == 7 and out.groupBy("k").count().where("count > 1").count() == 0
    assert sorted(r.v for r in out.collect()) == list(range(7))


def test_enrich_payment_coalesced_key(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (9,)], "payment_type int")
    out = T.enrich_payment(df, seeds.payment_type_lookup(spark), null_code=0).collect()
    assert sorted((r.payment_type, r.payment_type_description) for r in out) == [
        (0, "Unknown"), (0, "Unknown"), (1, "Credit card"), (9, "Unknown")]


def test_enrich_payment_raw_key(spark):
    df = spark.createDataFrame([(None,), (0,), (9,)], "payment_type int")
    out = T.enrich_payment(df, seeds.payment_lookup_with_flex(spark), null_code=None,
                           lookup_code="payment_type_id", lookup_name="payment_type_name",
                           out_name="payment_type_name").collect()
    got = sorted((r.payment_type if r.payment_type is not None else -1, r.payment_type_name) for r in out)
    assert got == [(-1, "Unknown"), (0, "flex_fare"), (9, "Unknown")]


def test_enrich_zones_roles(spark):
    zones = spark.createDataFrame([(56, "Queens", "Corona"), (57, "Queens", "Corona"), (1, "EWR", "Newark")],
                                  "location_id int, borough string, zone string")
    trips = spark.createDataFrame([(56, 57), (1, 1), (999, 1)], "pickup_location_id int, dropoff_location_id int")
    left = T.enrich_zones(trips, zones, "left").collect()
    assert len(left) == 3
    assert {(r.pickup_zone, r.dropoff_zone) for r in left} == {("Corona", "Corona"), ("Newark", "Newark"),
                                                               (None, "Newark")}
    assert T.enrich_zones(trips, zones, "inner").count() == 2


def test_keep_columns_default(spark):
    df = spark.createDataFrame([("x", None), (None, 2.0)], "brand string, price double")
    out = T.keep_columns(df, ["brand", "price", "missing"]).collect()
    assert [tuple(r) for r in out] == [("x", "N/A", "N/A"), ("N/A", "2.0", "N/A")]


def test_union_trips_constants(spark):
    from tests.conftest import SF
    from tripmart.plans import warehouse
    u = warehouse.int_trips_unioned(spark, SF)
    y = u.where("service_type = 'Yellow'")
    assert y.where("trip_type <> 1 or ehail_fee <> 0").count() == 0
    assert u.columns == T.UNIONED_COLUMNS


def test_env_window_and_sample(spark):
    assert T.env_window("dev") == T.DEV_SAMPLE_WINDOW and T.env_window("prod") is None
    df = spark.createDataFrame([(D(2018, 12, 31),), (D(2019, 1, 1),), (D(2021, 1, 1),)], "pickup_datetime timestamp_ntz")
    assert T.sample_window(df, T.env_window("dev")).count() == 1
    assert T.sample_window(df, T.env_window("prod")).count() == 3


def test_record_load_and_head_rows(spark, db):
    from tripmart.plans import loads
    loads.record_load(spark, f"{db}.loads", "l1", "loaded")
    loads.record_load(spark, f"{db}.loads", "l2", "failed")
    assert sorted(r.load_id for r in spark.table(f"{db}.loads").collect()) == ["l1", "l2"]
    assert loads.head_rows(spark.range(1000), 100).count() == 100
    d = loads.describe_table(spark.range(5).selectExpr("id", "cast(id as string) s")).collect()
    assert [(r.column_name, r.data_type, r.row_count) for r in d] == [("id", "bigint", 5), ("s", "string", 5)]
