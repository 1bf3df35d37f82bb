import datetime as dt

from pyspark.sql import functions as F

from tripmart.functions import columns as C


def one(spark, expr, data, schema):
    return spark.createDataFrame(data, schema).select(expr.alias("r")).collect()


def test_cast_int_rounds_half_away(spark):
    rows = one(spark, C.cast_int("x"), [(2.5,), (-2.5,), (1.4,), (None,)], "x double")
    assert [r.r for r in rows] == [3, -3, 1, None]


def test_cast_int_half_even(spark):
    rows = one(spark, C.cast_int("x", "half_even"), [(2.5,), (3.5,)], "x double")
    assert [r.r for r in rows] == [2, 4]


def test_safe_cast_int_text(spark):
    rows = one(spark, C.safe_cast("x", "int"), [("1",), ("1.0",), (" 1 ",), ("abc",), (None,)], "x string")
    assert [r.r for r in rows] == [1, 1, 1, None, None]


def test_minutes_between_counts_boundaries(spark):
    d = dt.datetime
    data = [(d(2024, 1, 1, 0, 0, 59), d(2024, 1, 1, 0, 1, 1)),
            (d(2024, 1, 1, 0, 0, 1), d(2024, 1, 1, 0, 0, 59)),
            (d(2024, 1, 1, 0, 5, 0), d(2024, 1, 1, 0, 2, 30)),
            (d(2024, 1, 1, 23, 59, 59), d(2024, 1, 2, 0, 0, 0))]
    df = spark.createDataFrame(data, "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(C.minutes_between("a", "b")).collect()]
    assert got == [1, 0, -3, 1]


def test_surrogate_key_null_marker(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    got = df.select(C.surrogate_key("a", "b")).first()[0]
    want = df.select(F.md5(F.lit("1-" + C.SURROGATE_NULL))).first()[0]
    assert got == want


def test_row_hash_collides_without_separator(spark):
    df = spark.createDataFrame([("1", "2x"), ("12", "x"), (None, "12x")], "a string, b string")
    hashes = [r[0] for r in df.select(C.row_hash(df.schema, ["a", "b"])).collect()]
    assert len(set(hashes)) == 1


def test_round_decimal_half_up(spark):
    df = spark.createDataFrame([("1.005",)], "x string")
    assert float(df.select(F.round(F.col("x").cast("decimal(18,3)"), 2)).first()[0]) == 1.01


def test_vendor_name_no_else(spark):
    rows = one(spark, C.vendor_name("v"), [(1,), (2,), (3,), (4,), (None,)], "v int")
    assert [r.r for r in rows] == ["Creative Mobile Technologies", "VeriFone Inc.", None, "Unknown/Other", None]


def test_is_credit_and_pct(spark):
    df = spark.createDataFrame([("Credit",), (" 1 ",), ("cash",), (None,)], "p string")
    flags = [r[0] for r in df.select(C.is_credit("p")).collect()]
    assert flags[:3] == [True, True, False]
    assert df.agg(C.pct_where(C.is_credit("p"))).first()[0] == 50.0


def test_on_date_and_windows(spark):
    d = dt.datetime
    df = spark.createDataFrame([(d(2024, 1, 5, 0, 0),), (d(2024, 1, 5, 23, 59, 59, 500000),), (d(2024, 1, 6),)],
                               "t timestamp_ntz")
    like = df.schema["t"].dataType
    assert df.where(C.on_date("t", "2024-01-05", like)).count() == 2
    assert df.where(C.in_range_inclusive("t", "2024-01-05", "2024-01-05 23:59:59", like)).count() == 1
    assert df.where(C.in_window("t", "2024-01-05", "2024-01-06", like)).count() == 2
    # date window: a non-midnight end drops its whole day
    assert df.where(C.in_date_window("t", "2024-01-05 12:00", "2024-01-06 12:00")).count() == 2


def test_month_start_is_date(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 17, 5),)], "t timestamp_ntz")
    assert df.select(C.month_start("t")).first()[0] == dt.date(2024, 3, 1)


def test_sum_zero_vs_sum(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    r = df.agg(F.sum("x"), C.sum_zero("x")).first()
    assert r[0] is None and r[1] == 0


def test_scale_conf_sizes_partitions(spark):
    from tripmart.session import apply_scale_conf, shuffle_partitions_for
    assert shuffle_partitions_for(100 * 2**40) == 32768   # the stated ceiling
    assert shuffle_partitions_for(2**40) == 4096
    assert shuffle_partitions_for(10 * 2**20) == 200
    applied = apply_scale_conf(spark, 2**40)
    # the test session sets shuffle partitions in its builder: cluster settings win
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8" and "spark.sql.shuffle.partitions" not in applied
    assert applied["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 * 1024)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))


def test_settings_of_a_session_that_sets_nothing():
    """A session of its own process: nothing set, so the input's size decides."""
    code = """
from tripmart.session import apply_scale_conf, build_session
s = build_session(master="local[1]")
assert not s.sparkContext.getConf().contains("spark.sql.shuffle.partitions")
applied = apply_scale_conf(s, 2**40)
assert applied["spark.sql.shuffle.partitions"] == "4096" == s.conf.get("spark.sql.shuffle.partitions")
apply_scale_conf(s, 2**30)
assert s.conf.get("spark.sql.shuffle.partitions") == "200"
print("as expected")
"""
    import subprocess
    import sys
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert "as expected" in run.stdout, run.stderr[-1500:]


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    import pytest
    from tripmart import session

    class Fake:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: None)})()
        sparkContext = type("S", (), {"master": "local-cluster[2,1,512]", "getCheckpointDir": staticmethod(lambda: None),
                                      "getConf": staticmethod(lambda: type("K", (), {"get": staticmethod(lambda k, d=None: None)})())})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_root(Fake())
    assert session.is_one_machine(spark)
