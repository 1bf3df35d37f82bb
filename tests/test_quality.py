import datetime as dt

from pyspark.sql import functions as F

from tripmart.operators import quality as Q


def _result(df):
    return {(r.check_name, r.column_name): (r.violations, r.passed) for r in df.collect()}


def test_row_checks_planted_and_passing(spark):
    df = spark.createDataFrame([(1, "Green", 5.0), (2, "Blue", -1.0), (None, None, 0.0)],
                               "id int, s string, x double")
    r = _result(Q.run_checks(df, [Q.not_null("id"), Q.accepted_values("s", ["Green", "Yellow"]),
                                   Q.non_negative("x"), Q.positive("x"), Q.not_null("x")], "t"))
    assert r[("not_null", "id")] == (1, False)
    assert r[("accepted_values", "s")] == (1, False)      # NULL passes
    assert r[("non_negative", "x")] == (1, False)
    assert r[("positive", "x")] == (2, False)
    assert r[("not_null", "x")] == (0, True)


def test_unique_and_combination(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, "b"), (None, "b")], "k int, s string")
    r = _result(Q.run_checks(df, [Q.unique("k"), Q.unique_combination("k", "s"), Q.unique("s")], "t"))
    assert r[("unique", "k")] == (1, False)                # NULLs ignored
    assert r[("unique_combination_of_columns", "k,s")] == (1, False)
    assert r[("unique", "s")] == (2, False)
    ok = spark.createDataFrame([(1,), (2,)], "k int")
    assert _result(Q.run_checks(ok, [Q.unique("k")], "t"))[("unique", "k")] == (0, True)


def test_relationships_ignore_null(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1,), (3,), (None,)], "fk int")
    r = _result(Q.run_checks(child, [Q.relationships("fk", parent, "id")], "t"))
    assert r[("relationships", "fk")] == (1, False)


def test_custom_value_and_freshness(spark):
    spark.createDataFrame([(1, 2), (3, 3)], "a int, b int").createOrReplaceTempView("q_t")
    r = Q.custom_value(spark, "b_after_a", "select count(*) from q_t where b <= a", 0).first()
    assert r.violations == 1 and r.passed is False
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp_ntz")
    assert Q.freshness(df, "t", "2024-01-01 12:00:00").first().status == "pass"
    assert Q.freshness(df, "t", "2024-01-02 06:00:00").first().status == "warn"
    assert Q.freshness(df, "t", "2024-01-03 06:00:00").first().status == "error"


def test_all_key_checks_in_one_shuffle_by_key(spark):
    rows = [(1, 1.5, "a", dt.datetime(2024, 1, 1), b"x"), (1, 0.0, "a:1", None, b"x"), (2, -0.0, None, dt.datetime(2024, 1, 1), None),
            (3, float("nan"), "a", None, b"y"), (None, float("nan"), "1", dt.datetime(2024, 1, 2), b"\xff"), (None, None, "a", None, b"\xfe")]
    df = spark.createDataFrame(rows, "i int, d double, s string, t timestamp, b binary").withColumn("l", F.array("i"))
    sets = [("i",), ("d",), ("s",), ("t",), ("b",), ("i", "s"), ("s", "i"), ("d", "t")]
    checks = [Q.unique_combination(*c) if len(c) > 1 else Q.unique(*c) for c in sets] + [Q.unique("l")]
    got = {(r.check_name, r.column_name): r.violations for r in Q.run_checks(df, checks, "t").collect()}
    want = {(c.kind, ",".join(c.columns)): Q.duplicated_groups(df, c.columns).count() for c in checks}
    assert got == want and want[("unique", "d")] == 2 and want[("unique", "l")] >= 1
    plan = Q.run_checks(df, checks[:-1], "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2


def test_keys_that_join_to_the_same_text_differ(spark):
    df = spark.createDataFrame([("a", "1:b"), ("a1:", "b"), ("1", "11"), ("11", "1")], "x string, y string")
    assert Q.duplicate_counts(df, [("x", "y")]).first() == (0,)
