"""Files of differing types are united without a changed value."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string as T

from tripmart.session import scratch_dir
from tripmart.sources import files, widening as W


@pytest.mark.parametrize("types,want", [
    ("int, bigint", "bigint"), ("tinyint, smallint", "smallint"), ("decimal(20,2), decimal(18,4)", "decimal(22,4)"),
    ("decimal(20,2), bigint", "decimal(21,2)"), ("decimal(5,2), int", "decimal(12,2)"), ("int, double", "double"), ("smallint, float", "float"),
    ("int, float", "double"), ("bigint, double, decimal(9,1)", "double"), ("date, timestamp_ntz", "timestamp_ntz"),
    ("timestamp, timestamp_ntz", "timestamp_ntz"), ("void, date", "date"), ("string, int", "string"),
    ("struct<a:int>, struct<a:bigint,b:string>", "struct<a:bigint,b:string>"), ("array<int>, array<decimal(12,1)>", "array<decimal(12,1)>"),
    ("map<string,int>, map<string,double>", "map<string,double>")])
def test_least_common(spark, types, want):
    kinds = [T(t) for t in types.split(", ")]
    assert W.same(W.least_common(kinds), T(want))
    assert W.same(W.least_common(kinds[::-1]), W.least_common(kinds)) or "struct" in types


@pytest.mark.parametrize("types", ["boolean, int", "date, int", "binary, string", "struct<a:int>, int", "decimal(38,0), decimal(38,10)",
                                   "struct<a:int>, struct<a:boolean>"])
def test_types_without_a_common_one(spark, types):
    with pytest.raises(W.WideningError):
        W.least_common([T(t) for t in types.split(", ")])


def months(spark, *kinds):
    """A folder with a month file for each (type, value as SQL)."""
    root = scratch_dir(spark, "t-wide")
    for m, (kind, value) in enumerate(kinds, 1):
        spark.range(1).selectExpr(f"{m}L as id", f"cast({value} as {kind}) as x").write.parquet(f"{root}/yellow_tripdata_2024-{m:02d}.parquet")
    return files.read_months(spark, root, ["yellow"], dt.date(2024, 1, 1), dt.date(2024, 12, 1), spark.range(0).schema, dt.datetime(2024, 1, 1))


@pytest.mark.parametrize("kinds,want", [
    ([("decimal(20,2)", "12345678901234567.89BD"), ("decimal(18,2)", "0.01BD")], ["12345678901234567.89", "0.01"]),
    ([("bigint", "9007199254740993"), ("decimal(10,3)", "1.5BD")], ["9007199254740993.000", "1.500"]),
    ([("bigint", "9007199254740992"), ("double", "0.5D")], ["9.007199254740992E15", "0.5"]),
    ([("timestamp", "timestamp'2024-01-01 10:00:00'"), ("timestamp_ntz", "timestamp_ntz'2024-01-01 11:00:00.000001'"), ("date", "date'2024-01-02'")],
     ["2024-01-01 10:00:00", "2024-01-01 11:00:00.000001", "2024-01-02 00:00:00"]),
    ([("struct<a:int>", "named_struct('a', 1)"), ("struct<a:bigint,b:string>", "named_struct('a', 9007199254740993, 'b', 'z')")],
     ["{1, null}", "{9007199254740993, z}"]),
    ([("int", "7"), ("string", "'x'"), ("bigint", "null")], ["7", "x", None])])
def test_no_value_changes(spark, kinds, want):
    df = months(spark, *kinds)
    got = df.orderBy("id").select(F.col("x").cast("string").alias("x")).collect()
    assert [r.x for r in got] == want


@pytest.mark.parametrize("kinds", [
    [("double", "0.5D"), ("bigint", "9007199254740993")], [("double", "0.5D"), ("bigint", "9223372036854775807")],
    [("double", "0.5D"), ("decimal(20,2)", "12345678901234567.89BD")]])
def test_a_value_that_would_change_fails_with_its_file(spark, kinds):
    with pytest.raises(Exception, match=r"column x: .* is not exact as double in .*2024-02"):
        months(spark, *kinds).collect()


def test_types_in_conflict_name_their_files(spark):
    with pytest.raises(W.WideningError, match="column x: .*boolean in [^;]*2024-01"):
        months(spark, ("boolean", "true"), ("int", "1"))


def test_a_wanted_type_takes_exact_values_only(spark):
    root = scratch_dir(spark, "t-wanted")
    spark.range(1).selectExpr("2.0D as id").write.parquet(f"{root}/yellow_tripdata_2024-01.parquet")
    span = (["yellow"], dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    schema = spark.range(0).schema
    assert files.read_months(spark, root, *span, schema).first()["id"] == 2
    spark.range(1).selectExpr("2.5D as id").write.parquet(f"{root}/yellow_tripdata_2024-02.parquet")
    with pytest.raises(Exception, match="column id: 2.5 .double. is not exact as bigint in .*2024-02"):
        files.read_months(spark, root, *span, schema).collect()


def test_files_of_one_schema_are_one_job(spark):
    root = scratch_dir(spark, "t-groups")
    for i in range(12):
        kind = "int" if i < 9 else "double"
        spark.range(1).selectExpr(f"cast({i} as {kind}) as x", *([f"{i} as extra"] if i % 2 else [])).write.parquet(f"{root}/{i:02d}")
    paths = [f"{root}/{i:02d}" for i in range(12)]
    got = files.schema_groups(spark, paths)
    assert [(s["x"].dataType.simpleString(), sorted(p)) for s, p in got] == [("int", paths[:9]), ("double", paths[9:])]
    assert all("extra" in s.names for s, _ in got)
    spark.sparkContext.setJobGroup("footers", "one job")
    files.schema_groups(spark, paths[:9])
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("footers")) <= 1


def test_headers_of_many_files_without_a_job(spark):
    import gzip
    import os
    root = scratch_dir(spark, "t-heads").removeprefix("file:")
    os.makedirs(root)
    for i in range(60):
        text = f'﻿id,"a, {i % 3}"\n{i},x\n' if i % 2 else f"id,b\n{i},y\n"
        if i % 5 == 0:
            with gzip.open(f"{root}/{i}.csv.gz", "wt") as f:
                f.write(text)
        else:
            with open(f"{root}/{i}.csv", "w") as f:
                f.write(text)
    open(f"{root}/empty.csv", "w").close()
    spark.sparkContext.setJobGroup("heads", "none")
    names = files.first_lines(spark, files.data_files(spark, root))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("heads")
    assert len(names) == 61 and {tuple(files.header_names(n)) for n in names} == {(), ("id", "b"), *(("id", f"a, {k}") for k in range(3))}
    got = files.read_csv_header_typed(spark, root, {"id": "int"})
    assert got.count() == 60 and sorted(r.id for r in got.select("id").collect()) == list(range(60))
