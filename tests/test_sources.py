import datetime as dt
import os

import pytest
from pyspark.sql.types import DoubleType, LongType, StringType

from tripmart.session import scratch_dir
from tripmart.sources import files


def _write(path, name, text, binary=False):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "wb") as f:
        f.write(text if binary else text.encode())


def test_csv_surplus_column_and_bad_value(spark):
    """Both fail the typed read; the permissive mode (external tables) takes what fits."""
    schema = spark.createDataFrame([], "id int, amount double").schema
    for text in ("id,amount\n1,2.5,extra\n", "id,amount\nx,3\n"):
        p = scratch_dir(spark, "t-csv")
        _write(p, "a.csv", text)
        with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
            files.read_csv(spark, p, schema).collect()
    p = scratch_dir(spark, "t-csv")
    _write(p, "a.csv", "id,amount\n1,2.5,extra\nx,3\n")
    df = files.read_csv(spark, p, schema, mode="PERMISSIVE")
    assert sorted((r.id if r.id is not None else -1, r.amount) for r in df.collect()) == [(-1, 3.0), (1, 2.5)]


def test_csv_copy_in_by_position(spark):
    p = scratch_dir(spark, "t-copy")
    _write(p, "a.csv", "7,b\n")
    schema = spark.createDataFrame([], "row_id string, k int, v string, fname string").schema
    r = files.read_csv(spark, p, schema, header=False, columns=["k", "v"]).first()
    assert (r.row_id, r.k, r.v, r.fname) == (None, 7, "b", None)


def test_tsv_seed_crlf_without_final_newline(spark):
    p = scratch_dir(spark, "t-seed")
    _write(p, "z.csv", b"LocationID\tBorough\tZone\r\n1\tEWR\tNewark Airport\r\n2\tQueens\tJamaica Bay", True)
    df = files.read_seed(spark, p, sep="\t")
    assert df.columns == ["locationid", "borough", "zone"]
    assert [tuple(r) for r in df.orderBy("locationid").collect()] == [(1, "EWR", "Newark Airport"),
                                                                       (2, "Queens", "Jamaica Bay")]


def test_header_driven_types(spark):
    p = scratch_dir(spark, "t-hdr")
    _write(p, "a.csv", "VendorID,fare_amount,Mystery\n1,2.5,x\n")
    df = files.read_csv_header_typed(spark, p, {"vendorid": LongType(), "fare_amount": "double"})
    assert [f.dataType for f in df.schema.fields] == [LongType(), DoubleType(), StringType()]
    assert tuple(df.first()) == (1, 2.5, "x")


def test_json_records_missing_key(spark):
    p = scratch_dir(spark, "t-json")
    _write(p, "a.json", '{"products": [{"brand": "A", "price": 2}, {"price": 4}]}\n{"products": []}\n')
    from tripmart.operators.transforms import keep_columns
    recs = files.read_json_records(spark, p, "products")
    got = sorted(tuple(r) for r in keep_columns(recs, ["brand", "price"]).collect())
    assert ("A", "2") in got and ("N/A", "4") in got


def test_plan_months_inclusive():
    got = files.plan_months(dt.date(2024, 11, 30), dt.date(2025, 2, 1), ["yellow"])
    assert got == [(2024, 11, "yellow"), (2024, 12, "yellow"), (2025, 1, "yellow"), (2025, 2, "yellow")]


def test_read_months_skips_missing_and_merges(spark):
    root = scratch_dir(spark, "t-months")
    spark.createDataFrame([(1, 1.0)], "id long, x double").write.parquet(f"{root}/yellow_tripdata_2024-01.parquet")
    spark.createDataFrame([(2, 2.0, "z")], "id long, x double, extra string") \
        .write.parquet(f"{root}/yellow_tripdata_2024-03.parquet")
    schema = spark.createDataFrame([], "id long, x double, y string").schema
    df = files.read_months(spark, root, ["yellow", "green"], dt.date(2024, 1, 1), dt.date(2024, 4, 1), schema,
                           dt.datetime(2024, 5, 1))
    rows = sorted((r.id, r.y, r.extra) for r in df.collect())
    assert rows == [(1, None, None), (2, None, "z")]
    empty = files.read_months(spark, root, ["fhv"], dt.date(2024, 1, 1), dt.date(2024, 2, 1), schema)
    assert empty.count() == 0 and "extracted_at" in empty.columns


def test_source_file_names(spark):
    root = scratch_dir(spark, "t-names")
    _write(root, "green_tripdata_2019-01.csv", "a\n1\n2\n")
    _write(root, "notes.csv", "a\n3\n")
    df = files.with_source_file(spark.read.option("header", True).csv(root))
    assert sorted((r.filename, r.a) for r in df.collect()) == [("green_tripdata_2019-01.csv", "1"),
                                                                ("green_tripdata_2019-01.csv", "2")]


def test_read_months_fails_on_a_truncated_file_unless_it_is_skipped(spark):
    root = scratch_dir(spark, "t-months-bad")
    spark.createDataFrame([(1, 1.0)], "id long, x double").write.parquet(f"{root}/yellow_tripdata_2024-01.parquet")
    spark.range(2000).selectExpr("id", "cast(id as double) x").coalesce(1).write.parquet(f"{root}/whole.parquet")
    whole = next(f for f in os.listdir(f"{root}/whole.parquet") if f.startswith("part-"))
    with open(f"{root}/whole.parquet/{whole}", "rb") as f:
        good = f.read()
    cut, garbled = f"{root}/yellow_tripdata_2024-02.parquet", f"{root}/yellow_tripdata_2024-03.parquet"
    _write(cut, "part-0.parquet", good[:len(good) // 2], True)
    _write(garbled, "part-0.parquet", good[:300] + bytes(x ^ 255 for x in good[300:3000]) + good[3000:], True)  # the footer is whole
    schema = spark.createDataFrame([], "id long, x double").schema
    span = (["yellow"], dt.date(2024, 1, 1), dt.date(2024, 3, 1))
    with pytest.raises(Exception):
        files.read_months(spark, root, *span, schema).collect()
    bad = files.unreadable(spark, files.month_paths(spark, root, *span))
    assert bad == [cut, garbled]
    assert [r.id for r in files.read_months(spark, root, *span, schema, skip=bad).collect()] == [1]


def test_read_months_widens_types(spark):
    root = scratch_dir(spark, "t-widen")
    for month, kinds in ((1, "id int, fee int, note int"), (2, "id bigint, fee double, note string"), (3, "id double, fee bigint, note int")):
        spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").selectExpr(
            *[f"cast({c} as {k.split()[1]}) as {k.split()[0]}" for c, k in zip("abc", kinds.split(", "))]) \
            .write.parquet(f"{root}/green_tripdata_2024-{month:02d}.parquet")
    schema = spark.createDataFrame([], "id bigint").schema
    df = files.read_months(spark, root, ["green"], dt.date(2024, 1, 1), dt.date(2024, 3, 1), schema)
    assert [f.dataType.simpleString() for f in df.schema.fields][:3] == ["bigint", "double", "string"]
    assert [tuple(r)[:3] for r in df.collect()] == [(1, 2.0, "3")] * 3


def test_only_whole_trip_file_names_count(spark):
    names = ["/x/yellow_tripdata_2020-01.csv", "/x/fhv_tripdata_2020-12.csv.gz", "/x/foo_tripdata_2020-01.csv",
             "/x/old_yellow_tripdata_2020-01_bak.txt", "/green_tripdata_2020-01/readme.md", "green_tripdata_2019-07.csv"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    got = [r.t for r in df.select(files.parse_trip_filename(df["p"])[0].alias("t")).collect()]
    assert got == ["yellow", "fhv", "", "", "", "green"]


def test_headers_are_read_per_file_and_quoted_names_kept(spark):
    p = scratch_dir(spark, "t-headers")
    _write(p, "a.csv", 'VendorID,"fare, total"\n1,x\n')
    _write(p, "b.csv", "extra,VendorID\ny,2\n")
    df = files.read_csv_header_typed(spark, p, {"vendorid": "int"})
    assert sorted((r["VendorID"], r["fare, total"], r["extra"]) for r in df.collect()) == [(1, "x", None), (2, None, "y")]
    _write(p, "c.csv", "VendorID\nnot a number\n")
    with pytest.raises(Exception):
        files.read_csv_header_typed(spark, p, {"vendorid": "int"}).collect()
    inferred = files.read_csv_header_typed(spark, p, {"vendorid": "int"}, on_bad_value="infer")
    assert sorted(r["VendorID"] for r in inferred.collect()) == ["1", "2", "not a number"]


def test_trip_schemas_and_backfill(spark, db):
    from tripmart.plans import loads
    from tripmart.sources.trips import TYPE_MAP, trip_schema
    assert len(trip_schema("yellow").fields) == 18 and len(trip_schema("green").fields) == 20 and TYPE_MAP["airport_fee"] == "decimal(38,9)"
    root = scratch_dir(spark, "t-backfill")
    header = ",".join(f.name for f in trip_schema("green").fields)
    for month, rows in ((1, ["1", "2"]), (3, ["3"])):
        lines = [f"{v},2020-0{month}-05 10:00:00,2020-0{month}-05 10:30:00,N,1,7,8,1,2.5,10.0,0,0.5,1,0,,0.3,12.3,1,1,0" for v in rows]
        _write(root, f"green_tripdata_2020-0{month}.csv", "\n".join([header, *lines]) + "\n")
    span = (["green", "yellow"], dt.date(2020, 1, 1), dt.date(2020, 4, 1))
    names = ["green_tripdata_2020-01.csv", "green_tripdata_2020-03.csv"]
    for _ in range(2):
        assert loads.backfill(spark, root, *span, db) == names
    got = spark.table(f"{db}.green_tripdata").collect()
    assert sorted((r.VendorID, r.filename) for r in got) == [("1", names[0]), ("2", names[0]), ("3", names[1])]
    assert spark.table(f"{db}.green_tripdata").where("ehail_fee is null and total_amount = 12.3").count() == 3


def test_gzip_csv_spread_after_read(spark):
    import gzip
    p = scratch_dir(spark, "t-gz")
    os.makedirs(p, exist_ok=True)
    with gzip.open(os.path.join(p, "a.csv.gz"), "wt") as f:
        f.write("id\n" + "\n".join(str(i) for i in range(1000)) + "\n")
    schema = spark.createDataFrame([], "id int").schema
    assert files.read_csv(spark, p, schema).rdd.getNumPartitions() == 1
    df = files.read_csv(spark, p, schema, min_partitions=4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 1000


def test_files_merged_by_one_job_as_one_after_another(spark, db):
    from tripmart.plans import loads
    from tripmart.sources.trips import trip_schema
    root = scratch_dir(spark, "t-at-once")
    header = ",".join(f.name for f in trip_schema("green").fields)
    line = "{v},2020-01-05 10:00:00,2020-01-05 10:30:00,N,1,7,8,1,2.5,10.0,0,0.5,1,0,,0.3,{t},1,1,0"
    # Vendor 1 comes twice in January and again in February, vendor 2 in February and March.
    for month, rows in ((1, [(1, 1.0), (1, 2.0)]), (2, [(1, 9.0), (2, 3.0), (2, 4.0)]), (3, [(2, 9.0), (3, 5.0)])):
        _write(root, f"green_tripdata_2020-0{month}.csv", "\n".join([header, *(line.format(v=v, t=t) for v, t in rows)]) + "\n")
    spark.sql(f"CREATE DATABASE {db}_b")
    span = (["green"], dt.date(2019, 12, 1), dt.date(2020, 4, 1))
    got = []
    for name, at_once in ((db, 1), (f"{db}_b", 12)):
        for _ in range(2):
            assert len(loads.backfill(spark, root, *span, name, at_once=at_once)) == 3
        got.append(sorted((int(r.VendorID), r.filename[-6:-4], r.total_amount) for r in spark.table(f"{name}.green_tripdata").collect()))
    assert got[0] == got[1] == [(1, "01", 1.0), (1, "01", 2.0), (2, "02", 3.0), (2, "02", 4.0), (3, "03", 5.0)]


def test_variant_records_keep_absent_and_null_apart(spark):
    from tripmart.operators.transforms import keep_record_columns
    p = scratch_dir(spark, "t-variant")
    _write(p, "a.json", '{"products": [{"brand": "A", "price": 2.50, "it\'s": 1}, {"price": null}, null, {"brand": {"x": [1]}}]}\n{"products": []}\n{"other": 1}\n')
    recs = files.read_json_variants(spark, p, "$.products")
    got = [tuple(r) for r in keep_record_columns(recs, ["brand", "price", "it's"]).collect()]
    assert got == [("A", "2.5", "1"), ("N/A", None, "N/A"), ("N/A", "N/A", "N/A"), ('{"x":[1]}', "N/A", "N/A")]


def test_scale_settings_leave_explicit_ones(spark):
    from tripmart.session import apply_scale_conf
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "7000000")
    applied = apply_scale_conf(own, 1 << 40)
    assert own.conf.get("spark.sql.files.maxPartitionBytes") == "7000000" and "spark.sql.files.maxPartitionBytes" not in applied
    assert applied["spark.sql.autoBroadcastJoinThreshold"] == own.conf.get("spark.sql.autoBroadcastJoinThreshold")
