"""Zone maps from footers and the Z-order layout."""

import datetime as dt

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart.plans import gate_sources
from tripmart.sinks import layout
from tests.conftest import SF


def test_zone_map_against_the_data(spark, db):
    rows = spark.range(4000).selectExpr("id", "cast(id % 7 as int) k", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int)) t",
                                        "if(id % 3 = 0, null, cast(id as string)) s", "cast(id as decimal(12,2)) m", "date'2024-01-01' + cast(id as int) d")
    rows.repartitionByRange(5, "id").write.option("parquet.block.size", 16 * 1024).saveAsTable(f"{db}.z")
    files = layout.files_of(spark, f"{db}.z")
    zones = layout.zone_map(spark, files, StructType([rows.schema[c] for c in ("id", "t", "s", "m", "d")])).collect()
    assert sum(z.rows for z in zones) == 4000 and len({z.file for z in zones}) == 5 and len(zones) > 5
    for z in zones:
        group = pq.ParquetFile(z.file.removeprefix("file:").replace("//", "/")).read_row_group(z.row_group).to_pylist()
        assert (z.id_min, z.id_max) == (min(r["id"] for r in group), max(r["id"] for r in group))
        assert (z.t_min, z.t_max, z.d_min, z.m_max) == (min(r["t"] for r in group), max(r["t"] for r in group), min(r["d"] for r in group), max(r["m"] for r in group))
        assert 0 < z.id_bytes < z.bytes
    frame = layout.zone_map(spark, files, StructType([rows.schema["id"]]))
    hit = layout.reached(frame, {"id": (F.lit(1000), F.lit(1010))})
    cost = layout.scan_cost(hit, ["id"]).first()
    assert cost.files == 1 and 1 <= cost.row_groups <= 2 and cost.rows < 800
    assert tuple(layout.scan_cost(layout.reached(frame, {"id": (F.lit(9999), F.lit(10_000))})).first()) == (0, 0, 0, 0)


def test_z_order_is_narrow_in_both_columns(spark, db):
    rows = spark.range(20_000).select("id", F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"),
                                      F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.hash("id"), F.lit(900)).cast("int")).alias("b"))
    rows.repartition(16, F.xxhash64("id")).write.saveAsTable(f"{db}.plain")
    rows.repartitionByRange(16, "a", "id").write.saveAsTable(f"{db}.sorted")
    layout.write_z_ordered(rows, f"{db}.z", ["a", "b"], 16)
    kinds = StructType([rows.schema["a"], rows.schema["b"]])
    found = {}
    for name in ("plain", "sorted", "z"):
        zones = layout.zone_map(spark, layout.files_of(spark, f"{db}.{name}"), kinds)
        found[name] = [layout.scan_cost(layout.reached(zones, r)).first().files for r in (
            {"a": (F.lit(100), F.lit(150))}, {"b": (F.lit(dt.date(2024, 3, 1)), F.lit(dt.date(2024, 4, 1)))})]
    assert found["plain"] == [16, 16] and found["sorted"][0] <= 2 and found["sorted"][1] == 16
    assert max(found["z"]) <= 8
    assert sorted(r.id for r in spark.table(f"{db}.z").select("id").collect()) == list(range(20_000))


def test_z_order_of_odd_values(spark, db):
    """NULLs, text, one value for all rows, no rows."""
    rows = spark.createDataFrame([(i, None if i % 4 == 0 else "x" * (i % 5), 1.0) for i in range(200)], "id int, s string, c double")
    for name, df in (("odd", rows), ("none", rows.limit(0))):
        layout.write_z_ordered(df, f"{db}.{name}", ["s", "c"], 4)
        assert spark.table(f"{db}.{name}").count() == df.count()


def test_a_common_value_is_spread_over_tasks(spark):
    rows = spark.range(8000).select("id", F.lit(1).alias("a"), F.lit(2).alias("b"))
    sizes = [r["count"] for r in layout.z_ordered(rows, ["a", "b"], 4).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 4000


def test_costs_of_the_three_layouts(spark):
    costs = {r.layout: r for r in gate_sources.layout_costs(spark, SF).collect()}
    assert costs["plain"].found == costs["z_ordered"].found == costs["partitioned"].found
    assert costs["z_ordered"].bytes < costs["plain"].bytes and costs["partitioned"].row_groups < costs["plain"].row_groups
