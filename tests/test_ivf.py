"""The inverted file against the exact search."""

import numpy as np

from tripmart.operators import ivf
from tripmart.operators.similarity import top_k_cosine, vectors_of
import pyarrow as pa


def frame(spark, n=3000, dim=16, seed=4):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(30, dim))
    v = middle[rng.integers(0, 30, n)] + 0.4 * rng.normal(size=(n, dim))
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")


def rows(df):
    return sorted((r[0], r[1], r[2], None if r[3] is None else round(r[3], 9)) for r in df.collect())


def test_recall_and_the_exact_switch(spark, db):
    items = frame(spark).repartition(6)
    ivf.build(items, "id", "v", f"{db}.x")
    asked = items.where("id % 20 = 0").selectExpr("id as q", "v as w")
    exact = rows(top_k_cosine(items, "id", "v", asked, "q", "w", 10))
    assert rows(ivf.search(spark, f"{db}.x", asked, "q", "w", 10, exact=True)) == exact
    near = rows(ivf.search(spark, f"{db}.x", asked, "q", "w", 10, probes=6))
    assert len(near) == len(exact)
    assert len({(q, i) for q, _, i, _ in near} & {(q, i) for q, _, i, _ in exact}) >= 0.9 * len(exact)
    assert spark.table(f"{db}.x").count() == 3000 and spark.table(f"{db}.x").select("cell").distinct().count() > 30


def test_only_probed_cells_are_read(spark, db):
    items = frame(spark)
    ivf.build(items, "id", "v", f"{db}.x", cells=20)
    found = ivf.search(spark, f"{db}.x", items.where("id = 7").selectExpr("id as q", "v as w"), "q", "w", 5, probes=2)
    assert found.first()["item"] == 7
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell#" in plan or "PartitionFilters: [isnotnull(cell#" in plan


def test_odd_vectors(spark, db):
    """NULL, zero, shorter ones, NULL elements, equal ones, no rows, a query without a direction."""
    odd = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0]), (6, [0.0, 2.0]), (7, [None, 1.0]), (8, [])]
    items = spark.createDataFrame(odd, "id long, v array<double>").selectExpr("*", "1 as cell", "'x' as item", "2 as rank")
    asked = spark.createDataFrame([(1, [1.0, 0.1]), (2, [0.0, 0.0]), (3, None), (4, [1.0])], "q long, w array<double>")
    ivf.build(items, "id", "v", f"{db}.odd")
    got = rows(ivf.search(spark, f"{db}.odd", asked, "q", "w", 9, exact=True))
    assert got == rows(top_k_cosine(items, "id", "v", asked.where("q < 3"), "q", "w", 9)) and len(got) == 16
    ivf.build(items.limit(0), "id", "v", f"{db}.none")
    assert ivf.search(spark, f"{db}.none", asked, "q", "w", 3).count() == 0


def test_cells_do_not_depend_on_how_rows_are_stored(spark, db):
    items = frame(spark, 600)
    cells = []
    for name, rows_ in (("a", items.coalesce(1)), ("b", items.repartition(5))):
        ivf.build(rows_, "id", "v", f"{db}.{name}", sample_rows=200)
        cells.append({r.item: r.cell for r in spark.table(f"{db}.{name}").collect()})
    assert cells[0] == cells[1]


def test_vectors_of_arrow_lists():
    assert vectors_of(pa.array([[1.0, 2.0], [3.0, 4.0]]), 2).tolist() == [[1, 2], [3, 4]]
    assert vectors_of(pa.array([[1.0, 2.0], None, [5.0]]), 2).tolist() == [[1, 2], [0, 0], [0, 0]]
    assert vectors_of(pa.array([[9.0], [1.0, 2.0], [3.0, 4.0]]).slice(1), 2).tolist() == [[1, 2], [3, 4]]
    assert vectors_of(pa.array([], pa.list_(pa.float64())), 3).shape == (0, 3)
