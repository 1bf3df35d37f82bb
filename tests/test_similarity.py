import numpy as np

from tripmart.operators import similarity as sim


def test_top_k_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sim, "QUERY_CHUNK", 2)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(300, 8)).round(1)
    vectors[7] = 0
    vectors[11] = vectors[12]  # a tie: the smaller id comes first
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)] + [(900, None), (901, [1.0])],
                                  "vec_id long, e array<double>").repartition(5)
    picked = [0, 12, 33, 44, 55]
    queries = spark.createDataFrame([(f"q{i}", vectors[i].tolist()) for i in picked], "name string, e array<double>")
    got = {}
    for r in sim.top_k_cosine(items, "vec_id", "e", queries, "name", "e", 6).collect():
        got.setdefault(r["name"], []).append((r["rank"], r["vec_id"], r["score"]))
    norm = np.linalg.norm(vectors, axis=1)
    for i in picked:
        with np.errstate(invalid="ignore", divide="ignore"):
            score = vectors @ vectors[i] / (norm * norm[i])
        order = sorted((k for k in range(300) if norm[k] > 0), key=lambda k: (-round(score[k], 12), k))[:6]
        rows = sorted(got[f"q{i}"])
        assert [v for _, v, _ in rows] == order and np.allclose([s for _, _, s in rows], score[order])


def test_few_items_and_no_queries(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0])], "vec_id long, e array<double>")
    queries = spark.createDataFrame([(5, [2.0, 0.0]), (6, None)], "q long, e array<double>")
    got = sim.top_k_cosine(items, "vec_id", "e", queries, "q", "e", 10).collect()
    assert sorted((r.q, r["rank"], r.vec_id, r.score) for r in got) == [(5, 1, 1, 1.0), (5, 2, 2, None), (5, 3, 3, None)]
    assert sim.top_k_cosine(items, "vec_id", "e", queries.limit(0), "q", "e", 10).count() == 0
