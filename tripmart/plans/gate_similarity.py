"""Gate query of the embedding retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators import ivf
from tripmart.operators.similarity import centroids, top_k_cosine
from tripmart.plans.gate import gate
from tripmart.session import scratch_database
from tripmart.sinks.tables import materialize
from tripmart.sources import adapter

TOP_K = 10


@gate("embedding_topk", f"""
with e as (select vec_id, label, cast(embedding as double[]) as v from embeddings),
x as (select label, unnest(generate_series(1, len(v))) as i, unnest(v) as val from e),
c as (select label, list(m order by i) as centroid
      from (select label, i, avg(val) as m from x group by label, i) group by label),
s as (select c.label, e.vec_id, list_cosine_similarity(e.v, c.centroid) as score
      from e join c on true),
r as (select label, vec_id, score, row_number() over (partition by label order by score desc nulls last, vec_id) as rank
      from s)
select label, cast(rank as int) as rank, vec_id, round(r.score, 6) as score from r where rank <= {TOP_K}""")
def embedding_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten embeddings nearest (cosine) to each label's centroid."""
    emb = adapter.table(spark, sf_dir, "embeddings")
    c = centroids(emb, "label", "embedding")
    r = top_k_cosine(emb, "vec_id", "embedding", c, "label", "centroid", TOP_K)
    return r.select("label", "rank", "vec_id", F.round("score", 6).alias("score"))


@gate("embedding_ivf", """select count(*) filter (vec_id % 20 = 0) as queries, count(*) as rows, true as recall_from_0_9, true as exact_agrees
from embeddings""")
def embedding_ivf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding whose id is divisible by 20 searched in an inverted
    file of all: the share of the exact ten nearest that it finds, and the
    search of all cells against the exact one."""
    emb = adapter.table(spark, sf_dir, "embeddings")
    name = f"{scratch_database(spark, 'ivf')}.vectors"
    ivf.build(emb, "vec_id", "embedding", name)
    asked = emb.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query"), "embedding")
    exact = materialize(top_k_cosine(emb, "vec_id", "embedding", asked, "query", "embedding", TOP_K), "exact")
    near = materialize(ivf.search(spark, name, asked, "query", "embedding", TOP_K).select("query", F.col("item").alias("vec_id"), F.lit(1).alias("hit")), "near")
    whole = ivf.search(spark, name, asked, "query", "embedding", TOP_K, exact=True).select(
        "query", F.col("item").alias("vec_id"), F.col("rank").alias("same"))
    met = exact.join(near, ["query", "vec_id"], "left").join(whole, ["query", "vec_id"], "left")
    counted = met.agg(F.countDistinct("query").alias("queries"), (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("recall_from_0_9"),
                      F.bool_and(F.coalesce(F.col("same") == F.col("rank"), F.lit(False))).alias("exact_agrees"))
    return counted.select("queries", F.lit(spark.table(name).count()).alias("rows"), "recall_from_0_9", "exact_agrees")
