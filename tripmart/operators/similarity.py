"""Exact top-k cosine retrieval over an embedding table (Q-17, re-aimed from
the retrieval half of a RAG flow).

The item table is scanned once per chunk of queries.  Every Arrow batch of
items is scored against all queries of the chunk by one matrix product and
gives at most ``k`` rows per query, so no rows for all pairs come into being;
the rest is a ``row_number() <= k`` window, which Spark precedes with a limit
per task.  The query set is small by contract (e.g. one centroid per label);
a chunk bounds what is broadcast whatever its number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Queries per broadcast matrix.
QUERY_CHUNK = 1024


def centroids(df: DataFrame, group: str, vec: str) -> DataFrame:
    """Element-wise mean vector per group (exact per-dimension averages).
    Grouping by (group, dimension) aggregates partially before the shuffle."""
    ex = df.select(group, F.posexplode(vec).alias("i", "x"))
    g = ex.groupBy(group, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    per = g.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("s"))
    return per.select(group, F.transform("s", lambda s: s["x"]).alias("centroid"))


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows of length one; rows of length zero become NaN."""
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=np.full_like(m, np.nan), where=norm > 0)


def vectors_of(column: pa.ListArray, width: int) -> np.ndarray:
    """The vectors of a list column as rows; those that are NULL or of another
    length are zero.  Columns of whole vectors are the Arrow values, reshaped."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    fits = lengths == width
    values = column.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, width)
    if fits.all():
        return values
    out = np.zeros((len(column), width))
    out[fits] = values
    return out


def best_rows(ids: pa.Array, vectors: np.ndarray, qids: list, queries: np.ndarray, k: int, kinds: tuple[pa.DataType, pa.DataType]) -> pa.RecordBatch:
    """(qid, item, score) of the k best of some items for every query."""
    scores = queries @ unit_rows(vectors).T
    by_id = np.empty(len(ids), np.int64)
    by_id[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
    rows, of = [], []
    for q, row in enumerate(scores):
        row = np.where(np.isnan(row), -np.inf, row)
        near = np.arange(len(row)) if len(row) <= k else np.flatnonzero(row >= np.partition(row, -k)[-k])
        top = near[np.lexsort((by_id[near], -row[near]))[:k]]
        rows.append(top)
        of += [q] * len(top)
    at, of = np.concatenate(rows), np.array(of)
    found = scores[of, at]
    return pa.RecordBatch.from_arrays(
        [pa.array([qids[q] for q in of], kinds[0]), ids.take(pa.array(at)), pa.array(found, mask=np.isnan(found))], ["qid", "item", "score"])


def _best_of_batches(batches: Iterator[pa.RecordBatch], shared, k: int, kinds: tuple[pa.DataType, pa.DataType]) -> Iterator[pa.RecordBatch]:
    qids, queries = shared.value
    for batch in batches:
        if batch.num_rows:
            yield best_rows(batch.column("item"), vectors_of(batch.column("v"), queries.shape[1]), qids, queries, k, kinds)


def top_k_cosine(items: DataFrame, id_col: str, vec_col: str, queries: DataFrame, qid_col: str,
                 qvec_col: str, k: int = 10) -> DataFrame:
    """For every query, the ``k`` items with the highest cosine similarity
    (ties: smaller item id first): (query id, rank, item id, score).  A vector
    that is NULL, zero or of another length has no score and comes last."""
    from pyspark.sql.pandas.types import to_arrow_type
    spark = items.sparkSession
    it = items.select(F.col(id_col).alias("item"), F.col(vec_col).cast("array<double>").alias("v"))
    qs = queries.select(F.col(qid_col).alias("qid"), F.col(qvec_col).cast("array<double>").alias("q")).where("q is not null")
    q_type, id_type = qs.schema["qid"].dataType, it.schema["item"].dataType
    kinds = (to_arrow_type(q_type), to_arrow_type(id_type))
    schema = f"qid {q_type.simpleString()}, item {id_type.simpleString()}, score double"
    out = spark.createDataFrame([], schema)
    chunk: list = []

    def flush() -> None:
        nonlocal out
        if chunk:
            shared = spark.sparkContext.broadcast(([r["qid"] for r in chunk], unit_rows(np.array([r["q"] for r in chunk], dtype=np.float64))))
            out = out.unionByName(it.mapInArrow(lambda batches: _best_of_batches(batches, shared, k, kinds), schema))
            chunk.clear()

    for r in qs.toLocalIterator():
        if len(chunk) == QUERY_CHUNK or (chunk and len(r["q"]) != len(chunk[0]["q"])):
            flush()
        chunk.append(r)
    flush()
    w = Window.partitionBy("qid").orderBy(F.col("score").desc_nulls_last(), F.col("item").asc())
    ranked = out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select(F.col("qid").alias(qid_col), "rank", F.col("item").alias(id_col), "score")
