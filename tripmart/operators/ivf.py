"""Approximate top-k cosine retrieval by an inverted file of cells (Q-17).

The index is a table of all vectors, partitioned by cell: the nearest of some
centroids, which are fitted on a bounded sample of the rows.  A query looks
into the cells whose centroids are nearest to it and scores their vectors
exactly; other partitions are not read.  With all cells probed the result is
that of ``top_k_cosine``.

A cell of many rows is many files, read by many tasks; every Arrow batch gives
at most k rows for each query that probes its cell, so nothing meets by cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.operators.similarity import QUERY_CHUNK, best_rows, unit_rows, vectors_of
from tripmart.sinks import tables

#: Rows that the centroids are fitted on, at most, and cells, at most.
SAMPLE_ROWS, MOST_CELLS = 50_000, 4096
ROUNDS = 10
#: The cell of vectors without a direction (NULL, zero, of another length); every query looks into it.
NO_CELL = -1
#: Share of the cells that a search probes unless told otherwise.  Vectors that hardly cluster need that
#: many for a recall of 0.9 (the test tables: 0.88 to 0.93 with half of the cells); clustered ones far fewer.
PROBED_SHARE = 0.6


def fit_centroids(vectors: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit vectors by spherical k-means, started from evenly
    spaced rows; a cell that loses all rows takes the row farthest from its own."""
    centroids = vectors[np.linspace(0, len(vectors) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        near = vectors @ centroids.T
        cell = near.argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, cell, vectors)
        empty = np.flatnonzero(np.bincount(cell, minlength=cells) == 0)
        sums[empty] = vectors[np.argsort(near.max(axis=1), kind="stable")[:len(empty)]]
        centroids = np.nan_to_num(unit_rows(sums))
    return centroids


def _cells_of(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    centroids = shared.value
    for batch in batches:
        near = unit_rows(vectors_of(batch.column("v"), centroids.shape[1])) @ centroids.T
        lost = np.isnan(near).any(axis=1)
        cell = np.where(lost, NO_CELL, np.where(np.isnan(near), -np.inf, near).argmax(axis=1))
        yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("v"), pa.array(cell.astype(np.int32))], ["item", "v", "cell"])


def build(items: DataFrame, id_col: str, vec_col: str, name: str, cells: int | None = None, sample_rows: int = SAMPLE_ROWS) -> None:
    """Store all rows as table ``name`` by cell, and the centroids as
    ``<name>__cells``.  Cells: about the square root of the number of rows, at
    most ``MOST_CELLS``.  The sample is chosen by a hash of the id, so the index
    does not depend on how the rows are stored.  The first sampled vector that isn't
    zero gives the length; others have no cell."""
    spark = items.sparkSession
    rows = items.select(F.col(id_col).alias("item"), F.col(vec_col).cast("array<double>").alias("v"))
    n = rows.count()
    share = min(1.0, sample_rows / max(n, 1))
    limit = int(share * ((1 << 31) - 1))
    chosen = rows.where(F.col("v").isNotNull() & (F.pmod(F.xxhash64("item"), F.lit(1 << 31)) <= limit)).orderBy(F.xxhash64("item"), "item").limit(sample_rows)
    found = [r["v"] for r in chosen.select("v").collect()]
    width = next((len(v) for v in found if any(v)), 1)
    sample = unit_rows(vectors_of(pa.array(found, pa.list_(pa.float64())), width)) if found else np.empty((0, width))
    sample = sample[~np.isnan(sample).any(axis=1)]
    count = min(len(sample), cells or min(MOST_CELLS, max(1, math.isqrt(n))))
    centroids = fit_centroids(sample, count) if count else np.zeros((1, width))
    shared = spark.sparkContext.broadcast(centroids)
    kind = rows.schema["item"].dataType.simpleString()
    placed = rows.mapInArrow(lambda it: _cells_of(it, shared), f"item {kind}, v array<double>, cell int")
    tables.write_replace(placed, name, ["cell"])
    tables.write_replace(spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centroids)], "cell int, centroid array<double>"), f"{name}__cells")


def _best_of_cells(batches: Iterator[pa.RecordBatch], shared, k: int, kinds) -> Iterator[pa.RecordBatch]:
    qids, queries, probes = shared.value
    for batch in batches:
        cells = batch.column("cell").to_numpy()
        for cell in np.unique(cells):
            asking = np.flatnonzero(probes[:, cell]) if cell != NO_CELL else np.arange(len(qids))
            part = batch.filter(pa.array(cells == cell))
            if len(asking):
                yield best_rows(part.column("item"), vectors_of(part.column("v"), queries.shape[1]), [qids[q] for q in asking], queries[asking], k, kinds)


def search(spark: SparkSession, name: str, queries: DataFrame, qid_col: str, qvec_col: str, k: int = 10, probes: int | None = None,
           exact: bool = False) -> DataFrame:
    """(query id, rank, item, score) of the ``k`` most similar rows of the
    index in the ``probes`` nearest cells (``PROBED_SHARE`` of them by default), or in all with ``exact``.  Queries
    are read in chunks; ties go to the smaller id; rows without a direction
    have no score and come last; a query of another length than the index's
    vectors, or NULL, has no answer."""
    from pyspark.sql.pandas.types import to_arrow_type
    stored = spark.table(name)
    centroids = np.array([r["centroid"] for r in spark.table(f"{name}__cells").orderBy("cell").collect()])
    qs = queries.select(F.col(qid_col).alias("qid"), F.col(qvec_col).cast("array<double>").alias("q")).where(F.size("q") == centroids.shape[1])
    kinds = tuple(to_arrow_type(t) for t in (qs.schema["qid"].dataType, stored.schema["item"].dataType))
    schema = f"qid {qs.schema['qid'].dataType.simpleString()}, item {stored.schema['item'].dataType.simpleString()}, score double"
    out = spark.createDataFrame([], schema)

    def flush(chunk: list) -> None:
        nonlocal out
        vectors = unit_rows(np.array([r["q"] for r in chunk], dtype=np.float64))
        near = np.nan_to_num(vectors @ centroids.T, nan=-np.inf)
        probed = np.zeros(near.shape, bool)
        n = near.shape[1] if exact else min(probes or math.ceil(PROBED_SHARE * near.shape[1]), near.shape[1])
        np.put_along_axis(probed, np.argsort(-near, axis=1, kind="stable")[:, :n], True, axis=1)
        cells = [NO_CELL, *np.flatnonzero(probed.any(axis=0)).tolist()]
        shared = spark.sparkContext.broadcast(([r["qid"] for r in chunk], vectors, probed))
        out = out.unionByName(stored.where(F.col("cell").isin(cells)).mapInArrow(lambda it: _best_of_cells(it, shared, k, kinds), schema))

    chunk: list = []
    for r in qs.toLocalIterator():
        chunk.append(r)
        if len(chunk) == QUERY_CHUNK:
            flush(chunk)
            chunk = []
    if chunk:
        flush(chunk)
    w = Window.partitionBy("qid").orderBy(F.col("score").desc_nulls_last(), F.col("item").asc())
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(F.col("qid").alias(qid_col), "rank", "item", "score")
