"""Connected components by contraction, as DataFrame jobs.

Each round every node points to the smallest (by a hash) of itself and its
neighbours, and edges are redrawn between the nodes pointed to.  A hash order
makes the graph shrink by a constant factor on average, a star in two rounds,
whatever its size.  Every round's result is written to the shared folder, so
lineage stays short and a lost executor costs a re-read.  Only row counts pass
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import materialize

MOST_ROUNDS = 100
#: Rows of a file, if they are short.
FILE_ROWS = 200_000


def stored(df: DataFrame, label: str, rows: int, file_rows: int = FILE_ROWS) -> DataFrame:
    """``df``, which has at most ``rows`` rows, written in one file for every
    ``file_rows`` of these, and one for each core at least, so that many
    shuffle partitions don't make many small files."""
    return materialize(df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // file_rows))), label)


def connected_components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """(node, component) of every node of an edge (its first two columns are
    the ends); the component is its smallest node.  Loops, repeated edges and
    edges with a NULL end change nothing; a node all of whose edges are loops
    is a component of its own.
    """
    a, b = edges.columns[:2]
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna()
    loops = pairs.where("a = b").select(F.col("a").alias("node")).distinct()
    level = materialize(pairs.where("a != b").distinct(), label)
    maps: list[DataFrame] = []
    most = nodes = 2 * level.count()
    while most:
        if len(maps) == MOST_ROUNDS:
            raise RuntimeError("the graph does not contract")
        seed = F.lit(len(maps) // 2)  # a new order now and then, so that no graph is bad for long
        ends = level.unionByName(level.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c, seed).alias("h"), F.col(c).alias("to"))
        best = ends.groupBy("a").agg(F.min(rank("b")).alias("best"))
        step = stored(best.select(F.col("a").alias("node"), F.least(rank("a"), F.col("best"))["to"].alias("to")), label, most)
        maps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        level = stored(level.join(left, "a").join(right, "b").where("to_a != to_b")
                       .select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).distinct(), label, most)
        most = 2 * level.count()
    if not maps:
        return loops.select("node", F.col("node").alias("component"))
    found = maps[-1]
    for step in reversed(maps[:-1]):
        later = found.select(F.col("node").alias("to"), F.col("to").alias("last"))
        found = step.join(later, "to", "left").select("node", F.coalesce("last", "to").alias("to"))
    found = stored(found, label, nodes)
    # Written, so that the join reads two plain shuffles and a large component can be split.
    names = stored(found.groupBy("to").agg(F.min("node").alias("component")), label, nodes)
    named = found.join(names, "to").select("node", "component")
    alone = loops.join(named.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
    return named.unionByName(alone)
