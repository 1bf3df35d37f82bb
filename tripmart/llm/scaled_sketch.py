"""Document fingerprints: threshold-scaled sketches of word shingles.

Every five-word shingle is hashed to 64 bits and kept if the hash lies below a
fixed fraction of the range.  Whether a shingle is kept depends on itself
alone, so sketches of any two texts can be compared, and the union of two
sketches is the sketch of both texts together, however unequal they are.  The
share of one sketch that is in another estimates containment, the share of
common hashes likeness (Jaccard).

A text of fewer than five words has one shingle of all its words.  A hash of
the whole word sequence goes with the sketch: equal texts are recognised even
if they are too short to have a kept shingle.  DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import let, materialize, runs_of, word_hashes, words_of

SHINGLE = 5
#: One shingle in so many is kept.
SCALE = 8


def sketch(text: Column, scale: int = SCALE) -> Column:
    """Struct (whole, kept): hash of all words, and the sorted distinct kept shingle hashes."""
    below = F.lit(-(1 << 63) + (1 << 64) // scale)

    def of(h: Column) -> Column:
        whole = F.xxhash64(h)
        shingles = F.when(F.size(h) >= SHINGLE, runs_of(h, SHINGLE)).when(F.size(h) == 0, F.array().cast("array<bigint>")) \
            .otherwise(F.array(whole))
        return F.struct(whole.alias("whole"),
                        F.sort_array(F.array_distinct(F.filter(shingles, lambda x: x < below))).alias("kept"))
    return let(word_hashes(words_of(text)), of)


def merged(a: Column, b: Column) -> Column:
    """Kept hashes of two texts together."""
    return F.sort_array(F.array_union(a["kept"], b["kept"]))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two sketches; 1 for equal word sequences,
    0 if they differ and neither has a kept shingle."""
    either = F.size(F.array_union(a["kept"], b["kept"]))
    return F.when(a["whole"] == b["whole"], F.lit(1.0)).when(either == 0, F.lit(0.0)) \
        .otherwise(F.size(F.array_intersect(a["kept"], b["kept"])) / either)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that are in ``b``."""
    n = F.size(a["kept"])
    return F.when(a["whole"] == b["whole"], F.lit(1.0)).when(n == 0, F.lit(0.0)) \
        .otherwise(F.size(F.array_intersect(a["kept"], b["kept"])) / n)


def as_text(s: Column) -> Column:
    """A sketch as a string: the whole hash, a colon, the kept hashes."""
    return F.concat(F.lpad(F.hex(s["whole"]), 16, "0"), F.lit(":"),
                    F.array_join(F.transform(s["kept"], lambda x: F.hex(x)), ","))


def sketches(docs: DataFrame, scale: int = SCALE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``sketch`` of every row (NULL text: as the empty text)."""
    return docs.select(F.col(id_col).alias("id"), sketch(F.col(text_col), scale).alias("sketch"))


def following(keys: DataFrame) -> DataFrame:
    """For each distinct (k, half): the (k, half) of the next larger key; the largest is followed by the smallest.

    The keys are sorted into ranges; neighbours are found within a range, and
    the range's last row takes the first of the range after it.  Only one row
    per range meets in one task.
    """
    ranged = materialize(keys.repartitionByRange("k").select(
        F.spark_partition_id().alias("part"), F.struct("k", "half").alias("own")), "keys")
    firsts = ranged.groupBy("part").agg(F.min("own").alias("first"))
    by_part = Window.orderBy("part")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select(F.col("part").alias("of_part"), F.coalesce(
        F.lead("first").over(by_part), F.first("first").over(whole)).alias("after"))
    inside = ranged.withColumn("up", F.lead("own").over(Window.partitionBy("part").orderBy("own")))
    return (inside.join(F.broadcast(after), F.col("part") == F.col("of_part"))
            .select(F.col("own.k").alias("k"), F.coalesce("up", "after").alias("up"))
            .select("k", F.col("up.k").alias("up_k"), F.col("up.half").alias("up_half")))


def compare_with_edits(spark: SparkSession, docs: DataFrame, scale: int = SCALE, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Each row's sketch, that of its edited text and that of the next document.

    The next document is the one with the next smaller id, after the smallest
    the largest; the edited text has the last floor(n/2) code points replaced
    by as many first ones of the next text (or all it has).  A NULL text is
    empty; NULL is the smallest id; of rows with equal ids the smallest text is
    the neighbour; a lone document is its own; extra columns are not read.
    """
    # A struct of the id is equal to itself even if the id is NULL, so plain joins and groupings by it share a shuffle.
    named = docs.select(F.struct(F.col(id_col).alias("id")).alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    # To each document: who needs it as its next document, and how much of it.
    needed = following(named.groupBy("k").agg(F.max(half).alias("half")))
    lent = (named.join(needed, "k")
            .select("up_k", F.substring("text", F.lit(1), F.col("up_half")).alias("lead"), sketch(F.col("text"), scale).alias("next"))
            .groupBy("up_k").agg(F.min(F.struct("lead", "next")).alias("lent")))
    n = F.char_length("text")
    joined = named.join(lent, F.col("k") == F.col("up_k"))
    edited = F.concat(F.substring("text", F.lit(1), n - F.floor(n / 2).cast("int")),
                      F.substring("lent.lead", F.lit(1), F.floor(n / 2).cast("int")))
    return (joined.select("k.id", n.cast("long").alias("n_chars"), sketch(F.col("text"), scale).alias("own"),
                          edited.alias("edited_text"), F.col("lent.next").alias("next"))
            .withColumn("edited", sketch(F.col("edited_text"), scale)))
