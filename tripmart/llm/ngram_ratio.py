"""Quality rules: text statistics and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed words and word pairs are counted: one over a
trusted target (rows a caller names), one over the whole raw corpus.  A
document's score is the mean, over its words and pairs, of the logarithm of
the two probabilities' ratio; it is kept from a fixed score on, so the verdict
on a document depends on nothing but the counts and the document.

Everything is a DataFrame expression.  Only the table of ``BUCKETS`` ratios
passes the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import let, let_all, runs_of, word_hashes, words_of

BUCKETS = 1 << 15
#: Documents with a lower mean log ratio are not kept.
THRESHOLD = -0.05
SMOOTHING = 1.0
#: A bucket seen r times in the corpus counts with the weight r / (r + RARE).
RARE = 100.0
#: The same for the target: the count that a bucket would have in it if the target were like the corpus.
RARE_TARGET = 30.0
SYMBOLS = "[#*$%&|<>]"


def repeated_words(hashes: Column, window: int = 3) -> Column:
    """Words that lie in a window of ``window`` words found twice or more."""
    def of(grams: Column) -> Column:
        return let(F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("p")))), covered)

    def covered(ordered: Column) -> Column:
        again = F.filter(ordered, lambda s, i: (s["g"] == F.get(ordered, i - 1)["g"]) | (s["g"] == F.get(ordered, i + 1)["g"]))
        starts = F.sort_array(F.transform(again, lambda s: s["p"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            starts, start,
            lambda a, p: F.struct((a["n"] + p + window - F.greatest(p, a["end"])).alias("n"), (p + window).alias("end")),
            lambda a: a["n"].cast("long"))

    return let(runs_of(hashes, window),
               lambda grams: F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long"))
               .otherwise(of(grams)))


def gram_buckets(hashes: Column, buckets: int) -> Column:
    """Bucket of every word and of every pair of neighbours."""
    return F.concat(F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int")),
                    F.transform(runs_of(hashes, 2), lambda h: F.pmod(h, F.lit(buckets)).cast("int")))


#: Bits of the map of trusted ids that spares other rows' texts the shuffle (8 MB).
MAP_BITS = 1 << 26
_BITMAP = 32_768


def with_mapped_id(rows: DataFrame, ids: DataFrame, id_col: str, map_bits: int = MAP_BITS) -> DataFrame:
    """The rows whose id has its bit in a bitmap of the hashed ``ids`` (one
    column): all rows with one of these ids and few others.  The map is
    broadcast; it has ``map_bits`` bits at most, whatever the number of ids."""
    spot = F.pmod(F.xxhash64(F.col(id_col)), F.lit(map_bits))
    part, place = F.floor(spot / _BITMAP), (spot % _BITMAP).cast("int")
    bits = ids.select(F.col(ids.columns[0]).alias(id_col)).groupBy(part.alias("map_part")).agg(
        F.bitmap_construct_agg(place).alias("map"))
    byte = F.conv(F.hex(F.substring(F.col("map"), F.floor(F.col("map_place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (rows.withColumn("map_part", part).withColumn("map_place", place).join(F.broadcast(bits), "map_part")
            .where(F.getbit(byte, F.col("map_place") % 8) == 1).drop("map_part", "map_place", "map"))


def bucket_counts(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id",
                  text_col: str = "text", most_trusted: int | None = None, map_bits: int = MAP_BITS) -> DataFrame:
    """(bucket, raw, target): n-grams of all documents and of the trusted ones.

    ``trusted`` has the ids in its first column; all of them are used unless
    the caller sets a bound, which takes the first by a hash.

    The raw counts come from one scan without a join.  For the target, a
    bounded bitmap lets the trusted rows and few others through, and a join on
    the ids decides; it is the same kind of join at every size, and moves about
    as much text as is trusted.
    """
    name = trusted.columns[0]
    ids = (trusted.select(F.col(name).alias("trusted_id")).where(F.col("trusted_id").isNotNull()).distinct())
    if most_trusted is not None:
        ids = ids.orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(most_trusted)
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    target = with_mapped_id(named, ids, "id", map_bits).join(ids.hint("merge"), F.col("id") == F.col("trusted_id")).select("text")

    def grams(rows: DataFrame, raw: int) -> DataFrame:
        every = F.explode(let(word_hashes(words_of(F.col("text"))), lambda h: gram_buckets(h, buckets)))
        return rows.select(every.alias("bucket"), F.lit(raw).cast("long").alias("raw"), F.lit(1 - raw).cast("long").alias("target"))
    return grams(named, 1).unionByName(grams(target, 0)).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING,
               rare: float = RARE, rare_target: float = 0.0) -> list[float]:
    """The log ratio of every bucket, drawn towards 0 for buckets hardly ever
    seen, or, with ``rare_target``, hardly ever to be expected in the target;
    the counts are at most ``buckets`` rows."""
    raw, target = [0] * buckets, [0] * buckets
    for r in counts.select("bucket", "raw", "target").toLocalIterator():
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    from_raw = sum(raw) + smoothing * buckets
    from_target = sum(target) + smoothing * buckets
    share = sum(target) / max(sum(raw), 1)

    def weight(r: int) -> float:
        expected = r * share
        return min(r / (r + rare), expected / (expected + rare_target) if expected else float(not rare_target))
    return [round((math.log((t + smoothing) / from_target) - math.log((r + smoothing) / from_raw)) * weight(r), 5)
            for r, t in zip(raw, target)]


def _array_of(values: list[float]) -> Column:
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def score_column(hashes: Column, ratios: list[float]) -> Column:
    """Mean log ratio of a text's words and pairs; 0 for a text without words."""
    table = _array_of(ratios)
    return let(gram_buckets(hashes, len(ratios)), lambda b: F.when(F.size(b) == 0, F.lit(0.0)).otherwise(
        F.aggregate(b, F.lit(0.0), lambda a, x: a + F.get(table, x)) / F.size(b)))


def line_repeats(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def judge(docs: DataFrame, ratios: list[float], threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``id``, the statistics, ``base_failed``, ``llr`` and ``kept`` of every row.

    A NULL or empty text has no words, so it fails the base rules; NULL ids and
    repeated rows are judged like others; other columns are not read.
    """
    text = F.col("text")
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    words = words_of(text)
    found = let_all({"words": words, "hashes": word_hashes(words)}, lambda w: F.struct(
        F.size(w["words"]).cast("long").alias("n_words"),
        F.char_length(F.array_join(w["words"], "")).cast("long").alias("word_chars"),
        let(w["hashes"], repeated_words).alias("n_repeat_words"),
        let(w["hashes"], lambda h: score_column(h, ratios)).alias("llr")))
    plain = F.coalesce(text, F.lit(""))
    rows = named.select("id", found.alias("f"),
                        (F.char_length(plain) - F.char_length(F.regexp_replace(plain, SYMBOLS + "+", ""))).cast("long").alias("n_symbols"),
                        line_repeats(text).alias("n_dup_lines"))
    failed = (F.col("f.n_words") < 50) | (100 * F.col("f.n_repeat_words") > 50 * F.col("f.n_words"))
    return rows.select("id", "f.n_words", "f.word_chars", "n_symbols", "n_dup_lines", "f.n_repeat_words",
                       failed.alias("base_failed"), (~failed & (F.col("f.llr") >= threshold)).alias("kept"), F.col("f.llr"))


def filter_by_ratio(spark: SparkSession, docs: DataFrame, trusted: DataFrame, **options) -> DataFrame:
    """Count, weigh and judge all documents."""
    return judge(docs, log_ratios(bucket_counts(docs, trusted), rare_target=RARE_TARGET), **options)
