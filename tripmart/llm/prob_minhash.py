"""Near-duplicate detection by ProbMinHash sketches of weighted shingles.

A document is its five-word shingles, weighted by how often each occurs (a text
of fewer words is one shingle).  Every shingle is a Poisson process with its
weight as rate; an arrival falls into one of REGISTERS registers, and a
register keeps the shingle that arrived first.  Two registers agree with the
probability Jaccard likeness of the documents.  Arrivals later than the last
register's first one change nothing, so a shingle's process ends there, which
for most shingles is after one arrival.

Banding: ROWS registers make a band, and documents that share a band are
candidates.  Texts of equal words are one candidate.  In a band's bucket all
are compared with the most central member; what the bucket then still holds of
several components is compared in blocks, first by sketches, then by texts.  So
every pair that shares a band is compared or in one component already, and no
rows are made for all pairs of a bucket.  A pair counts if its exact
probability Jaccard likeness is at least THRESHOLD; classes are the connected
components of such pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tripmart.llm.common import materialize, text_slices
from tripmart.llm.components import connected_components, stored

SHINGLE = 5
REGISTERS, ROWS = 80, 4
THRESHOLD = 0.8
#: Sums of rounded terms nearer to the threshold than this are decided exactly.
ROUNDING = 1e-9
#: Sketches of pairs at the threshold agree less than this once in some 100,000 pairs.
LEAST_AGREEMENT = 0.6
#: Documents and bytes of text of a block.
BLOCK, BLOCK_BYTES = 1024, 8 << 20
#: Documents of a stored file of sketches or of places in buckets.
FILE_DOCS = 20_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values (xor-shifts and odd factors)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


FACTORS = mixed(np.arange(1, SHINGLE + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def key_of(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def shingles(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in ascending order, and their weights."""
    if not words:
        return np.array([], np.uint64), np.array([], np.float64)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(w) for w in words], dtype=np.uint64)
    size = min(SHINGLE, len(h))
    total = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        total += h[k:len(h) - size + 1 + k] * FACTORS[k]
    found, counts = np.unique(mixed(total + np.uint64(size)), return_counts=True)
    return found, counts.astype(np.float64)


def sketch_all(docs: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """The register values (shingle hashes) of documents with at least one shingle, all at once."""
    doc = np.repeat(np.arange(len(docs)), [len(s) for s, _ in docs])
    element = np.concatenate([s for s, _ in docs])
    weight = np.concatenate([w for _, w in docs])
    first = np.full(len(docs) * registers, np.inf)
    value = np.zeros(len(docs) * registers, np.uint64)
    time = np.zeros(len(element))
    salt = element.copy()
    while len(element):
        salt = salt + GOLDEN
        random = mixed(salt)
        time = time - np.log(((random >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weight
        slot = doc * registers + (mixed(random) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, slot, time)
        won = time <= first[slot]
        value[slot[won]] = element[won]
        last = first.reshape(-1, registers).max(axis=1)
        going = time < last[doc]
        doc, element, salt, weight, time = doc[going], element[going], salt[going], weight[going], time[going]
    return value.reshape(-1, registers)


def bands_of(values: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A hash of each band's registers, different from band to band."""
    n, registers = values.shape
    parts = values.reshape(n, registers // rows, rows)
    total = np.broadcast_to(mixed(np.arange(1, registers // rows + 1, dtype=np.uint64) * GOLDEN), parts.shape[:2]).copy()
    for k in range(rows):
        total = mixed(total * FACTORS[0] + parts[:, :, k])
    return total.view(np.int64)


def _common_terms(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """For each common shingle d, by a(d) / b(d): a(d), b(d), the weights of a
    that count in its term's sum over a(d), and those of b over b(d)."""
    _, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    wa, wb = a[1][at_a], b[1][at_b]
    order = np.argsort(wa / wb, kind="stable")
    wa, wb = wa[order], wb[order]
    from_here = np.cumsum(wa[::-1])[::-1]
    before = np.cumsum(wb) - wb
    only_a, only_b = a[1].sum() - wa.sum(), b[1].sum() - wb.sum()
    return wa, wb, from_here + only_a, before + only_b


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard likeness of two weighted shingle sets: the sum over
    common shingles d of 1 / sum over all e of max(a(e)/a(d), b(e)/b(d))."""
    wa, wb, of_a, of_b = _common_terms(a, b)
    return float((1 / (of_a / wa + of_b / wb)).sum())


def exact_likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> Fraction:
    """As ``likeness``, without rounding; weights are counts.  Shingles of equal
    weights have equal terms, so there are few different ones."""
    wa, wb, of_a, of_b = (x.astype(np.int64) for x in _common_terms(a, b))
    terms, times = np.unique(np.stack([wa * wb, of_a * wb + of_b * wa]), axis=1, return_counts=True)
    return sum((Fraction(n * x, y) for x, y, n in zip(*terms.tolist(), times.tolist())), Fraction(0))


def alike(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> bool:
    """Whether the likeness is THRESHOLD or more, a likeness of just THRESHOLD included."""
    near = likeness(a, b) - THRESHOLD
    return near > 0 if abs(near) > ROUNDING else exact_likeness(a, b) >= Fraction(str(THRESHOLD))


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        words = [words_of(t) for t in batch.column("text").to_pylist()]
        keys = [key_of(w) for w in words]
        sets = [shingles(w) for w in words]
        full = [i for i, s in enumerate(sets) if len(s[0])]
        bands: list = [[] for _ in words]
        sketches: list = [b""] * len(words)
        if full:
            values = sketch_all([sets[i] for i in full])
            short = (mixed(values) >> np.uint64(48)).astype("<u2")
            for i, band, sketch in zip(full, bands_of(values).tolist(), short):
                bands[i], sketches[i] = band, sketch.tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
            ["id", "key", "bands", "sketch"])


def _compare_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) of pairs of texts that are alike enough."""
    held: tuple[str | None, tuple] = (None, ())
    for batch in batches:
        good = []
        for text, other in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
            if held[0] != other:  # the pairs of a pivot mostly come one after another
                held = (other, shingles(words_of(other)))
            good.append(alike(shingles(words_of(text)), held[1]))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _block_links(table: pa.Table) -> pa.Table:
    """Links between two blocks of a bucket (or within one), enough to join all
    components that the blocks' pairs can join.

    A pair is looked at in the first bucket that it shares.  The likeliest
    pairs by their sketches come first, and a pair whose components are joined
    by then isn't compared any more.
    """
    def part(side: int):
        rows = table.filter(pc.equal(table["side"], side)).sort_by("key")
        sketches = np.frombuffer(b"".join(rows["sketch"].to_pylist()), "<u2").reshape(-1, REGISTERS)
        bands = rows["bands"].combine_chunks().values.to_numpy().reshape(len(rows), -1) if len(rows) else None
        return rows["key"].to_pylist(), rows["component"].to_pylist(), rows["text"].to_pylist(), sketches, bands
    first, second = part(0), part(1)
    within = not second[0]
    second = first if within else second
    before = table["band"][0].as_py()
    root: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while root.get(x, x) != x:
            x = root[x]
        return x
    # Only the numbers of candidate pairs are held, a few bytes a pair, for there may be some for all rows of both blocks.
    names = {c: n for n, c in enumerate(sorted({*first[1], *second[1]}))}
    component = [np.array([names[c] for c in side[1]], np.int32) for side in (first, second)]
    likely: list[np.ndarray] = []
    agreeing: list[np.ndarray] = []
    for i in range(len(first[0])):
        agreement = (second[3] == first[3][i]).mean(axis=1)
        good = agreement >= LEAST_AGREEMENT
        if before:
            good &= ~(second[4][:, :before] == first[4][i, :before]).any(axis=1)
        if within:
            good[:i + 1] = False
        j = np.flatnonzero(good & (component[1] != component[0][i]))
        likely.append(np.stack([np.full(len(j), i), j]).astype(np.int32))
        agreeing.append(agreement[j].astype(np.float32))
    pairs = np.concatenate([np.zeros((2, 0), np.int32), *likely], axis=1)
    pairs = pairs[:, np.argsort(-np.concatenate([np.zeros(0, np.float32), *agreeing]), kind="stable")]
    del likely, agreeing
    sets: dict[bytes, tuple] = {}

    def shingles_of(side, k: int):
        if side[0][k] not in sets:
            sets[side[0][k]] = shingles(words_of(side[2][k]))
        return sets[side[0][k]]
    links = []
    for i, j in zip(*map(np.nditer, pairs)) if pairs.size else ():
        i, j = int(i), int(j)
        x, y = find(first[1][i]), find(second[1][j])
        if x != y and alike(shingles_of(first, i), shingles_of(second, j)):
            root[max(x, y)] = min(x, y)
            links.append((first[0][i], second[0][j]))
    a, b = zip(*links) if links else ((), ())
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, bands, sketch) of every row; the key is a hash of the words."""
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = named.schema["id"].dataType.simpleString()
    return named.mapInArrow(_sketch_batches, f"id {kind}, key binary, bands array<bigint>, sketch binary")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are alike enough, by their texts."""
    a = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    return (pairs.where("a != b").distinct().join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
            .mapInArrow(_compare_batches, "a binary, b binary"))


def _stored_groups(grouped: DataFrame, docs: int | None = None) -> DataFrame:
    """A grouped frame over all documents' buckets, written, so that a join with it reads two plain
    shuffles: adaptive execution splits a hot key of such a join, but not one
    whose other side is an aggregate over the same shuffle."""
    return materialize(grouped, "groups") if docs is None else stored(grouped, "groups", docs, FILE_DOCS)


def _pivot_pairs(members: DataFrame) -> DataFrame:
    """Every member of a bucket with the bucket's most central one."""
    top = _stored_groups(members.groupBy("bucket").agg(F.max(F.struct("weight", "key")).alias("top")))
    return members.join(top, "bucket").select(F.col("key").alias("a"), F.col("top.key").alias("b"))


def _components(links: DataFrame, docs: int) -> DataFrame:
    """(key, component) of the linked keys."""
    return stored(connected_components(links, "near").select(F.col("node").alias("key"), "component"), "near", docs, FILE_DOCS)


def _open_members(members: DataFrame, component: DataFrame, docs: int) -> DataFrame:
    """Members with their component, in the buckets that hold more than one component."""
    rows = members.join(component, "key", "left").select("band", "bucket", "key", F.coalesce("component", "key").alias("component"))
    open_ = rows.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi")
    return rows.join(_stored_groups(open_.select("bucket"), docs), "bucket")


def _rest(rows: DataFrame, copies: DataFrame, texts: DataFrame, docs: int) -> DataFrame:
    """Links (a, b) between the components that still meet in a bucket.

    A bucket is dealt into blocks, bounded in rows and in text; a block meets
    itself (side 0 alone) and every other block once, as side 0 the later
    ones, as side 1 the earlier ones.
    """
    rows = stored(rows.join(texts.select("key", F.octet_length("text").alias("size")), "key"), "open", docs, FILE_DOCS)
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") / BLOCK_BYTES)).cast("int")
    dealt = rows.drop("size").join(_stored_groups(rows.groupBy("bucket").agg(blocks.alias("blocks")), docs), "bucket") \
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    met = dealt.select("band", "bucket", "key", "component", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least(F.col("block"), o).alias("i"), F.greatest(F.col("block"), o).alias("j"),
                           (o < F.col("block")).cast("int").alias("side")))).alias("meet"))
    full = met.join(copies.select("key", "bands", "sketch"), "key").join(texts, "key")
    return (full.select("band", "bucket", "meet.i", "meet.j", "meet.side", "key", "component", "bands", "sketch", "text")
            .groupBy("bucket", "i", "j").applyInArrow(_block_links, "a binary, b binary"))


def classes(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, copy_id, class_id) of every row: the smallest id with the same words,
    and the smallest id of the near-duplicate class.

    NULL and empty texts have no words and are copies of each other.  Repeated
    rows are copies; a NULL id is never the smallest, and a class of NULL ids
    only has a NULL class; an empty table has no rows; other columns are not read.
    """
    every, joined = _keyed_components(spark, docs, id_col, text_col)
    smallest = _stored_groups(joined.groupBy("component").agg(F.min("copy_id").alias("class_id")), joined.count())
    return every.select("id", "key").join(joined.join(smallest, "component"), "key").select("id", "copy_id", "class_id")


def _keyed_components(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The sketches of all rows; (key, copy_id, component) of all words' hashes."""
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    every = materialize(sketches(named, "id", "text"), "sketches")
    n = every.count()
    copies = stored(every.groupBy("key").agg(F.min("id").alias("copy_id"), F.first("bands").alias("bands"),
                                             F.first("sketch").alias("sketch")), "copies", n, FILE_DOCS)
    exploded = copies.select("key", F.posexplode("bands").alias("band", "bucket"))
    shared = _stored_groups(exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), n)
    members = stored(exploded.join(shared, "bucket").select("band", "bucket", "key", "n"), "members", n, FILE_DOCS)
    central = stored(members.groupBy("key").agg(F.sum("n").alias("weight")), "central", n, FILE_DOCS)
    members = members.join(central, "key").select("band", "bucket", "key", "weight")
    # One text for each set of words that shares a bucket; the words' hash finds it among repeated ids.
    wanted = copies.join(central, "key").select("key", F.col("copy_id").alias("id"))
    texts = materialize(_texts(named, wanted), "texts")
    links = materialize(_verified(_pivot_pairs(members), texts), "links")
    component = _components(links, n)
    more = materialize(_rest(_open_members(members, component, n), copies, texts, n), "links")
    if not more.isEmpty():
        component = _components(links.unionByName(more), n)
    joined = copies.select("key", "copy_id").join(component, "key", "left").withColumn("component", F.coalesce("component", "key"))
    return every, stored(joined, "classes", n, FILE_DOCS)


def _texts(named: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, text) of the wanted keys."""
    picked = named.join(wanted.select(F.col("id").alias("wanted_id"), F.col("key").alias("wanted")),
                        F.col("id").eqNullSafe(F.col("wanted_id"))).select("text", "wanted")

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # An id may be repeated with other texts: only the text with the wanted words stays.
        for batch in text_slices(batches, "text"):
            keys = batch.column("wanted").to_pylist()
            good = [key_of(words_of(t)) == k
                    for t, k in zip(batch.column("text").to_pylist(), keys)]
            yield pa.RecordBatch.from_arrays([batch.column("wanted"), batch.column("text")], ["key", "text"]).filter(pa.array(good, pa.bool_()))
    return picked.mapInArrow(hold, "key binary, text string").groupBy("key").agg(F.first("text").alias("text"))


def keep_one(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, one of each class: that with the smallest id, NULL
    ids last, and of equal ids the smallest hash of the words.  Texts of other
    classes under the same id stay as well; of rows with the same id and words
    that with the smallest hash of its columns stays.
    """
    _, joined = _keyed_components(spark, docs, id_col, text_col)
    first = joined.groupBy("component").agg(F.min(F.struct(F.col("copy_id").isNull(), F.col("copy_id").alias("id"), "key")).alias("first"))
    kept = first.select(F.struct("first.id", "first.key").alias("kept"))
    unused = "_" * max(map(len, docs.columns))
    key, mark, row = "words_key_" + unused, "mark_" + unused, "row_" + unused

    def with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_col):
            yield batch.append_column(key, pa.array([key_of(words_of(t)) for t in batch.column(text_col).to_pylist()], pa.binary()))
    keyed = docs.mapInArrow(with_key, StructType([*docs.schema.fields, StructField(key, BinaryType())]))
    marked = keyed.withColumn(mark, F.struct(F.col(id_col).alias("id"), F.col(key).alias("key"))).drop(key)
    # The id and the words' hash are one column, so that the join's partitions are those of the groups, and NULL ids meet.
    rows = marked.join(kept, F.col(mark) == F.col("kept"), "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return rows.groupBy(mark).agg(F.min_by(whole, F.sha2(F.to_json(whole), 256)).alias(row)).select(f"{row}.*")
