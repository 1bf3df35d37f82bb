import random
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripmart.llm import prob_minhash as pm


def definition(a, b):
    """Probability Jaccard likeness straight from its definition."""
    a, b = dict(zip(a[0].tolist(), a[1])), dict(zip(b[0].tolist(), b[1]))
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys()) for d in a.keys() & b.keys())


def weighted(rnd, n):
    return (np.array(sorted(rnd.sample(range(40), n)), np.uint64), np.array([float(rnd.randint(1, 5)) for _ in range(n)]))


def test_exact_likeness_is_the_definition():
    rnd = random.Random(1)
    for _ in range(200):
        a, b = weighted(rnd, rnd.randint(1, 25)), weighted(rnd, rnd.randint(1, 25))
        assert pm.likeness(a, b) == pytest.approx(definition(a, b))
    assert pm.likeness(a, a) == pytest.approx(1.0)


def test_registers_agree_with_that_probability():
    rnd = random.Random(2)
    base = pm.mixed(np.arange(40, dtype=np.uint64))
    for _ in range(4):
        a, b = weighted(rnd, 20), weighted(rnd, 25)
        docs = []
        for k in range(150):  # other elements each time, so that the sketches are independent
            docs += [(pm.mixed(base[s[0].astype(int)] + np.uint64(k)), s[1]) for s in (a, b)]
        values = pm.sketch_all(docs)
        assert (values[0::2] == values[1::2]).mean() == pytest.approx(definition(a, b), abs=0.02)


def brute_classes(rows):
    """Class of each row index by all pairs."""
    sets = [pm.shingles(pm.words_of(t)) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in combinations(range(len(rows)), 2):
        if pm.words_of(rows[i][1]) == pm.words_of(rows[j][1]) or pm.likeness(sets[i], sets[j]) >= pm.THRESHOLD:
            root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(rows))]


def expected(rows):
    roots = brute_classes(rows)
    smallest = {}
    for (i, _), r in zip(rows, roots):
        smallest[r] = min([x for x in (smallest.get(r), i) if x is not None], default=None)
    return sorted(((i, smallest[r]) for (i, _), r in zip(rows, roots)), key=str)


def families(seed=4):
    """Copies, chains of small edits whose ends are not alike, and siblings of a base that is missing."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    rows, n = [], 0
    for f in range(12):
        text = rnd.choices(words, k=rnd.choice([30, 120, 400]))
        start = list(text)
        for _ in range(rnd.choice([1, 2, 6, 14])):
            rows.append((n, " ".join(text)))
            n += 1
            text = list(text if f % 2 else start)
            for _ in range(max(1, len(text) // 60)):
                text[rnd.randrange(len(text))] = rnd.choice(words)
        rows += [(n + k, rows[-1][1]) for k in range(3)]
        n += 3
    return rows


def test_classes_against_all_pairs(spark):
    rows = families()
    got = pm.classes(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted(((r.id, r.class_id) for r in got), key=str) == expected(rows)
    assert len({r.class_id for r in got}) < len({t for _, t in rows})


@pytest.mark.parametrize("bound", ["BLOCK", "BLOCK_BYTES"])
def test_blocks_find_what_pivots_leave(spark, monkeypatch, bound):
    """Without pivots every pair of a bucket is met in the blocks, whatever their number."""
    monkeypatch.setattr(pm, "_pivot_pairs", lambda members: members.select(F.col("key").alias("a"), F.col("key").alias("b")))
    monkeypatch.setattr(pm, bound, 3 if bound == "BLOCK" else 3000)
    rows = families(9)
    got = pm.classes(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.id, r.class_id) for r in got), key=str) == expected(rows)


def test_odd_documents(spark, odd_docs, no_docs):
    got = pm.classes(spark, odd_docs).collect()
    assert sorted(((r.id, r.class_id) for r in got), key=str) == expected([(r.doc_id, r.text) for r in odd_docs.collect()])
    kept = pm.keep_one(spark, odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 5, 6, 7, 8, None], key=str)
    assert pm.classes(spark, no_docs).count() == 0 and pm.keep_one(spark, no_docs).count() == 0


def test_repeated_ids_with_different_texts(spark):
    long = " ".join(f"v{i}" for i in range(100))
    rows = [(1, long), (1, "other words"), (2, long + " end"), (None, long), (None, "lonely"), (3, "other words")]
    got = pm.classes(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.id, r.class_id) for r in got), key=str) == expected(rows)


def test_one_row_of_every_class_without_ids(spark):
    rows = [(None, "a b"), (None, "a  b"), (None, "c"), (None, "d"), (4, "d"), (5, "e")]
    kept = pm.keep_one(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, " ".join(r.text.split())) for r in kept), key=str) == [(4, "d"), (5, "e"), (None, "a b"), (None, "c")]


def exact_definition(a, b):
    a, b = ({e: int(x) for e, x in zip(s[0].tolist(), s[1])} for s in (a, b))
    return sum(1 / sum(max(Fraction(a.get(e, 0), a[d]), Fraction(b.get(e, 0), b[d])) for e in a.keys() | b.keys()) for d in a.keys() & b.keys())


def test_exact_likeness_without_rounding():
    rnd = random.Random(5)
    for _ in range(100):
        a, b = weighted(rnd, rnd.randint(1, 25)), weighted(rnd, rnd.randint(1, 25))
        assert pm.exact_likeness(a, b) == exact_definition(a, b)
        assert pm.alike(a, b) == (exact_definition(a, b) >= Fraction(4, 5))


def pair_at_threshold(k, name):
    """Two texts with 4k common ones of 5k shingles, and a third with one common shingle less."""
    words = [f"{name}{i}" for i in range(5 * k + 4)]
    return " ".join(words), " ".join(words[:4 * k + 4]), " ".join(words[:4 * k + 3])


def test_pairs_at_the_threshold_are_alike():
    for k in range(1, 200):
        whole, at, under = (pm.shingles(pm.words_of(t)) for t in pair_at_threshold(k, "w"))
        assert pm.alike(whole, at) and pm.alike(at, whole) and not pm.alike(whole, under) and not pm.alike(under, whole)
    twice = [(s[0], s[1] * 2) for s in map(pm.shingles, map(pm.words_of, pair_at_threshold(3, "w")))]
    assert pm.alike(*twice[:2]) and not pm.alike(twice[0], twice[2])


@pytest.mark.parametrize("pivots", [True, False])
def test_classes_of_pairs_at_the_threshold(spark, monkeypatch, pivots):
    """On both ways that pairs are compared, those whose rounded sum is under 0.8."""
    if not pivots:
        monkeypatch.setattr(pm, "_pivot_pairs", lambda members: members.select(F.col("key").alias("a"), F.col("key").alias("b")))
    sizes = [k for k in range(1, 100) if pm.likeness(*(pm.shingles(pm.words_of(t)) for t in pair_at_threshold(k, "w")[:2])) < pm.THRESHOLD]
    rows = [(2 * k + i, pair_at_threshold(k, f"n{k}w")[i]) for k in sizes for i in (0, 1)]
    got = pm.classes(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(sizes) > 20 and {(r.id, r.class_id) for r in got} == {(i, i // 2 * 2) for i, _ in rows}


def test_keep_one_of_repeated_ids_with_different_texts(spark):
    """Every class keeps one row, whatever ids its texts share with others."""
    long = " ".join(f"v{i}" for i in range(100))
    rows = [(1, long, "p"), (1, "other words", "p"), (2, long + " end", "p"), (3, "other words", "p"), (1, "other  words", "q"),
            (5, "more", "p"), (5, "words", "p"), (None, "more", "p")]
    results = []
    for data in (rows, rows[::-1]):
        docs = spark.createDataFrame(data, "doc_id long, text string, source string")
        results.append(sorted(tuple(r) for r in pm.keep_one(spark, docs.repartition(4)).collect()))
    assert results[0] == results[1]
    assert [(i, " ".join(t.split())) for i, t, _ in results[0]] == sorted([(1, long), (1, "other words"), (5, "more"), (5, "words")])


def test_candidate_pairs_of_a_block_take_few_bytes(monkeypatch):
    import tracemalloc
    monkeypatch.setattr(pm, "alike", lambda a, b: False)
    monkeypatch.setattr(pm, "shingles", lambda words: ())
    n = 500
    keys = [b"%04d" % i for i in range(n)]
    sketch = np.arange(pm.REGISTERS, dtype="<u2").tobytes()
    table = pa.table({"band": pa.array([0] * n), "side": pa.array([0] * n), "key": pa.array(keys, pa.binary()),
                      "component": pa.array(keys, pa.binary()), "bands": pa.array([[1] * 20] * n, pa.list_(pa.int64())),
                      "sketch": pa.array([sketch] * n, pa.binary()), "text": pa.array(["some text"] * n)})
    tracemalloc.start()
    try:
        assert pm._block_links(table).num_rows == 0
        assert tracemalloc.get_traced_memory()[1] < 50 * n * (n - 1) / 2
    finally:
        tracemalloc.stop()


def test_likeliest_pairs_of_a_block_come_first(monkeypatch):
    seen = []
    monkeypatch.setattr(pm, "alike", lambda a, b: seen.append((a, b)) or False)
    monkeypatch.setattr(pm, "shingles", lambda words: words[0])
    sketches = np.tile(np.arange(pm.REGISTERS, dtype="<u2"), (3, 1))
    sketches[0, :10] += 1000
    keys = [b"0", b"1", b"2"]
    table = pa.table({"band": [0] * 3, "side": [0] * 3, "key": pa.array(keys, pa.binary()), "component": pa.array(keys, pa.binary()),
                      "bands": pa.array([[1] * 20] * 3, pa.list_(pa.int64())),
                      "sketch": pa.array([x.tobytes() for x in sketches], pa.binary()), "text": ["a", "b", "c"]})
    pm._block_links(table)
    assert seen == [(b"b", b"c"), (b"a", b"b"), (b"a", b"c")]


def test_small_frames_are_stored_in_few_files(spark, monkeypatch):
    from tripmart.llm import components
    frames, real = [], components.materialize

    def kept(df, label="stage"):
        frames.append(real(df, label))
        return frames[-1]
    monkeypatch.setattr(components, "materialize", kept)
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        edges = spark.range(400).selectExpr("id as a", "id + 1000 as b")
        assert components.connected_components(edges).where("component = least(node, node - 1000) or component = node").count() == 800
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    most = spark.sparkContext.defaultParallelism
    assert most < 64 and all(len(f.inputFiles()) <= most + 1 for f in frames[1:])
