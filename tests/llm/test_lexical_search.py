"""The Best Position Algorithm against scoring every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from tripmart.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return [re.sub("[A-Z]", lambda c: c[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    """Rows by scoring every document for every item."""
    terms = [(i, words(t)) for i, t in docs]
    n_docs, total = sum(bool(t) for _, t in terms), sum(len(t) for _, t in terms)
    with_term = Counter(w for _, t in terms for w in set(t))
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(words(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc, t in terms:
            counts, score = Counter(t), 0
            for w in wanted & counts.keys():
                m = 10 + 90 * len(t) * n_docs // total
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * with_term[w] + 1)))
                score += weight * (10 ** 9 * counts[w] // (1000 * counts[w] + 8 * m))
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def rows(frame):
    return sorted(map(tuple, frame.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("shard,terms", [(10 ** 6, 10 ** 6), (500, 40), (1, 1)])
def test_as_brute_force(spark, some_docs, shard, terms):
    docs = [tuple(r) for r in some_docs.select("doc_id", "text").collect()]
    items = [(i, t[:300]) for i, t in docs[:12]] + [(3, docs[50][1]), (99, "zz no-such")]
    got = lexical_search.search(spark, some_docs, spark.createDataFrame(items, "item_id long, text string"), 10, terms, shard)
    assert rows(got) == brute(docs, items, 10)


def test_odd_rows(spark, odd_docs, no_docs):
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    items = [(1, "A b no, here"), (1, "x"), (None, "漢字 W7 w8"), (None, "spaces"), (2, None), (3, ""), (4, "--"), (5, "a a a"), (5, "a a a")]
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc_id", "'x' as rank")
    assert rows(lexical_search.search(spark, odd_docs, asked, 3)) == brute(docs, items, 3)
    assert rows(lexical_search.search(spark, no_docs, asked, 3)) == []
    assert rows(lexical_search.search(spark, odd_docs, asked.limit(0), 3)) == []


def test_ties_stop_strictly_below(spark):
    """Equal scores everywhere: the smallest ids win, wherever they lie in the lists."""
    docs = [(i, "a b c d") for i in range(300, 0, -1)] + [(1000, "z")] * 400
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = rows(lexical_search.search(spark, frame, spark.createDataFrame([(7, "a d")], "item_id long, text string"), 10))
    assert got == brute(docs, [(7, "a d")], 10)
    assert sorted(r[2] for r in got) == list(range(1, 11))


def test_reads_part_of_the_lists():
    rng = np.random.default_rng(3)
    n, lists = 20_000, 6
    doc = np.tile(np.arange(n), lists)
    term = np.repeat(np.arange(lists), n)
    skill = rng.pareto(1.5, n) * 1000
    impact = (np.tile(skill, lists) * rng.uniform(0.8, 1.0, n * lists)).astype(np.int64)
    shard = lexical_search.Shard(lists, doc, term, impact)
    total = np.bincount(doc, impact).astype(np.int64)
    for _ in range(2):
        docs, scores, accesses = shard.best(np.arange(lists), 10)
        want = np.lexsort((np.arange(n), -total))[:10]
        assert docs.tolist() == want.tolist() and scores.tolist() == total[want].tolist()
        assert accesses < n * lists / 20
    assert not shard.seen.any() and not shard.wanted.any()
