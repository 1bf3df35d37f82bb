import math
import re
from collections import Counter

import pytest
import xxhash

from tripmart.llm import ngram_ratio as ng

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {p for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def word_hash(word):
    return xxhash.xxh64_intdigest(word.encode(), seed=42)


def pair_hash(a, b):
    first = xxhash.xxh64_intdigest(a.to_bytes(8, "little"), seed=42)
    return xxhash.xxh64_intdigest(b.to_bytes(8, "little"), seed=first)


def buckets(text, n):
    h = [word_hash(w) for w in WORD.findall(text or "")]
    return [signed(x) % n for x in h] + [signed(pair_hash(a, b)) % n for a, b in zip(h, h[1:])]


def test_statistics_and_scores_against_brute_force(spark, some_docs, odd_docs):
    for docs in (some_docs.select("doc_id", "text"), odd_docs):
        rows = docs.collect()
        ids = sorted({r.doc_id for r in rows if r.doc_id is not None})[::3]
        trusted = spark.createDataFrame([(i,) for i in [*ids, None, ids[0]]], "doc_id long")
        n = 512
        counts = ng.bucket_counts(docs, trusted, buckets=n)
        raw, target = Counter(), Counter()
        for r in rows:
            raw.update(buckets(r.text, n))
            if r.doc_id in ids:
                target.update(buckets(r.text, n))
        assert {r.bucket: (r.raw, r.target) for r in counts.collect()} == {b: (raw[b], target[b]) for b in raw}
        for rare_target in (ng.RARE_TARGET, 0.0):
            ratios = ng.log_ratios(counts, buckets=n, rare_target=rare_target)
            likely = [raw[b] * sum(target.values()) / max(1, sum(raw.values())) for b in range(n)]
            weight = [min(raw[b] / (raw[b] + ng.RARE), x / (x + rare_target) if x else 1.0 - bool(rare_target)) for b, x in enumerate(likely)]
            expect = [round((math.log((target[b] + 1) / (sum(target.values()) + n))
                             - math.log((raw[b] + 1) / (sum(raw.values()) + n))) * weight[b], 5) for b in range(n)]
            assert ratios == pytest.approx(expect, abs=2e-5)
        key = lambda x: (x[0] is None, x[0] or 0, x[1:])
        got = sorted(((r.id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in
                      ng.judge(docs, ratios).collect()), key=key)
        assert got == sorted(((r.doc_id, *base(r.text)) for r in rows), key=key)
        scores = {r.doc_id: sum(ratios[b] for b in x) / len(x) if (x := buckets(r.text, n)) else 0.0 for r in rows}
        for r in ng.judge(docs, ratios).collect():
            assert r.llr == pytest.approx(scores[r.id], abs=1e-9)
            failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
            assert r.base_failed == failed and r.kept == (not failed and r.llr >= ng.THRESHOLD)


def test_no_documents_or_no_trusted_ones(spark, no_docs, some_docs):
    nobody = spark.createDataFrame([], "doc_id long")
    assert ng.filter_by_ratio(spark, no_docs, nobody).count() == 0
    assert ng.filter_by_ratio(spark, some_docs, nobody).count() == some_docs.count()


def test_the_trusted_target_is_bounded(spark, some_docs):
    counts = ng.bucket_counts(some_docs, some_docs.select("doc_id"), most_trusted=3)
    assert counts.agg({"target": "sum"}).first()[0] < counts.agg({"raw": "sum"}).first()[0] / 10


def test_every_trusted_document_is_counted(spark):
    """More of them than the 20,000 that were once the most."""
    docs = spark.range(20_500).selectExpr("id as doc_id", "concat('a b', id % 7) as text")
    got = ng.bucket_counts(docs, docs.select("doc_id")).agg({"raw": "sum", "target": "sum"}).first()
    assert got["sum(raw)"] == got["sum(target)"] == 3 * 20_500


def test_a_target_of_little_evidence_weighs_little(spark):
    def ratios(target, **options):
        rows = [(0, 100_000, target), (1, 100_000, 0)]
        return ng.log_ratios(spark.createDataFrame(rows, "bucket int, raw long, target long"), buckets=2, **options)
    assert [abs(r) < 0.1 * abs(p) for r, p in zip(ratios(6, rare_target=ng.RARE_TARGET), ratios(6))] == [True, True]
    assert ratios(60_000, rare_target=ng.RARE_TARGET) == ratios(60_000)
    assert ratios(0, rare_target=ng.RARE_TARGET) == [0.0, 0.0]


def test_the_map_lets_all_trusted_rows_through(spark, some_docs):
    ids = some_docs.select("doc_id").where("doc_id % 3 = 0")
    for bits, most in ((1 << 26, 1.0), (1 << 16, 1.1), (8, 9.0)):
        kept = [r.doc_id for r in ng.with_mapped_id(some_docs.select("doc_id"), ids, "doc_id", bits).collect()]
        assert set(kept) >= {r.doc_id for r in ids.collect()} and len(kept) <= most * ids.count()
    want = sorted(map(tuple, ng.bucket_counts(some_docs, ids, 64).collect()))
    assert sorted(map(tuple, ng.bucket_counts(some_docs, ids, 64, map_bits=8).collect())) == want


def test_the_same_plan_at_every_size(spark, some_docs):
    """Only the bounded map is broadcast; the raw counts need no join."""
    plan = ng.bucket_counts(some_docs, some_docs.select("doc_id"))._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1
