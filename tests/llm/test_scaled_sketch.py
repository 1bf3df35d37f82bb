import hashlib
import re

import xxhash

from tripmart.llm import scaled_sketch as sk

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def chain(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.to_bytes(8, "little"), seed=seed)
    return seed


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def brute(text, scale=sk.SCALE):
    h = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in WORD.findall(text or "")]
    shingles = [chain(h[i:i + 5]) for i in range(len(h) - 4)] if len(h) >= 5 else [chain(h)] if h else []
    return signed(chain(h)), sorted({signed(x) for x in shingles if signed(x) < -(1 << 63) + (1 << 64) // scale})


def likeness(a, b):
    if a[0] == b[0]:
        return 1.0
    both, either = set(a[1]) & set(b[1]), set(a[1]) | set(b[1])
    return len(both) / len(either) if either else 0.0


def expected(rows):
    """The next document of each row by sorting; NULL is the smallest id."""
    order = sorted({r.doc_id for r in rows}, key=lambda i: (i is not None, i or 0))
    out = []
    for r in rows:
        n = len(r.text or "")
        before = order[order.index(r.doc_id) - 1]
        after = min((x.text or "" for x in rows if x.doc_id == before), key=lambda t: t.encode())
        out.append((r.doc_id, n, (r.text or "")[:n - n // 2] + after[:n // 2], after, r.text or ""))
    return out


def test_against_brute_force(spark, some_docs, odd_docs):
    for docs in (some_docs.select("doc_id", "text"), odd_docs):
        got = sk.compare_with_edits(spark, docs).select(
            "id", "n_chars", "own", "edited", "next", "edited_text", sk.likeness(sk.F.col("own"), sk.F.col("edited")).alias("near"),
            sk.likeness(sk.F.col("own"), sk.F.col("next")).alias("near_next")).collect()
        key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
        want = sorted(expected(docs.collect()), key=key)
        got = sorted(((r.id, r.n_chars, r.edited_text, r) for r in got), key=key)
        assert [g[:3] for g in got] == [w[:3] for w in want]
        for (_, _, edited, r), (_, _, _, after, own) in zip(got, want):
            a, b, c = brute(own), brute(edited), brute(after)
            assert (r.own.whole, r.own.kept) == a and (r.edited.whole, r.edited.kept) == b and (r.next.whole, r.next.kept) == c
            assert r.near == likeness(a, b) and r.near_next == likeness(a, c)


def test_containment_of_very_unequal_texts(spark):
    words = [hashlib.md5(str(i).encode()).hexdigest()[:6] for i in range(20_000)]
    df = spark.createDataFrame([(1, " ".join(words[:2000]), " ".join(words))], "doc_id long, a string, b string").select(
        sk.sketch(sk.F.col("a")).alias("a"), sk.sketch(sk.F.col("b")).alias("b"))
    r = df.select(sk.containment(sk.F.col("a"), sk.F.col("b")).alias("c"), sk.likeness(sk.F.col("a"), sk.F.col("b")).alias("j"),
                  sk.merged(sk.F.col("a"), sk.F.col("b")).alias("m"), "b").first()
    assert r.c == 1.0 and abs(r.j - 0.1) < 0.03 and r.m == r.b.kept


def test_one_or_no_document(spark, no_docs):
    assert sk.compare_with_edits(spark, no_docs).count() == 0
    r = sk.compare_with_edits(spark, spark.createDataFrame([(5, "ab cd")], "doc_id long, text string")).first()
    assert r.edited_text == "ab ab" and r.own == r.next
