import math
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tripmart.llm import maxent_lm as lm
from tripmart.llm.labelled import fold_of


def base_by_hand(rows):
    """(n_tokens, n_known, train_tokens, base score) of (id, text, training) rows."""
    counts = Counter()
    for _, text, training in rows:
        if training:
            counts.update([*lm.tokens(text), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for _, text, _ in rows:
        c = [counts[w] for w in [*lm.tokens(text), None]]
        out.append((len(c), sum(x > 0 for x in c), n, sum(math.log10((x + 0.5) / (n + 0.5 * (v + 1))) for x in c)))
    return out


@pytest.mark.parametrize("dictionary", [1 << 18, 40])
def test_base_scores_by_hand(spark, some_docs, odd_docs, monkeypatch, dictionary):
    """The same with nearly all words out of the broadcast dictionary, where counts are joined."""
    monkeypatch.setattr(lm, "DICTIONARY", dictionary)
    for docs in (some_docs.select("doc_id", "text").limit(120), odd_docs):
        rows = [(r.doc_id, r.text, crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 != 1) for r in docs.collect()]
        got = lm.train_and_score(spark, docs, fold_of(F.col("doc_id"), 5) != 1, rounds=1).collect()
        key = lambda x: (str(x[0]), x[1], x[2])
        got = sorted(((r.id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.training, r.score) for r in got), key=key)
        want = sorted(((i, *b, t) for (i, _, t), b in zip(rows, base_by_hand(rows))), key=key)
        assert [g[:4] for g in got] == [w[:4] for w in want] and [g[5] for g in got] == [w[5] for w in want]
        assert [g[4] for g in got] == pytest.approx([w[4] for w in want])
        assert all(g[6] <= 0 for g in got)


def small_vocabulary(words):
    counts = Counter(words)
    tail_tokens, tail_types = np.zeros(lm.TAIL_CLASSES, np.int64), np.zeros(lm.TAIL_CLASSES, np.int64)
    head = sorted([*counts.most_common(20), (None, 7)], key=lambda x: (-x[1], str(x[0])))
    for w in set(counts) - {w for w, _ in head}:
        tail_tokens[lm.tail_class(lm.tail_symbol(w))] += counts[w]
        tail_types[lm.tail_class(lm.tail_symbol(w))] += 1
    return lm.Vocabulary(len(words) + 7, len(counts) + 1, {}, np.array([]), [w for w, _ in head],
                         np.array([c for _, c in head], np.int64), tail_tokens, tail_types), counts


def test_probabilities_of_all_next_tokens_sum_to_one():
    rnd = np.random.default_rng(1)
    v, counts = small_vocabulary([b"w%d" % i for i in rnd.zipf(1.4, 3000) % 400])
    w = lm.Weights.start(v)
    w.by_class[:] = rnd.normal(size=w.by_class.shape)
    w.by_word[:] = rnd.normal(size=w.by_word.shape)
    before = [3, 600, 5]
    heads = [lm.text_log10(w, [np.array([*before, s], "<u2")])[0] for s in range(len(v.head_words))]
    total = sum(10 ** (h - lm.text_log10(w, [np.array(before, "<u2")])[0]) for h in heads)
    head_words = {x for x in v.head_words if x is not None}
    for tail in range(lm.TAIL_CLASSES):
        symbol = next(s for s in range(lm.HEAD, lm.START) if lm.tail_class(s) == tail)
        chance = 10 ** (lm.text_log10(w, [np.array([*before, symbol], "<u2")])[0] - lm.text_log10(w, [np.array(before, "<u2")])[0])
        words = [x for x in counts if x not in head_words and lm.tail_class(lm.tail_symbol(x)) == tail]
        inside = sum(10 ** v.tail_log(counts[x], tail) for x in words) + 10 ** v.tail_log(0, tail)
        assert inside == pytest.approx(1.0)
        total += chance * inside
    assert total == pytest.approx(1.0, abs=1e-4)


def test_sums_are_the_gradient_of_the_log_likelihood():
    rnd = np.random.default_rng(2)
    v, _ = small_vocabulary([b"w%d" % i for i in rnd.zipf(1.4, 3000) % 400])
    w = lm.Weights.start(v)
    texts = [rnd.choice([*range(21), 300, 555, 800], size=n).astype("<u2") for n in (30, 1, 80)]
    sums = lm.Sums()
    sums.add(w, texts)
    for table, seen, expected in (("by_class", sums.seen, sums.expected), ("by_word", sums.word_seen, sums.word_expected)):
        gradient = seen - expected
        for row, col in np.argwhere(np.abs(gradient) > 0.5)[::7][:25]:
            weights = getattr(w, table)
            low = high = 0.0
            for sign in (-1, 1):
                weights[row, col] = sign * 0.01
                total = lm.text_log10(w, texts).sum() * math.log(10)
                low, high = (total, high) if sign < 0 else (low, total)
            weights[row, col] = 0
            assert (high - low) / 0.02 == pytest.approx(gradient[row, col], rel=0.05, abs=0.05)


def test_held_out_texts_are_likelier_than_under_the_base(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    r = lm.train_and_score(spark, docs, fold_of(F.col("doc_id"), 5) != 1).where("not training").agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.avg((F.col("score") > F.col("base_score")).cast("int")).alias("share")).first()
    assert r.s > 0.92 * r.b and r.share > 0.9


def test_no_documents_or_no_training(spark, no_docs, odd_docs):
    assert lm.train_and_score(spark, no_docs, F.lit(True)).count() == 0
    got = lm.train_and_score(spark, odd_docs, F.lit(None).cast("boolean")).collect()
    assert len(got) == 11 and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in got)


def test_scores_do_not_depend_on_how_rows_are_stored(spark, some_docs):
    docs = some_docs.select("doc_id", "text")
    training = fold_of(F.col("doc_id"), 5) != 1
    one, other = ({r.id: r.score for r in lm.train_and_score(spark, d, training).collect()}
                  for d in (docs.coalesce(1), docs.repartition(7, F.hash("text")).sortWithinPartitions(F.desc("doc_id"))))
    assert one.keys() == other.keys() and all(abs(one[i] - other[i]) <= 1e-4 * abs(one[i]) for i in one)


SYMBOLS = lm.Symbols(np.array([lm.HEAD + 11 * u if u % 3 else u for u in range(60)]), 0)


def block_of(number, texts, training):
    return pa.table({"block": [number] * len(texts), "training": pa.array(training, pa.bool_()),
                     "units": pa.array([lm.planes(np.array(t, "<u4")) for t in texts], pa.binary())})


def test_planes_and_symbols():
    units = np.array([3, 59, lm.other_unit(b"x"), lm.other_unit("größer".encode())], "<u4")
    assert lm._arrays(pa.array([lm.planes(units), b""]), "<u4")[0].tolist() == units.tolist()
    assert SYMBOLS.of(units).tolist() == [3, lm.HEAD + 649, lm.tail_symbol(b"x"), lm.tail_symbol("größer".encode()), 0]


@pytest.mark.parametrize("shards", [1, 3])
def test_context_features_against_counting_by_hand(shards):
    """Features of several blocks, summed in shards, give each text what counters give."""
    rnd = np.random.default_rng(3)
    unit = lambda u: int(u) if u < 60 else lm.other_unit(b"word%d" % u)
    blocks = [([[unit(u) for u in rnd.integers(0, 70, n)] for n in (0, 1, 40, 7)], [True, False, True, False]) for _ in range(4)]
    chance = rnd.uniform(0.01, 0.5, 60)
    pairs, contexts = Counter(), Counter()

    def tails(text):
        for last, u in zip([lm.START_UNIT, *text], text):
            symbol = int(SYMBOLS.of(np.array([u], "<u4"))[0])
            if symbol >= lm.HEAD:
                yield last, u, lm.tail_class(symbol)
    for texts, training in blocks:
        for text in (t for t, learned in zip(texts, training) if learned):
            for last, u, tail in tails(text):
                pairs[last, u] += 1
                contexts[last, tail] += 1
    sent = [lm._features_of_block(block_of(i, *b), shards, SYMBOLS, 40) for i, b in enumerate(blocks)]
    sums = pa.concat_tables([lm._sum_shard(pa.concat_tables(sent).filter(pa.compute.equal(pa.concat_tables(sent)["shard"], k)))
                             for k in range(shards)])
    for i, (texts, training) in enumerate(blocks):
        table = block_of(i, texts, training)
        units = lm._arrays(table["units"], "<u4")
        tail = lm.tail_tokens_of([SYMBOLS.of(u) for u in units], units, 40)
        own = sums.filter(pa.compute.equal(sums["block"], i)).sort_by("shard")
        got = lm.tail_log10(tail, tail.features(), np.concatenate(lm._arrays(own["totals"], "<u8")), chance, len(texts), 2.5)
        want = [sum((math.log1p(pairs[last, u] / (2.5 * chance[u])) if u < lm.OTHER else 0.0) - math.log1p(contexts[last, c] / 2.5)
                    for last, u, c in tails(text)) / math.log(10) for text in texts]
        assert got == pytest.approx(want)


def test_context_weights_sum_to_one_and_have_no_gradient():
    """In a context, the words of a class have the sum 1, and the penalised likelihood has no slope left."""
    p, n, prior = np.array([0.5, 0.3, 0.15, 0.05]), np.array([0, 3, 1, 0]), 2.5
    q = p * (1 + n / (prior * p)) / (1 + n.sum() / prior)
    assert q.sum() == pytest.approx(1.0)
    assert n - n.sum() * q + prior * (p - q) == pytest.approx(np.zeros(4), abs=1e-12)


def test_words_in_a_seen_context_gain_and_unseen_ones_lose(spark):
    """Held-out texts whose word pairs the training holds are likelier than the same words in another order."""
    common = " ".join(f"c{i}" for i in range(300))
    words = [f"rare{i}" for i in range(40)]
    rows = [(i, f"{common} {common} {' '.join(words)}", True) for i in range(8)]
    rows += [(100, " ".join(words), False), (101, " ".join(words[::2] + words[1::2]), False)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, learned boolean")
    got = {r.id: r.score for r in lm.train_and_score(spark, docs, F.col("learned")).collect()}
    assert got[100] > got[101] + 5


@pytest.mark.parametrize("bits", [3, 34, 64])
def test_ranked_against_counting_by_hand(bits):
    """Also where value and position do not fit into 64 bits together, with repeats, one value and none."""
    rnd = np.random.default_rng(4)
    for n in (0, 1, 2, 1000):
        values = rnd.integers(0, (1 << bits) - 1, n, dtype=np.uint64, endpoint=True)
        values = np.concatenate([values, values[::3]])
        found, place = lm.ranked(values)
        assert found.dtype == np.uint64 and found.tolist() == sorted(set(values.tolist()))
        assert found[place].tolist() == values.tolist()


def test_features_are_ranked_once_by_plain_sorting(monkeypatch):
    """The CPU seconds of a block's features lay in np.unique and in searches: none is left, of the block or of a shard."""
    def fail(*_, **__):
        raise AssertionError("slow on many features")
    rnd = np.random.default_rng(5)
    block = block_of(0, [rnd.integers(0, 60, n) for n in (50, 0, 9)], [True, True, False])
    for slow in ("unique", "argsort"):
        monkeypatch.setattr(np, slow, fail)
    sent = lm._features_of_block(block, 1, SYMBOLS, 34)
    sums = lm._sum_shard(sent)
    units = lm._arrays(block["units"], "<u4")
    tail = lm.tail_tokens_of([SYMBOLS.of(u) for u in units], units, 34)
    totals = np.concatenate(lm._arrays(sums["totals"], "<u8"))
    monkeypatch.setattr(np, "searchsorted", fail)
    assert np.isfinite(lm.tail_log10(tail, tail.features(), totals, np.full(60, 0.1), 3, 2.5)).all()
    with pytest.raises(ValueError):
        lm.tail_log10(tail, tail.features(), totals[1:], np.full(60, 0.1), 3, 2.5)


def test_expected_counts_against_sums_token_by_token(monkeypatch):
    """Chunks of a few tokens, so that runs of a pair are cut; each token's chances by their logits."""
    monkeypatch.setattr(lm, "CHUNK", 16)
    rnd = np.random.default_rng(6)
    v, _ = small_vocabulary([b"w%d" % i for i in rnd.zipf(1.4, 3000) % 400])
    w = lm.Weights.start(v)
    w.by_class[:] = rnd.normal(size=w.by_class.shape)
    w.by_word[:] = rnd.normal(size=w.by_word.shape)
    texts = [rnd.choice([0, 1, 2, 20, 300, 555], size=n).astype("<u2") for n in (70, 1, 0, 150)]
    sums = lm.Sums()
    sums.add(w, texts)
    expected, word_expected = np.zeros(sums.expected.shape), np.zeros(sums.word_expected.shape)
    seen, word_seen = np.zeros(sums.seen.shape), np.zeros(sums.word_seen.shape)
    target, _, rows = lm.contexts(texts)

    def chance(logits):
        e = np.exp(logits.astype(np.float64))
        return e / e.sum()
    for t, r in zip(target.tolist(), rows.T.astype(int).tolist()):
        own = t // lm.PER_CLASS if t < lm.HEAD else lm.HEAD_CLASSES + lm.tail_class(t)
        p = chance(w.class_bias + w.by_class[r].sum(axis=0))
        for row in r:
            expected[row] += p
            seen[row, own] += 1
        if t < lm.HEAD:
            word_rows = [row * lm.HEAD_CLASSES + own for row in r[:2]]
            p = chance(w.word_bias[own] + w.by_word[word_rows].sum(axis=0))
            for row in word_rows:
                word_expected[row] += p
                word_seen[row, t % lm.PER_CLASS] += 1
    assert (sums.seen == seen).all() and (sums.word_seen == word_seen).all()
    assert sums.expected == pytest.approx(expected, rel=1e-5, abs=1e-6) and sums.word_expected == pytest.approx(word_expected, rel=1e-5, abs=1e-6)
