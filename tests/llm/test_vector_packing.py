import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tripmart.llm import vector_packing as vp

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def check_packed(rows, texts, most=1024):
    """Every id in exactly one piece with the right digest; sequences gapless and within the limit."""
    tok = Tokenizer.from_file(PATH)
    want = sorted(zlib.crc32(np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")[s:s + most].tobytes())
                  for t in texts for s in range(0, len(tok.encode(t or "", add_special_tokens=False).ids) + 1, most))
    assert sorted(r.ids_crc32 for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == list(np.cumsum([0] + [r.length for r in parts])[:-1])
        assert sum(r.length for r in parts) <= most
    return sequences


def test_documents(spark, some_docs):
    rows = vp.pack(spark, vp.tokenised_pieces(some_docs, PATH, RANKS)).collect()
    sequences = check_packed(rows, [r.text for r in some_docs.collect()])
    assert sum(r.length for r in rows) > 0.97 * 1024 * len(sequences)


def test_odd_documents(spark, odd_docs, no_docs):
    check_packed(vp.pack(spark, vp.tokenised_pieces(odd_docs, PATH, RANKS)).collect(), [r.text for r in odd_docs.collect()])
    assert vp.pack(spark, vp.tokenised_pieces(no_docs, PATH, RANKS)).count() == 0


def test_all_three_limits_hold(spark):
    rng = np.random.default_rng(2)
    pieces = spark.createDataFrame(
        [(i, 0, int(n), 7, int(n), int(n * share), 0) for i, (n, share) in enumerate(zip(rng.integers(1, 60, 900), rng.random(900)))],
        "id long, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, part int")
    loss = {r.id: r.loss_tokens for r in pieces.collect()}
    rows = vp.pack(spark, pieces, max_tokens=100, max_segments=4, max_loss_tokens=50, group_rows=300).collect()
    assert len(rows) == 900
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for parts in sequences.values():
        assert sum(r.length for r in parts) <= 100
        assert len(parts) <= 4
        assert len(parts) == 1 or sum(loss[r.id] for r in parts) <= 50


@pytest.mark.parametrize("n", [0, 1, 5])
def test_oversized_vectors_stand_alone(n):
    bins, places = vp.fill_bins(np.full((n, 3), 9), np.array([4.0, 4.0, 4.0]))
    assert sorted(bins) == list(range(n)) and not places.any()


def test_ranks_and_tokenizer_agree(spark, odd_docs):
    plain = vp.tokenised_pieces(odd_docs, PATH).collect()
    assert sorted(map(str, plain)) == sorted(map(str, vp.tokenised_pieces(odd_docs, PATH, RANKS).collect()))


@pytest.mark.parametrize("space", [" ", "\n", " \n\u00a0"])
def test_long_runs_of_white_space(space):
    """The faster encoder's pattern fails on them; the ids are the tokenizer's."""
    import pyarrow as pa
    n = 1_500_000 // len(space)
    texts = ["a" + space * n + "b c", space * (vp.LONG_RUN // len(space) - 1) + "x", space * n]
    batch = pa.record_batch([pa.array([1, 2, 3]), pa.array(texts)], names=["id", "text"])
    tok = Tokenizer.from_file(PATH)
    got = {}
    for out in vp._token_pieces(iter([batch]), PATH, RANKS, 1024, 0):
        for r in out.to_pylist():
            got.setdefault(r["id"], []).append(r["ids_crc32"])
    for i, text in enumerate(texts, 1):
        ids = np.array(tok.encode(text, add_special_tokens=False).ids + [0], "<u4")
        assert got[i] == [zlib.crc32(ids[s:s + 1024].tobytes()) for s in range(0, len(ids), 1024)]
