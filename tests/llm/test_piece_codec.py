import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from tripmart.llm import piece_codec

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_random_texts_as_the_library(library):
    codec, rnd = piece_codec.codec(PATH), random.Random(3)
    odd = list("abcdefghijklmnopqrstuvwxyzABCéüñß   ▁\n\t.,'0123456789漢字あ😀\u0000�")
    for k in range(3000):
        text = "".join(rnd.choice(odd if k % 2 else "etaoin shrdlu ") for _ in range(rnd.randint(0, 80)))
        ids = library.encode(text)
        assert codec.encode(text) == ids, text
        assert codec.decode(ids) == library.decode(ids)


def test_backtracking_equals_merging_on_one_chunk():
    codec, rnd = piece_codec.codec(PATH), random.Random(5)
    for _ in range(500):
        text = "".join(rnd.choice("theraniongésd") for _ in range(rnd.randint(1, 40)))
        assert codec.pieces(text) == codec.merge(text)


def test_any_ids_decode_as_the_library(library):
    codec, rnd = piece_codec.codec(PATH), random.Random(4)
    for _ in range(2000):
        ids = [rnd.randrange(32000) if rnd.random() < .6 else rnd.randrange(0, 259) for _ in range(8)]
        assert codec.decode(ids) == library.decode(ids), ids


def test_whole_documents(spark, some_docs, odd_docs, library):
    for docs in (some_docs.select("doc_id", "text"), odd_docs):
        got = piece_codec.decode(piece_codec.encode(docs, PATH), PATH).collect()
        want = [(r.doc_id, library.encode(r.text or "")) for r in docs.collect()]
        key = lambda x: (x[0] is None, x[0] or 0, x[1])
        assert sorted(((r.id, r.ids) for r in got), key=key) == sorted(want, key=key)
        assert all(r.decoded == library.decode(r.ids) for r in got)


def test_no_documents(no_docs):
    assert piece_codec.decode(piece_codec.encode(no_docs, PATH), PATH).count() == 0


def test_words_and_marks_are_remembered_apart():
    codec = piece_codec.codec(PATH)
    assert codec.chunks("A word,\nnext  12²\t ") == ["▁A", "▁word", ",\n", "next", "▁▁12²\t", "▁"]


def test_decoding_hands_on_bounded_texts_and_needs_no_encoder():
    codec = piece_codec.PieceCodec(PATH)
    ids = piece_codec.codec(PATH).encode("several words " * 40_000)
    rows = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array([ids, None] * 10, pa.list_(pa.int32()))], ["id", "ids"])
    got = list(piece_codec._decode_batches(iter([rows]), PATH))
    assert [i for b in got for i in b["id"].to_pylist()] == list(range(20))
    assert {t for b in got for t in b["decoded"].to_pylist()} == {"several words " * 40_000, ""}
    assert max(b["decoded"].nbytes for b in got) < 2 * piece_codec.DECODED
    codec.decode(ids)
    assert "automaton" not in codec.__dict__


def test_memory_of_neighbours_is_bounded(monkeypatch):
    monkeypatch.setattr(piece_codec, "NEIGHBOURS", 50)
    codec, rnd = piece_codec.PieceCodec(PATH), random.Random(6)
    for _ in range(100):
        codec.encode("".join(rnd.choice("etaoin shrdlu") for _ in range(60)))
        assert len(codec._agreed) <= 50
