"""Parity with the sentencepiece library and exact round trips."""

import random

import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from ledgerlens.llm import sentencepiece_codec as C


@pytest.fixture(scope="module")
def bpe():
    with open(C.MODEL_PATH, "rb") as f:
        return f.read()


def unigram_bytes(prefix=True):
    """A small unigram model written out by hand."""
    m = pb.ModelProto()
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback, m.trainer_spec.vocab_size = 1, True, 0
    m.normalizer_spec.name, m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces = "identity", prefix, False
    for p, t in (("<unk>", 2), ("<s>", 3), ("</s>", 3)):
        m.pieces.add(piece=p, score=0, type=t)
    for b in range(256):
        m.pieces.add(piece=f"<0x{b:02X}>", score=0, type=6)
    for i, p in enumerate(["▁", "▁the", "the", "t", "h", "e", "▁a", "a", "an", "▁an", "d", "n", "▁and", "he", "▁▁", "b"]):
        m.pieces.add(piece=p, score=-1.5 - 0.37 * i, type=1)
    return m.SerializeToString()


def random_texts(n=1500):
    rnd = random.Random(7)
    letters = "ab thend é▁\n\t漢字😀<s></s><0x41>  "
    return ["".join(rnd.choice(letters) for _ in range(rnd.randrange(0, 40))) for _ in range(n)] + ["", " ", "  ", "a ", " a", "\n", "▁", "the  the   the", "x" * 5000, "é" * 3000 + " " * 2000]


@pytest.mark.parametrize("which", ["bpe", "unigram"])
def test_ids_and_text_match_the_library(bpe, which):
    data = bpe if which == "bpe" else unigram_bytes()
    model = C.Model(data)
    assert model.cuttable and model.unigram == (which == "unigram")
    own = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = random_texts()
    codec = C.Codec(model, 2)
    for _ in range(2):  # new segments, then remembered ones
        ids, counts, agreed = codec.encode(texts)
        at = 0
        for text, n, want, ok in zip(texts, counts, own.encode(texts), agreed):
            assert list(ids[at: at + n]) == want, text
            assert ok, text
            at += n
    for text, back in zip(texts, C.decode(model, ids, counts)):
        assert back == text or C.MARK in text or (which == "unigram" and "<0x41>" in text)


def test_a_wrong_encoding_is_noticed(bpe):
    model = C.Model(bpe)
    codec = C.Codec(model, 1)
    codec.sp = type("Other", (), {"encode": lambda self, x, **k: [5] if isinstance(x, str) else [[5] for _ in x]})()
    _, _, agreed = codec.encode(["the text", ""])
    assert list(agreed) == [False, True]


def test_memory_is_bounded(bpe, monkeypatch):
    monkeypatch.setattr(C, "_MEMO", 50)
    codec = C.Codec(C.Model(bpe), 1)
    own = sentencepiece.SentencePieceProcessor(model_proto=bpe)
    for k in range(8):
        texts = [f"w{k}x{i} " * 3 + "y" * 100 for i in range(20)]
        ids, counts, _ = codec.encode(texts)
        assert list(ids) == [i for x in own.encode(texts) for i in x]
        assert all(len(s) <= C._LONG for s in codec.known)


def test_documents_table_round_trips(spark, bpe):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    own = sentencepiece.SentencePieceProcessor(model_proto=bpe)
    out = C.encoded(df)
    texts = {r.doc_id: r.text for r in df.collect()}
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.token_ids == own.encode(texts[r.doc_id]) and r.n_tokens == len(r.token_ids) and r.round_trip and r.parity
    assert {r.doc_id: r.text for r in C.decoded(out).collect()} == texts


def test_nulls_empty_long_repeats_and_other_columns(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, " "), (4, "word " * 20000), (5, "has ▁ marker"), (6, "\x01\n\n  é")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_tokens int, token_ids string").repartition(2)
    out = C.encoded(df)
    got = sorted(((r.doc_id, r.token_ids is None, r.n_tokens > 0, r.round_trip, r.parity) for r in out.collect()), key=str)
    assert got == sorted(((i, t is None, bool(t), t is None or C.MARK not in t, True) for i, t in rows), key=str)
    back = sorted(((r.doc_id, r.text) for r in C.decoded(out).collect()), key=str)
    assert back == sorted(((i, t.replace("▁", " ") if t else t) for i, t in rows), key=str)


def test_empty_table(spark):
    out = C.encoded(spark.createDataFrame([], "doc_id long, text string"))
    assert out.count() == 0 and C.decoded(out).count() == 0
