"""Encoding and decoding against the sentencepiece library on whole texts."""

import hashlib
import random

import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from ledgerlens.llm import sentencepiece_bpe as own
from ledgerlens.llm.op1_sentencepiece import model_path, op1_sentencepiece

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def both():
    return own.vocabulary(model_path()), sentencepiece.SentencePieceProcessor(model_file=model_path())


CASES = ["", " ", "a", " a  b ", "\n", "a\nb", "日本語 \U0001f937x", "▁x", "▁", "a▁▁ b▁", "\x00a", "<s>hi</s> <unk> <0x0A>",
         "é", "ﬁ", "    indented   text\t\ttabs", "x" * 300, "ab" * 3000 + " c", "Donaudampfschifffahrt" * 5, "  wide", "\U0010ffff͸"]


def test_cases(both):
    vocab, library = both
    for text in CASES:
        ids = library.encode(text)
        assert vocab.encode(text, check=True) == ids, text
        assert vocab.decode(ids) == library.decode(ids), text
        assert vocab.agenda("▁" + text.replace(" ", "▁")) == ids if text else True


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=60))
def test_any_text(text):
    vocab = own.vocabulary(model_path())
    ids = vocab.library.encode(text)
    assert vocab.encode(text) == ids
    assert vocab.decode(ids) == vocab.library.decode(ids)


def test_decode_any_ids(both):
    vocab, library = both
    rng = random.Random(0)
    for _ in range(300):
        ids = [rng.choice([0, 1, 2, 3 + rng.randrange(256), rng.randrange(32000), 28705]) for _ in range(rng.randrange(12))]
        assert vocab.decode(ids) == library.decode(ids), ids


def test_query_equals_the_library(spark, both):
    _, library = both
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = op1_sentencepiece(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_edge_cases(spark, both):
    _, library = both
    rows = [(1, None), (2, ""), (None, "a b"), (3, " x  y "), (3, " x  y "), (4, "long " * 30000), (5, "n" * 50000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "text as ids", "doc_id as n_tokens")
    got = sorted(((r.doc_id, r.n_tokens, r.ids, r.decoded) for r in own.encoded(df, model_path(), with_ids=True).collect()), key=str)
    want = sorted(((d, len(i), i, library.decode(i)) for d, i in ((d, library.encode(t or "")) for d, t in rows)), key=str)
    assert got == want
    assert own.encoded(df.limit(0), model_path()).count() == 0


def test_memory_stays_bounded(both, monkeypatch):
    monkeypatch.setattr(own, "REMEMBERED", 50)
    memory = own.Memory(both[0])
    for i in range(40):
        keys = {f"w{i * 7 + k}" for k in range(20)} | {"the"}
        found = memory.entries(keys)
        assert all(found[k][2] == " " + k for k in keys)
        assert len(memory.young) <= 50 + 21 and len(memory.old) <= 50 + 21
