"""Counts against the tokenizers library."""

import random

import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ledgerlens.llm import token_counts as tc
from ledgerlens.llm.op12_token_counts import MODEL, model_path, op12_token_counts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def both():
    return tc.vocabulary(model_path(MODEL)), Tokenizer.from_file(model_path(MODEL))


def want(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


CASES = ["", " ", "a", "  a  b ", "\n\n x", "don't we'll I'VE 'tis", "日本語 \U0001f937x", "1234 ½ ² ٣", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>",
         "<|endoftext|", "\x00\x1c\x85\xa0", " ᠎​  x", "՘࢏x", "x" * 3000, "ab" * 3000 + " c", "tab\t\tend \t", "\U0010ffff͸"]


def test_cases(both):
    own, library = both
    assert own.counts(CASES) == [want(library, t) for t in CASES]


def test_characters_of_both_unicode_tables(both):
    own, library = both
    rng = random.Random(2)
    pool = own.odd + " \t\n\x0b\x1c\x85\xa0 　aé日1²'s!"
    texts = ["".join(rng.choice(pool if rng.random() < 0.6 else "ab 's\n") for _ in range(rng.randrange(20))) for _ in range(2000)]
    assert own.counts(texts) == [want(library, t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=60))
def test_any_text(text):
    own = tc.vocabulary(model_path(MODEL))
    assert own.counts([text]) == [want(_library(), text)]


def _library(kept=[]):
    if not kept:
        kept.append(Tokenizer.from_file(model_path(MODEL)))
    return kept[0]


def test_query_equals_the_library(spark, both):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = op12_token_counts(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        n = want(both[1], texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)


def test_edge_cases(spark, both):
    rows = [(1, None), (2, ""), (None, "a b"), (3, " x  y "), (3, " x  y "), (4, "long " * 30000), (5, "n" * 50000), (6, "é" * 600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "text as n_bytes", "doc_id as n_tokens")
    got = sorted(map(tuple, tc.counted(df, model_path(MODEL), limit=5).collect()), key=str)
    n = [want(both[1], t) for _, t in rows]
    assert got == sorted(((d, len((t or "").encode()), k, k > 5) for (d, t), k in zip(rows, n)), key=str)
    assert tc.counted(df.limit(0), model_path(MODEL)).count() == 0


def test_memory_stays_bounded(both, monkeypatch):
    monkeypatch.setattr(tc, "REMEMBERED", 50)
    own = tc.Vocabulary(model_path(MODEL), both[0].odd)
    for i in range(40):
        text = " ".join(f"w{i * 7 + k}" for k in range(20)) + " the" + "z" * 100
        assert own.counts([text]) == [want(both[1], text)]
        assert len(own.young) <= 100 and len(own.old) <= 100


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        tc.Vocabulary(model_path("word_bpe_49k.json"))
