"""The pipeline's stages, each against a plain version over its own input."""

import hashlib

import sentencepiece

import corpus_pipeline as cp
from ledgerlens.llm import pii, toxicity
from tests.llm.test_op5_pii import plain as plain_pii
from tests.llm.test_op9_decontaminate import brute_force as leaks, words
from tests.llm.test_op10_near_dup import brute_force as near

SF = "/root/testdata/sf0.001"


def test_stages_by_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    tables = [docs]
    for i, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, tables[-1], SF)
        out.write.parquet(f"{tmp_path}/{i}")
        tables.append(spark.read.parquet(f"{tmp_path}/{i}"))
        assert i == len(cp.STAGES) - 1 or tables[-1].columns == columns
    texts = [{r.doc_id: r.text for r in t.collect()} for t in tables[:-1]]
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert texts[1] == {d: t for d, t in texts[0].items() if scores[d] < 0.7}
    classes = near(list(texts[1].items()))
    assert texts[2] == {d: t for d, t in texts[1].items() if classes[d] == d}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    # a document that shares no three words in a row with an item can't hold it (k + 1 parts of at least three words)
    grams = {tuple(words(t)[i:i + 3]) for _, t in items for i in range(len(words(t)) - 2)}
    maybe = [(d, t) for d, t in texts[2].items() if any(tuple(words(t)[i:i + 3]) in grams for i in range(len(words(t)) - 2))]
    bad = {d for d, _ in leaks([(d, t) for d, t in maybe if len(words(t)) < 1500], items)}
    lost = texts[2].keys() - texts[3].keys()
    assert bad == {d for d in lost if len(words(texts[2][d])) < 1500}
    for d, t in texts[4].items():
        left = texts[3][d]
        assert not plain_pii(t or "")
        assert t == left or plain_pii(left) or "[" in t
    library = sentencepiece.SentencePieceProcessor(model_file=cp.model_path())
    rows = tables[-1].collect()
    assert {r.doc_id for r in rows} == texts[4].keys() and len(rows) == len(texts[4])
    for r in rows:
        ids = library.encode(texts[4][r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_run_gives_the_last_stage(spark):
    out = cp.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert 0.5 * n < out.count() < n


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "a b c d e f g", None, None, 13), (2, "a b c d e f g", None, None, 13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        now = table
        for _, stage in cp.STAGES:
            now = stage(spark, now, SF)
        assert now.count() == (3 if table is docs else 0)
