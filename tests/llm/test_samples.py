"""Unlabelled samples are bounded whatever the rows hold."""

from pyspark.sql import functions as F

from ledgerlens.llm import labelled


def test_bounds(spark):
    rows = [(None, "one text 1")] * 500 + [(i, f"text {i}") for i in range(300)] + [(9, "long 1" * 100_000), (10, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "text as h").repartition(5)
    for n in (1, 40, 1000):
        got = labelled.plain_sample(df, n).collect()
        assert len(got) == min(n, 301) and len({r.h for r in got}) == len(got)
        assert max(len(r.text) for r in got) <= labelled.SAMPLE_BYTES
    first = {r.h for r in labelled.plain_sample(df, 40).collect()}
    assert first == {r.h for r in labelled.plain_sample(df.repartition(2), 40).collect()}
    assert {r.text for r in labelled.plain_sample(df, 1000, keep=F.col("text").rlike("one")).collect()} == {"one text 1"}
    assert labelled.plain_sample(df.limit(0), 10).count() == 0
