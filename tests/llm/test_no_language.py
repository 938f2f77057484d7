"""The first stage where no language can be learned."""

import corpus_pipeline

from tests.llm import brute


def test_documents_with_a_letter_stay(spark):
    docs = spark.createDataFrame(brute.rows(["some text", None, "", "12 !?", "漢字", "a"]), brute.DOCS).selectExpr(
        "doc_id", "text", "cast(null as string) as lang", "source", "n_chars"
    )
    got = corpus_pipeline.identify_language(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [0, 4, 5]
