"""Documents without any language label."""

from feldspar.llm import langid


def test_keep_known_without_labels(spark):
    rows = [(1, "plain words", None), (2, "", None), (3, None, None), (4, "12 !?", None), (5, "\u6f22", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 5}
