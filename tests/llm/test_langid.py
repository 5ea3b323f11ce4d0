"""Output codes: held-out accuracy and odd rows."""

import zlib

import numpy as np
import pytest

from feldspar.llm import langid
from feldspar.llm.queries import QUERIES


@pytest.mark.parametrize("n", [2, 3, 4, 7, 12])
def test_codewords_differ(n):
    m = langid.codewords(n)
    assert len({tuple(r) for r in m}) == n and not (np.abs(m.sum(0)) == n).any()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op4_language_codes"](spark, folder).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_rows(spark):
    rows = [(i, t, l, "x") for i, (t, l) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr"), (None, "en"), ("", "fr"), ("123 !!", None), ("the end", None)] * 9)]
    rows += [(None, "the the", "en", None), (5, "die katze", None, None), (5, "x" * 300_000, "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = langid.identify(docs).collect()
    assert len(got) == len(rows)
    letters = {r[0] for r in rows if r[1] and any(c.isalpha() for c in r[1])}
    for r in got:
        assert (r.lang_pred == "und") == (r.doc_id not in letters) or r.doc_id == 5
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns and kept.count() == sum(1 for r in rows if r[1] and any(c.isalpha() for c in r[1]))
    assert langid.identify(docs.limit(0)).count() == 0
    blank = langid.identify(docs.where("lang is null")).collect()
    assert {r.lang_pred for r in blank} == {"und"}
