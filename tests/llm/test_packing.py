"""Packed pieces against the token ids of the tokenizers library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from feldspar.llm import packing
from feldspar.llm.vocab import default_path

LIB = Tokenizer.from_file(default_path())


def hold(docs, rows, capacity=packing.CAPACITY):
    """Check every law of a packing; gives the share of padding."""
    ids = [np.array([*LIB.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for _, t in docs]
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    want, have = defaultdict(int), defaultdict(int)
    for (d, _), x in zip(docs, ids):
        for start, length, _ in packing.cut(len(x), capacity):
            want[d, start, length, zlib.crc32(x[start : start + length].tobytes()), len(x)] += 1
    for r in rows:
        have[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
    assert want == have
    assert sorted(bins) == list(range(len(bins)))
    return 1 - sum(map(len, ids)) / (capacity * len(bins)) if bins else 0


@pytest.mark.parametrize("n", [1, 2, 31, 33, 64, 100, 700, 1023, 1024, 1500, 2047, 2048, 2049, 5000])
def test_cut_covers_each_id_once(n):
    at = 0
    for start, length, k in packing.cut(n):
        assert start == at and k == 2048 // length
        at += length
    assert at == n


def test_odd_rows(spark):
    rng = random.Random(1)
    docs = [(1, None), (2, ""), (3, "one"), (3, "one"), (None, "no id"), (4, "w " * 9000), *[(i, "word " * rng.randrange(2500)) for i in range(10, 60)], *[(7, "copy of a text")] * 70]
    frame = spark.createDataFrame([(d, t, "c", 5) for d, t in docs], "doc_id long, text string, class string, length int")
    hold(docs, packing.harmonic(frame).collect())
    assert packing.harmonic(frame.limit(0)).count() == 0


def test_query_wastes_little(spark):
    from feldspar.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert hold(docs, QUERIES["op7_harmonic_packing"](spark, folder).collect()) < 0.03
