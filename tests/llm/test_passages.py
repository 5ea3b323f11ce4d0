"""What is cut equals a search of every window in every document."""

import hashlib
import re

import numpy as np
import pytest

from feldspar.llm import passages
from feldspar.llm.passages import dedup
from feldspar.llm.queries import QUERIES


def brute(docs):
    split = [(i if i is not None else float("inf"), re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    first = {}
    for i, w in split:
        for t in range(len(w) - 12):
            s = tuple(w[t : t + 13])
            first[s] = min(i, first.get(s, i))
    out = []
    for (doc_id, _), (i, w) in zip(docs, split):
        gone = {k for t in range(len(w) - 12) if first[tuple(w[t : t + 13])] < i for k in range(t, t + 13)}
        out.append((doc_id, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def check(spark, docs, partitions=None):
    table = spark.createDataFrame([(*d, 1, "x", b"y") for d in docs], "doc_id long, text string, batch int, key string, blob binary")
    got = [tuple(r) for r in dedup(table.repartition(partitions) if partitions else table).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(docs)))
    return got


def words(rng, n, k=40):
    return " ".join(f"w{x}" for x in rng.integers(0, k, n))


def test_shared_passages_in_any_order(spark):
    rng = np.random.default_rng(1)
    shared = [words(rng, n) for n in (12, 13, 14, 25, 60, 200)]
    docs = []
    for i in rng.permutation(120).tolist():
        parts = [words(rng, int(rng.integers(0, 30)))]
        for _ in range(int(rng.integers(0, 4))):
            parts += [shared[int(rng.integers(len(shared)))], words(rng, int(rng.integers(0, 9)))]
        docs.append((i - 20, "  ".join(parts)))
    got = check(spark, docs)
    assert sum(r[2] > 0 for r in got) > 30 and sum(r[2] == 0 for r in got) > 10
    check(spark, docs, 7)


def test_few_different_words(spark):
    """Short windows repeat everywhere, so that only the last level tells."""
    rng = np.random.default_rng(2)
    check(spark, [(i, words(rng, int(rng.integers(0, 80)), 2)) for i in range(60)])


def test_nulls_repeats_case_and_blanks(spark):
    text = " ".join(f"word{i}" for i in range(13))
    other = " ".join(f"more{i}" for i in range(30))
    docs = [(1, None), (2, ""), (3, " \n\t "), (4, text), (5, text.replace(" ", " \x0b\x0c\r ")), (6, text.upper()), (7, text + " tail")]
    docs += [(8, text.replace("word3", "word3 ")), (None, other), (None, other), (None, text), (9, other), (9, other), (9, "x " + other)]
    docs += [(-5, "lead " + text), (10, "é " * 40), (11, "é " * 41), (12, "é " * 12)]
    check(spark, docs)


def test_long_text_and_hot_passage(spark):
    rng = np.random.default_rng(3)
    hot = words(rng, 50)
    docs = [(i, f"{words(rng, 3)} {hot} {words(rng, 3)}") for i in range(300)]
    docs.append((1000, words(rng, 120_000, 10**6) + " " + hot))
    check(spark, docs)


def test_many_batches_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(passages, "BATCH_BYTES", 300)
    monkeypatch.setattr(passages, "BUCKET_BYTES", 100)
    monkeypatch.setattr(passages, "LEAST_BYTES", 50)
    rng = np.random.default_rng(4)
    shared = words(rng, 30)
    check(spark, [(i, f"{words(rng, 5)} {shared if i % 3 else ''} {words(rng, 20)}") for i in range(100)])


def test_empty_table(spark):
    table = spark.createDataFrame([], "doc_id long, text string")
    assert dedup(table).collect() == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op11_repeated_passages"](spark, folder).collect()))
    expected = sorted((i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in brute(docs))
    assert got == expected and any(r[2] for r in got)
