"""The string kernel against a plain sum over subsequences, held-out accuracy, odd rows."""

import itertools
import math
import zlib

import pytest

from feldspar.llm import toxicity
from feldspar.llm.queries import QUERIES


def plain(s):
    out = {}
    for i, j, k in itertools.combinations(range(len(s)), 3):
        if k - i < toxicity.WINDOW:
            out[s[i] + s[j] + s[k]] = out.get(s[i] + s[j] + s[k], 0) + toxicity.DECAY ** (k - i - 2)
    each = math.sqrt(sum(toxicity.DECAY ** (2 * (k - i - 2)) for i, j, k in itertools.combinations(range(len(s)), 3) if k - i < toxicity.WINDOW))
    return {u: v / each for u, v in out.items()} if each else {}


@pytest.mark.parametrize("a,b", [("^idiot$", "^id-iot$"), ("^moron$", "^moron$"), ("^a$", "^b$"), ("^scum$", "^s.c.u.m$"), ("^banana$", "^bananas$")])
def test_kernel(a, b):
    x, y = plain(a), plain(b)
    want = sum(v * y.get(u, 0) for u, v in x.items())
    assert toxicity.Kernel([a]).values([b])[0, 0] == pytest.approx(want)


def test_spans():
    assert toxicity.spans("You i d i o t now") >= {"idiot", "you", "now"}
    assert toxicity.spans(None) == toxicity.spans(" \n") == set()
    assert toxicity.parts("--") == [] and len(toxicity.parts("x" * 100)) > 3


def test_learns_gapped_insults(spark):
    import random

    rng = random.Random(5)
    words = ["".join(rng.choice("aeiounrstl") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    bad = ["wretchy", "gromblik", "pozzfut"]
    docs, labels = [], []
    for i in range(400):
        text = [rng.choice(words) for _ in range(60)]
        if i % 4 == 0:
            text[rng.randrange(60)] = rng.choice(bad)
        docs.append((i, " ".join(text), "x", 0.5))
        labels.append((i, 1 if i % 4 == 0 else 0, 1))
    clean = " ".join(rng.choice(words) for _ in range(50))
    odd = {1000: "w r e t c h y", 1001: "grom-blik " + clean, 1002: "po.zzfut", 1003: clean, 1004: "", 1005: None, 1006: "wretxchy " + clean, 1007: "z" * 200_000, 1008: clean + " GROMBLIK!"}
    docs += [(k, t, None, None) for k, t in odd.items()] + [(None, clean, None, None), (1003, clean, None, None)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, toxic string, score double")
    labels = spark.createDataFrame([*labels, (None, 1, 1), (3, None, 1), (7, 0, 0)], "doc_id long, toxic int, quality int")
    got = toxicity.detect(docs, labels)
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    said = {r.doc_id: r.predicted for r in rows if r.doc_id is None or r.doc_id >= 1000}
    assert {k for k, v in said.items() if v} == {1000, 1001, 1002, 1006, 1008}
    old = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 1000]
    assert {r.doc_id for r in old} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in old)
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and {1003, 1004, 1005, 1007} <= {r.doc_id for r in kept.collect()}
    assert toxicity.detect(docs.limit(0), labels).count() == 0
    assert {r.score for r in toxicity.detect(docs, labels.limit(0)).collect()} == {0.0}


def test_query_held_out(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = [r for r in QUERIES["op3_subsequence_kernel"](spark, folder).collect() if r.held_out and r.doc_id in truth]
    toxic = [r.score for r in got if truth[r.doc_id]]
    clean = [r.score for r in got if not truth[r.doc_id]]
    auc = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert auc > 0.75  # 34 toxic documents to learn from, in four languages
