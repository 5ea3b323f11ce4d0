"""Multiprobe hashing against brute force: recall, exact scores, odd vectors."""

import numpy as np

from feldspar.llm.ann import nearest
from feldspar.llm.queries import QUERIES


def brute(rows, top=20, every=20):
    x = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)}
    out = {}
    for q in x:
        if q % every == 0:
            out[q] = sorted(((float(np.sum(x[q] * v)), i) for i, v in x.items() if i != q), key=lambda s: (-s[0], s[1]))[:top]
    return out


def by_query(rows):
    out = {}
    for r in rows:
        out.setdefault(r.query_id, {})[r.rank] = (r.score, r.vec_id)
    return {q: [x[k] for k in sorted(x)] for q, x in out.items()}


def test_recall_and_scores(spark):
    folder = "/root/testdata/sf0.1"
    want = brute([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()])
    got = by_query(QUERIES["op9_multiprobe_hashing"](spark, folder).collect())
    assert set(got) == set(want) and all(len(x) == 20 for x in got.values())
    hits = sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9
    exact = {(q, i): s for q in want for s, i in want[q]}
    for q, x in got.items():
        assert x == sorted(x, key=lambda s: (-s[0], s[1])) and q not in [i for _, i in x]
        assert all(abs(exact.get((q, i), s) - s) < 1e-12 for s, i in x)


def test_few_rows_and_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (20, [3.0, 1.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (9, [-1.0, 5.0]), (40, [0.0, 0.0])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, rank string, id int")
    assert by_query(nearest(frame).collect()) == brute(rows)
    assert nearest(frame.limit(0)).count() == 0
    assert nearest(frame.where("vec_id = 20")).count() == 0


def test_many_copies_and_norms(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 16)) * rng.uniform(0.2, 3, size=(1500, 1))
    x[100:700] = x[99]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want, got = brute(rows), by_query(nearest(frame).collect())
    hits = sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    for q in (120, 300):
        assert [i for _, i in got[q]] == [i for _, i in want[q]]


def test_repeated_ids_are_ranked_once(spark):
    """One id with many different vectors takes one place, that of its best score."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(116, 8))
    ids = [0] + [1] * 59 + list(range(2, 58))
    rows = [(i, (v * (3 if i == 1 else 1)).tolist()) for i, v in zip(ids, x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r["rank"], r.score) for r in nearest(frame).where("query_id = 0").collect()}
    scores = {}
    for i, v in zip(ids[1:], np.array([r[1] for r in rows[1:]])):
        scores[i] = max(scores.get(i, -np.inf), float(x[0] @ v))
    want = sorted(scores, key=lambda i: (-scores[i], i))[:20]
    assert len(got) == 20 and len(set(got) & set(want)) >= 18
    assert all(abs(s - scores[i]) < 1e-9 for i, (_, s) in got.items()) and sorted(r for r, _ in got.values()) == list(range(1, 21))
