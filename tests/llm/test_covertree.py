"""Cover-tree links against brute force over all pairs."""

import numpy as np

from feldspar.llm import covertree
from feldspar.llm.queries import QUERIES


def brute(rows, threshold=0.93):
    n = len(rows)
    fine = [i is not None and g is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v) for i, g, v in rows]
    link = [set() for _ in rows]
    for a in range(n):
        for b in range(n):
            if a != b and fine[a] and fine[b] and rows[a][1] == rows[b][1] and len(rows[a][2]) == len(rows[b][2]):
                x, y = np.array(rows[a][2], float), np.array(rows[b][2], float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    link[a].add(b)
    out, seen = {}, {}
    for a in range(n):
        reach, todo = {a}, [a]
        while todo:
            for b in link[todo.pop()] - reach:
                reach.add(b)
                todo.append(b)
        ids = [rows[i][0] for i in reach if rows[i][0] is not None]
        out.setdefault(rows[a][0], []).append((len(link[a]), min(ids) if ids else None))
    return {k: sorted(v) for k, v in out.items()}


def of(frame):
    out = {}
    for r in frame.collect():
        assert r.kept == (r.vec_id == r.component_id)
        out.setdefault(r.vec_id, []).append((r.n_links, r.component_id))
    return {k: sorted(v) for k, v in out.items()}


def cloud(seed, n, dim=8):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0 or not rows:
            v = rng.normal(size=dim)
        else:
            v = np.array(rows[rng.integers(len(rows))][2]) + rng.normal(size=dim) * rng.choice([0.0, 0.05, 0.2, 0.4])
        rows.append((i * 7 % n, int(i % 2), (v * rng.uniform(0.1, 5)).astype(np.float32).tolist()))
    return rows


def test_against_brute_force(spark, monkeypatch):
    rows = cloud(1, 260) + [(900, None, [1.0] * 8), (901, 1, None), (902, 1, [0.0] * 8), (903, 0, [float("nan")] + [1.0] * 7), (904, 0, [None] + [1.0] * 7), (905, 0, [1.0, 2.0]), (906, 0, [1.0, 2.1]), (907, 5, [1.0] * 8), (907, 5, [1.0] * 8), (None, 5, [1.0] * 8)]
    frame = spark.createDataFrame([(i, v, g, "x") for i, g, v in rows], "vec_id long, embedding array<float>, label int, kept string")
    want = brute(rows)
    assert of(covertree.link(frame)) == want
    monkeypatch.setattr(covertree, "BLOCK_ROWS", 20)
    monkeypatch.setattr(covertree, "LEAF", 3)
    assert of(covertree.link(frame)) == want
    assert covertree.link(frame.limit(0)).count() == 0


def test_dense_group_and_copies(spark, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(2)
    base = rng.normal(size=16)
    rows = [(i, 3, (base + rng.normal(size=16) * 0.12).astype(np.float32).tolist()) for i in range(250)]
    rows += [(1000 + i, 3, rows[5][2]) for i in range(40)]
    frame = spark.createDataFrame([(i, v, g) for i, g, v in rows], "vec_id long, embedding array<float>, label int")
    assert of(covertree.link(frame)) == brute(rows)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert of(QUERIES["op1_cover_tree_pairs"](spark, folder)) == brute(rows)
