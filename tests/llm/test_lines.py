"""Line dedup against brute force over all pairs of lines."""

import random

import duckdb
import numpy as np

from feldspar.llm import lines
from feldspar.llm.queries import QUERIES


def distance(a, b):
    return duckdb.execute("SELECT levenshtein(?, ?)", [a, b]).fetchone()[0]


def brute(rows):
    """(id, text, lines, dropped) of rows in their order of id."""
    names = {lines.normal(x) for _, t in rows for x in (t or "").split("\n")} - {""}
    names = sorted(names)
    hashes = np.array([int(lines.simhashes([n])[0]) for n in names], np.int64).view(np.uint64)
    group = list(range(len(names)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(names)):
        bits = np.bitwise_count(hashes[i + 1 :] ^ hashes[i])
        for j in np.nonzero(bits <= lines.BITS)[0] + i + 1:
            longer = max(len(names[i]), len(names[j]))
            if distance(names[i], names[j]) <= int(longer * (1 - lines.SIMILAR) + 1e-9):
                group[root(i)] = root(int(j))
    of, seen, out = {n: root(i) for i, n in enumerate(names)}, set(), []
    for d, t in rows:
        kept, n, m = [], 0, 0
        for x in (t or "").split("\n"):
            g = of.get(lines.normal(x))
            n += g is not None
            if g is not None and g in seen:
                m += 1
                continue
            seen.add(g) if g is not None else None
            kept.append(x)
        out.append((d, "\n".join(kept) if m else t, n, m))
    return out


def varied(seed, n):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(300)]
    pool = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 8, 20, 60, 120]))) for _ in range(40)]
    rows = []
    for i in range(n):
        some = []
        for _ in range(rng.randrange(6)):
            w = rng.choice(pool).split()
            if rng.random() < 0.6:
                w[rng.randrange(len(w))] = rng.choice(words)
            some.append(("  " if rng.random() < 0.2 else " ").join(w).upper() if rng.random() < 0.2 else " ".join(w))
            if rng.random() < 0.2:
                some.append(" \t")
        rows.append((i, "\n".join(some)))
    return rows


def test_against_brute_force(spark):
    rows = varied(2, 150) + [(500, None), (501, ""), (502, "\n\n"), (503, "é漢 line\r\né漢  LINE")]
    frame = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, n_lines string, uid int")
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in lines.dedup(frame).collect())
    want = brute(rows)
    assert sum(x[3] for x in want) > 100
    assert got == want
    assert lines.dedup(frame.limit(0)).count() == 0


def test_differing():
    rng = random.Random(8)
    for _ in range(500):
        x, y = ("".join(rng.choice("ab") for _ in range(rng.randrange(8))) for _ in range(2))
        a, b = lines.differing(x, y)
        assert distance(a, b) == distance(x, y) and not (a and b and (a[0] == b[0] or a[-1] == b[-1]))


def test_repeated_and_null_ids(spark):
    rows = [(2, "a b c\nd"), (1, "d\ne"), (1, "d\ne"), (None, "a b c"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in lines.dedup(frame).collect()), key=str)
    assert got == sorted([(1, "d\ne", 2, 0), (1, "", 2, 2), (2, "a b c", 2, 1), (None, "", 1, 1), (None, None, 0, 0)], key=str)
    kept = lines.keep_lines(frame)
    assert kept.columns == frame.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "None"]


def test_many_variants_of_a_line(spark):
    rng = random.Random(4)
    words = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(200):
        w = list(words)
        w[rng.randrange(150)] = f"v{i}"
        rows.append((i, " ".join(w if i % 3 else words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in lines.dedup(frame).collect()) == brute(rows)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in QUERIES["op10_fuzzy_lines"](spark, folder).collect())
    assert got == brute(rows)
