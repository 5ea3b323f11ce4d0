"""Links against brute force over all pairs of sets of real shingles."""

import random
import re

import pytest

from feldspar.llm import jaccard
from feldspar.llm.queries import QUERIES


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """Sorted (id, size, component) of all rows."""
    found = [shingle_set(t) for _, t in rows]
    by_element, link = {}, [set() for _ in rows]
    for i, s in enumerate(found):
        for e in s:
            by_element.setdefault(e, []).append(i)
    for i, s in enumerate(found):
        for j in {j for e in s for j in by_element[e] if j != i}:
            both = len(s & found[j])
            if 100 * both >= 80 * (len(s) + len(found[j]) - both):
                link[i].add(j)
    out = []
    for i, (d, _) in enumerate(rows):
        reach, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()] - reach:
                reach.add(j)
                todo.append(j)
        out.append((d, len(found[i]), min((rows[j][0] for j in reach if rows[j][0] is not None), default=None)))
    return sorted(out, key=str)


def of(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=str)


def varied(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    rows = []
    for i in range(n):
        kind = rng.randrange(6)
        if kind < 3 and rows:
            w = (rng.choice(rows)[1] or "a b").split()
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(w) + 1)
                w[at : at + rng.randrange(2)] = [rng.choice(words)] * rng.randrange(2)
            text = " ".join(w)
        elif kind == 3:
            text = passage + " " + " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30)))
        else:
            text = "  \n".join(rng.choice(words).upper() for _ in range(rng.choice([1, 3, 4, 5, 6, 8, 9, 10, 12, 15, 18, 25, 60, 200])))
        rows.append((i, text))
    return rows


def test_bounds():
    for a in range(1, 60):
        for b in jaccard.partners(a):
            assert 100 * jaccard.overlap(a, b) >= 80 * (a + b - jaccard.overlap(a, b)) or jaccard.overlap(a, b) > min(a, b)
            assert jaccard.prefix(a) >= a - jaccard.overlap(a, b) + 1 or jaccard.overlap(a, b) > min(a, b)


@pytest.mark.parametrize("boundary", [None, 0, 14])
def test_against_brute_force(spark, monkeypatch, boundary):
    rows = varied(4, 260) + [(900, None), (901, ""), (902, " \t\n"), (None, "no id at all here six words"), (None, "no id at all here six words"), (3, "same id but some other words here"), (903, "same id but some other words here")]
    rows += [(1000 + i, " ".join(f"x{j}" if j != i else "y" for j in range(60))) for i in range(25)]
    if boundary is not None:
        monkeypatch.setattr(jaccard, "boundary_of", lambda sizes, mean: boundary)
    monkeypatch.setattr(jaccard, "SHARE", 2)
    if boundary == 0:
        monkeypatch.setattr(jaccard, "LONG_LIST", 3)
        monkeypatch.setattr(jaccard, "BLOCK_SETS", 4)
    frame = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, n int, k string")
    want, got = brute(rows), of(jaccard.link(frame))
    assert [x for x in got if x[0] != 3] == [x for x in want if x[0] != 3]
    if boundary is None:
        assert jaccard.link(frame.limit(0)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert of(QUERIES["op2_size_aware_jaccard"](spark, folder)) == brute(rows)
