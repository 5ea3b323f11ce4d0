"""Runs equal those of a search of every period at every place."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from feldspar.llm import periodic
from feldspar.llm.periodic import collapse, runs_of
from feldspar.llm.queries import QUERIES


def brute(words):
    """{(start, length, period)}: all periods, smallest per stretch."""
    out, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return {(*k, q) for k, q in out.items()}


def runs(*texts):
    x, sizes = [], []
    for i, t in enumerate(texts):
        x += [*[ord(c) if isinstance(c, str) else c for c in t], -1 - i]
        sizes.append(len(t))
    begins = np.cumsum([0] + [s + 1 for s in sizes])
    found = [set() for _ in texts]
    for start, length, period in runs_of(np.array(x, np.int64), np.array(sizes, np.int64)).tolist():
        d = int(np.searchsorted(begins, start, "right")) - 1
        assert (start - begins[d], length, period) not in found[d]
        found[d].add((start - int(begins[d]), length, period))
    return found


def nested(rng, depth):
    """Words that repeat themselves within repeats, with single changes."""
    t = rng.integers(0, 3, rng.integers(1, 5)).tolist()
    for _ in range(depth):
        t = t * int(rng.integers(1, 5)) + rng.integers(0, 3, rng.integers(0, 3)).tolist()
        if rng.random() < 0.5:
            t[int(rng.integers(len(t)))] = int(rng.integers(0, 4))
        cut = int(rng.integers(0, min(len(t), 9)))
        t = t[cut:][:900]
    return t


@pytest.mark.parametrize("seed", range(12))
def test_random_texts(seed):
    rng = np.random.default_rng(seed)
    texts = [rng.integers(0, k, n).tolist() for k in (1, 2, 3, 4) for n in (0, 1, 11, 12, 40, 150, 400)]
    texts += [nested(rng, d) for d in (1, 2, 3, 4, 5, 6) for _ in range(8)]
    for text, found in zip(texts, runs(*texts)):
        assert found == brute(text), text


def test_runs_of_short_periods_that_touch():
    """The first period of such runs is itself periodic, so no minimizer lies in it."""
    texts = []
    for p in (2, 3, 5, 7):
        root = list(range(p))
        for n in (20, 33, 64, 100, 131):
            left, right = (root * n)[:n], (root * n)[1 : n + 1]
            texts += [left + right, left + right + [50], [50] + left[3:] + right + left, left + [40] + left + [40] + left[: n // 2]]
    fib = ["a", "ab"]
    while len(fib[-1]) < 900:
        fib.append(fib[-1] + fib[-2])
    texts += [fib[-1], "".join("ab"[bin(i).count("1") % 2] for i in range(512)), "ab" * 60 + "ba" * 70 + "ab" * 65]
    for text, found in zip(texts, runs(*texts)):
        assert found == brute(text), text


@pytest.mark.parametrize("period", [15, 16, 17, 31, 32, 33, 63, 64, 100, 255, 256, 257, 500])
def test_every_scale_in_noise(period):
    rng = np.random.default_rng(period)
    block = rng.integers(0, 10**6, period).tolist()
    for copies in (2.0, 2.3, 4.7):
        noise = rng.integers(10**6, 10**7, 60).tolist()
        text = noise[:30] + (block * 5)[: int(period * copies)] + noise[30:]
        assert runs(text)[0] == brute(text) and (copies * period < 12 or runs(text)[0])


def test_long_text_of_one_word():
    assert runs([7] * 300_000) == [{(0, 300_000, 1)}]


def test_long_text_of_long_equal_stretches():
    text = ([1] * 5000 + [2]) * 8
    assert runs(text)[0] == {(i * 5001, 5000, 1) for i in range(8)} | {(0, 40008, 5001)}


def check(rows, docs):
    assert len(rows) == len(docs)
    got = sorted(map(repr, ((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows)))
    expected = []
    for doc_id, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        found = sorted(brute(w), key=lambda r: (r[0], r[2]))
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        expected.append((doc_id, len(w), found, " ".join(x for i, x in enumerate(w) if i not in gone)))
    assert got == sorted(map(repr, expected))


def test_nulls_repeats_and_clashing_names(spark, monkeypatch):
    docs = [(1, None), (2, ""), (3, " \t\n"), (None, "a b " * 9), (5, "x " * 11), (5, "x " * 12), (5, "x " * 12), (6, "é e\x0b\x0cü " * 20)]
    docs += [(7, "lead " + "one two three four five six seven " * 3 + "tail"), (8, "words that do not repeat at all")]
    table = spark.createDataFrame([(*d, "r", 1) for d in docs], "doc_id long, text string, runs string, n_words int")
    check(collapse(table).collect(), docs)
    assert collapse(table.limit(0)).collect() == []


def test_chunks(spark, monkeypatch):
    texts = [b"a b c " * i for i in range(1, 40)]
    whole = [(w, r.tolist()) for w, r in periodic._found(texts)]
    monkeypatch.setattr(periodic, "CHUNK_WORDS", 50)
    assert [(w, r.tolist()) for w, r in periodic._found(texts)] == whole


def test_query(spark):
    """Rows of the smallest table, from its texts alone."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, folder).collect()}
    assert len(rows) == len(docs)
    some = 0
    for d in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        n, h = len(words), zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 3000:
            continue
        found = sorted(brute(words), key=lambda r: (r[0], r[2]))
        gone = {i for s, m, q in found for i in range(s + q, s + m)}
        r = rows[d.doc_id]
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert r.n_runs == len(found)
        assert r.runs_sha256 == digest("".join(f"{s},{m},{q}\n" for s, m, q in found))
        assert r.collapsed_sha256 == digest(" ".join(w for i, w in enumerate(words) if i not in gone))
        best = min(found, key=lambda f: (-f[1], f[0], f[2]), default=None)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        some += bool(best)
    assert some > 5
