"""The keys of lines as they are shuffled, the pairs a bucket finds in them, and the distances that decide pairs."""

import random

import numpy as np
import pyarrow as pa

from feldspar.llm import lines


def plain(x, y):
    row = list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        above, row = row, [i]
        for j, d in enumerate(y, 1):
            row.append(min(above[j - 1] + (c != d), above[j] + 1, row[-1] + 1))
    return row[-1]


def some_pairs(rng, n, sizes):
    for _ in range(n):
        x = "".join(rng.choice("abcé漢\U0001f600") for _ in range(rng.choice(sizes)))
        y = list(x)
        for _ in range(rng.randrange(len(x) + 2)):
            i = rng.randrange(len(y))
            y[i : i + rng.choice([0, 1, 1])] = rng.choice(["", "a", "z"]) if len(y) > 1 else "b"
        yield x, "".join(y) or "b"


def test_distances():
    x, y = zip(*some_pairs(random.Random(3), 300, [1, 2, 5, 30, 63, 64, 65, 100, 130]))
    want, apart = np.array([plain(*z) for z in zip(x, y)]), np.array([abs(len(u) - len(v)) for u, v in zip(x, y)])
    assert not lines.unlike(x, y, want).any() and lines.unlike(x, y, apart - 1).all()
    for share in (0, 0.1, 0.3, 1):
        most = np.maximum(apart, (share * np.array([max(len(u), len(v)) for u, v in zip(x, y)])).astype(int))
        for at in range(0, 300, 50):
            part = slice(at, at + 50)
            got = lines.distances(x[part], y[part], most[part])
            one = np.array([lines.distance(*z) for z in zip(x[part], y[part], most[part].tolist())])
            for d in (got, one):
                assert np.array_equal(np.minimum(d, most[part] + 1), np.minimum(want[part], most[part] + 1))


def test_similar():
    rng = random.Random(5)
    x, y = zip(*some_pairs(rng, 400, [5, 40, 90]))
    most = [int(max(len(u), len(v)) * (1 - lines.SIMILAR) + 1e-9) for u, v in zip(x, y)]
    want = [plain(*z) <= k for *z, k in zip(x, y, most)]
    assert 20 < sum(want) < 380 and lines.similar(x, y).tolist() == want


def test_votes_of_long_lines():
    rng = np.random.default_rng(1)
    sizes = np.array([1, 254, 255, 256, 2000])
    hashes = rng.integers(0, 2**64, sizes.sum(), np.uint64)
    bits = (hashes[:, None] >> np.arange(63, -1, -1, dtype=np.uint64) & np.uint64(1)).astype(int)
    ends = np.cumsum(sizes)
    assert np.array_equal(lines._votes(hashes, sizes), [(2 * bits[e - n : e] - 1).sum(0) for e, n in zip(ends, sizes)])


def test_keys_are_packed_and_met():
    rng = random.Random(7)
    base = [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(200)]
    near = [lines.normal(x.replace("w1", "v1", 1)) for x in base[:100]]
    variants = [base[150].replace(" ", f" x{i} ", 1) for i in range(2 * lines.LIST)]
    texts = [base, base[:50] + near, variants]
    sent = [lines._sent({lines.line_hash(x): x for x in some}, 3) for some in texts]
    keys = sum(len(lines.gram_keys(some)[0]) for some in texts)
    assert sum(b.column(1).nbytes for b in sent) < 20 * keys  # a row of key, hash, SimHash, length and place takes 32
    table, pairs, rows = pa.Table.from_batches(sent), set(), 0
    for bucket in range(3):
        got = lines._met(table.filter(pa.compute.equal(table["bucket"], bucket))).to_pylist()
        pairs |= {(r["a"], r["b"]) for r in got if r["e"] is None}
        rows += sum(r["e"] is not None for r in got)
    assert rows and all(a < b for a, b in pairs)
    h = lines.line_hash
    assert all(tuple(sorted((h(x), h(y)))) in pairs for x, y in zip(base, near) if x != y)


def test_keys_are_read_batch_by_batch():
    rng = random.Random(2)
    base = [lines.normal(" ".join(f"w{rng.randrange(5000)}" for _ in range(60))) for _ in range(3000)]
    sent = [lines._sent({lines.line_hash(x): x for x in base[at : at + 200]}, 1) for at in range(0, 3000, 200)]
    whole = lines._met(pa.Table.from_batches(sent))
    assert whole.num_rows and lines._met(iter(sent)).equals(whole)


def test_far_pairs_are_left_out_early(monkeypatch):
    rng = random.Random(6)
    x, y = (["".join(rng.choice("etaoinsh ") for _ in range(600)) for _ in range(100)] for _ in range(2))
    y[:5] = [z.replace("a", "b", 20) for z in x[:5]]
    seen, real = [], lines._at_least
    monkeypatch.setattr(lines, "_at_least", lambda *a: seen.append(a[-1]) or real(*a))
    most = np.full(100, 120)
    got, want = lines.distances(x, y, most), np.array([plain(*z) for z in zip(x[:8], y[:8])])
    assert np.array_equal(np.minimum(got[:8], 121), np.minimum(want, 121)) and (got[5:] > 120).all()
    lines.distances(x[5:], y[5:], most[5:])
    assert 0 < max(seen[-3:]) < 500
