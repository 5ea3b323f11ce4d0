"""Recall of line links against edit similarity alone, without any test of bits."""

import random

import pytest
from test_lines import distance

from feldspar.llm import lines

BANDS = ((5, 40), (40, 100), (100, 200), (200, 500), (500, 900))


def edited(rng, x, changes):
    x = list(x)
    for _ in range(changes):
        i, kind = rng.randrange(len(x)), rng.random()
        if kind < 0.5:
            x[i] = rng.choice([c for c in "abcdefghijklmnopqrstuvwxyz" if c != x[i]])
        elif kind < 0.75:
            x.insert(i, rng.choice("abcdefghijklmnopqrstuvwxyz"))
        elif len(x) > 1:
            del x[i]
    return lines.normal("".join(x))


@pytest.mark.parametrize("most", [0, 0.2])
def test_recall_by_length(spark, most):
    """``most`` 0: one letter changed; else a share of letters drawn evenly up to it."""
    rng = random.Random(11)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    docs, pairs = [], []
    for low, high in BANDS:
        for _ in range(150):
            size, x = rng.randrange(low, high), ""
            while len(x) < size:
                x += rng.choice(words) + " "
            x = x[:size].strip()
            y = edited(rng, x, max(1, int(rng.random() * most * len(x))))
            if x != y and distance(x, y) <= int(max(len(x), len(y)) * (1 - lines.SIMILAR) + 1e-9):
                pairs.append((low, 2 * len(pairs) + 1))
                docs += [(pairs[-1][1] - 1, x), (pairs[-1][1], y)]
    got = {r.doc_id: r.n_dropped for r in lines.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for low, _ in BANDS:
        found = [got[d] for at, d in pairs if at == low]
        assert len(found) > 40 and sum(found) >= 0.9 * len(found), (low, sum(found), len(found))
