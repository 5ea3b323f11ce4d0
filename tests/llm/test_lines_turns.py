"""Keys of lines that travel without SimHashes, and large texts taken in turns and goes: the same pairs and the same lines dropped."""

import random

import numpy as np
import pyarrow as pa
import pytest

from feldspar.llm import lines


def some_lines(n=600):
    rng = random.Random(7)
    base = [lines.normal(" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(4, 60)))) for _ in range(n)]
    near = [lines.normal(x.replace("w1", "v1", 1) + " z") for x in base[: n // 3]]
    return base, near, [base[n // 2].replace(" ", f" x{i} ", 1) for i in range(2 * lines.LIST)]


def test_names_alone_give_the_same_pairs():
    texts = some_lines()
    texts = [*texts, texts[0][:50]]
    sent = {told: [lines._sent({lines.line_hash(x): x for x in some}, 3, told) for some in texts] for told in (True, False)}
    many = {told: lines._sent({lines.line_hash(x): x for x in texts[0]}, 50, told).column(1).nbytes for told in (True, False)}
    assert many[False] < 0.75 * many[True]
    known = {lines.line_hash(x): x for some in texts for x in some}
    want, got, rows = [], [], 0
    for bucket in range(3):
        take = lambda told: (t := pa.Table.from_batches(sent[told])).filter(pa.compute.equal(t["bucket"], bucket))
        want += lines._met(take(True)).to_pylist()
        shared = lines._shared(take(False))
        rows += shared.num_rows
        h = shared["h"].to_numpy()
        held = [known[x] for x in h.tolist()]
        copies = [sum(x in some for some in texts) for x in held]
        more = {"s": lines.simhashes(held), "l": np.array([len(x) for x in held], np.int32), "n": np.array(copies, np.int32)}
        for c, x in more.items():
            shared = shared.append_column(c, pa.array(x))
        got += lines._met_told(shared).to_pylist()
    keys = sum(len(lines.gram_keys(some)[0]) for some in texts)
    assert 0 < rows < keys / 2
    order = lambda x: sorted(x, key=lambda r: str(list(r.values())))
    assert any(r["e"] is not None for r in want) and order(want) == order(got)


def test_turns_have_every_key_once():
    texts = sum(some_lines(), [])
    whole = sorted(zip(*(x.tolist() for x in lines.gram_keys(texts))))
    parts = [sorted(zip(*(x.tolist() for x in lines.gram_keys(texts, i, 3)))) for i in range(3)]
    assert sorted(sum(parts, [])) == whole and all(len(p) < 0.5 * len(whole) for p in parts)


@pytest.mark.parametrize("turns", [1, 3])
def test_large_texts_drop_the_same_lines(spark, monkeypatch, turns):
    rng = random.Random(1)
    texts = sum(some_lines(90), [])
    docs = spark.createDataFrame([(i, "\n".join(rng.choice(texts) for _ in range(3))) for i in range(60)], "doc_id long, text string")
    want = sorted(map(tuple, lines.dedup(docs).collect()))
    size = sum(len(r.text) for r in docs.collect())
    taken, real = [], lines._meetings
    monkeypatch.setattr(lines, "_meetings", lambda *a: taken.append((a, met := real(*a))) or met)
    for name, value in (("TOLD_BUCKETS", 0), ("SHARED_ROWS", 100), ("SHARED_GO", 200), ("SHARED_SHARE", size), ("TURN_BYTES", size // turns + 1), ("GO_SHARE", 0), ("GO_LEAST", 20_000)):
        monkeypatch.setattr(lines, name, value)
    got = sorted(map(tuple, lines.dedup(docs).collect()))
    assert len(taken) == turns and all(a[1] is not None and len(met) > 1 for a, met in taken)
    assert got == want and sum(r[-1] for r in got) > 60
