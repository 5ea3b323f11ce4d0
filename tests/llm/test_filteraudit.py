"""The audit equals one that runs every order of filters row by row."""

import re
from itertools import permutations

from feldspar.llm.filteraudit import audit

DOCS = "doc_id long, text string, source string, removed int, uid string, prefix int"
LABELS = "doc_id long, quality int, toxic int, part string"


def brute(docs, labels):
    good = {r[0] for r in labels if r[1] == 1 and r[0] is not None}
    bad = {r[0] for r in labels if r[2] == 1 and r[0] is not None}
    rows = []
    for doc_id, text, source in (r[:3] for r in docs):
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(w) < 50,
            "B": 100 * len(set(w)) < 65 * len(w),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and any(r[0] is not None and r[0] < doc_id and (r[1] or "") == text for r in docs),
        }
        rows.append((source or "", {f for f in fails if fails[f]}, doc_id in good, doc_id in bad))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                here = [r for r in mine if f in r[1] and not r[1] & before]
                out[part, "".join(order), k + 1] = (
                    sum(not r[1] & {*before, f} for r in mine), len(here), sum(f in r[1] and bool(r[1] & before) for r in mine),
                    sum(r[1] == {f} for r in mine), sum(r[2] for r in here), sum(r[3] for r in here),
                )
    shapley = {}
    for (part, order, step), v in out.items():
        shapley[part, order[step - 1]] = shapley.get((part, order[step - 1]), 0) + v[1]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def check(spark, docs, labels):
    got = audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got}
    assert len(found) == len(got) and found == brute(docs, labels)


def test_all_orders_with_nulls_repeats_and_clashing_names(spark):
    plain = " ".join(f"word{i}" for i in range(60))
    texts = [plain, plain, None, "", "A B", plain + " $", "same " * 70, "SAME " * 70, plain + " x", plain.upper() + " #", "\U0001f600 |", "x\x0by " * 30]
    docs = [(i, t, ["s", None, "", "t"][i % 4], 1, "u", 7) for i, t in enumerate(texts * 2)]
    docs += [(None, plain, "s", None, None, None), (None, plain, "s", None, None, None), (3, None, "t", 0, "", 0), (3, None, "t", 0, "", 0)]
    labels = [(i, i % 3 - 1, i % 2, "p") for i in range(20)] + [(None, 1, 1, "p"), (5, None, None, "p"), (5, 1, 1, "p"), (5, 1, 1, "q")]
    check(spark, docs, labels)


def test_long_text_and_hot_copies(spark):
    docs = [(i, "one common text", "s", 0, "", 0) for i in range(400)] + [(1000, "word Word " * 100_000, "s", 0, "", 0)]
    check(spark, docs, [])


def test_empty_table(spark):
    assert audit(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).collect() == []
