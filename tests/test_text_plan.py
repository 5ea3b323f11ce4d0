"""TF-IDF inside the row: counts, weights, empty and null texts, no exchange of documents."""

from __future__ import annotations

import math
import sys
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feldspar.functions import ngrams as ng
from feldspar.functions import text as tx
from feldspar.operators import learn as ln
from feldspar.operators import textfeatures as tf


def test_counted_terms(spark):
    df = spark.createDataFrame([(["b", "a", "b", "é", "b"],), ([],), (None,), (["x"],)], "t array<string>")
    got = [[tuple(c) for c in r[0]] for r in df.select(tx.counted(F.col("t"))).collect()]
    assert got == [[("a", 1), ("b", 3), ("é", 1)], [], [], [("x", 1)]]


def _expected(docs, sublinear, fit_all, most):
    words = {k: (train, Counter((text or "").lower().split())) for k, train, text in docs}
    fitted = [c for train, c in words.values() if fit_all or train == 1]
    total, n = Counter(), len(fitted)
    for c in fitted:
        total.update(c)
    kept = sorted(total, key=lambda t: (-total[t], t))[:most]
    idf = {t: math.log((1 + n) / (1 + sum(t in c for c in fitted))) + 1 for t in kept}
    out = {}
    for k, (_, c) in words.items():
        w = {t: (1 + math.log(c[t]) if sublinear else c[t]) * idf[t] for t in c if t in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out |= {(k, t): x / norm for t, x in w.items()}
    return out


@pytest.mark.parametrize("sublinear,fit_all,most", [(False, False, 4), (True, True, 6), (True, False, None)])
def test_weights_against_plain_python(spark, sublinear, fit_all, most):
    docs = [(i, int(i % 4 > 0), None if i == 9 else " ".join(f"W{(i * j) % 11}" for j in range(i))) for i in range(20)]
    df = spark.createDataFrame(docs, "k int, is_train int, body string").withColumn("term", F.lit("other"))
    a = tf.Analyzer(lambda c: F.filter(F.split(c, " "), lambda t: t != ""), sublinear=sublinear, max_features=most, fit_on_test=fit_all)
    got = {(r["k"], r["term"]): r["weight"] for r in tf.tfidf(df, "k", "body", a)[0].collect()}
    want = _expected(docs, sublinear, fit_all, most)
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-12 for x in want)


def test_no_terms_at_all(spark):
    df = spark.createDataFrame([(1, 1, None), (2, 0, "")], "k int, is_train int, body string")
    long, vocab = tf.tfidf(df, "k", "body", tf.word_analyzer())
    assert long.columns == ["k", "is_train", "term", "weight"] and long.count() == 0 and vocab.count() == 0


def test_documents_are_not_shuffled(spark, capsys):
    df = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("is_train"), F.concat(F.lit("word and w"), F.col("id")).alias("body"))
    long, _ = tf.tfidf(df, "k", "body", tf.word_analyzer(min_df=1))
    long.explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning" not in plan and "Window" not in plan


def test_vectors_hold_the_weights(spark):
    df = spark.createDataFrame([(i, int(i % 3 > 0), " ".join(f"w{(i * j) % 7}" for j in range(i))) for i in range(15)], "k int, is_train int, body string")
    a = tf.word_analyzer(min_df=2, max_features=5)
    long, vocab = tf.tfidf(df, "k", "body", a)
    known = tf.best_terms(vocab, 5)
    rows = tf.with_vectors(tf.document_terms(df, "k", "body", a), known, "x").select("k", "x").collect()
    got = {(r["k"], known[i][0]): w for r in rows for i, w in zip(r["x"].indices.tolist(), r["x"].values.tolist())}
    want = {(r["k"], r["term"]): r["weight"] for r in long.collect()}
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-12 for x in want)


def test_sweep_equals_a_fit_per_limit(spark):
    df = spark.createDataFrame([(i, int(i % 4 > 0), i % 2, f"w{i % 2} w{i % 3} w{i % 5} x{i}") for i in range(60)], "k int, is_train int, y int, body string")
    limits = (1.0, 0.3, 0.01)
    got = {r["mdf"]: (r["tpr"], r["fpr"]) for r in ln.min_df_sweep(df, "k", "body", "y", limits, max_features=20).collect()}
    assert set(got) == set(limits)
    for limit in limits[1:]:
        assert got[limit] == [(r["tpr"], r["fpr"]) for r in ln.min_df_sweep(df, "k", "body", "y", (limit,), max_features=20).collect()][0]
    block = tf.tfidf(df, "k", "body", tf.word_analyzer(min_df=0.3, max_features=20))
    train, test = ln.split(ln.document_vectors(df.drop("body"), "k", [block]))
    scored = ln.for_label(ln.logistic(1.0, train.count()), "y").fit(train).transform(test)
    hit = scored.agg(ln.me.positive_hit_rate("y", "prediction"), ln.me.false_discovery_rate("y", "prediction")).first()
    assert got[0.3] == tuple(hit)


def test_accents_of_every_character_without_python_workers(spark, capsys):
    every = [c for c in map(chr, range(1, sys.maxunicode + 1)) if unicodedata.category(c) not in ("Cn", "Cs")]
    texts = ["".join(every[i : i + 1000]) for i in range(0, len(every), 1000)] + ["plain", "", "e\u0301\u0323x\u00e7", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select("i", tx.strip_accents(F.col("t")).alias("s"), tx.ascii_fold(F.col("t")).alias("a"))
    got = {r["i"]: (r["s"], r["a"]) for r in out.collect()}
    for i, t in enumerate(texts):
        nfkd = unicodedata.normalize("NFKD", t or "")
        want = ("".join(c for c in nfkd if not unicodedata.combining(c)), nfkd.encode("ascii", "ignore").decode())
        assert got[i] == ((None, None) if t is None else want)
    out.explain()
    assert "Python" not in capsys.readouterr().out


@pytest.mark.parametrize("piece", [1 << 18, 7, 1])
def test_ngrams_as_numbers_equal_the_expression(spark, monkeypatch, piece):
    texts = ["aB  c", "x", "", None, "ñandú 😀😀a ß\t中文中文", "abababababab", "\u0000a\u0000a", "zz"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for low, high in ((1, 1), (2, 3), (2, 6), (3, 4)):
        rows = df.select("i", tx.one_spaced(F.col("t")).alias("b"), F.coalesce(tx.char_ngrams(F.col("t"), low, high), F.array()).alias("g")).sort("i").collect()
        want = Counter((r["i"], g) for r in rows for g in r["g"] if g)
        monkeypatch.setattr(ng, "CHARS", piece)
        got = Counter()
        column = ng.pa.array([r["b"] for r in rows], ng.pa.string())
        for a, b in ng.pieces(column):
            for g in ng.grams(column[a:b].to_pylist(), low, high):
                names = g.terms.to_pylist()
                assert len(set(names)) == len(names)
                got.update({(a + int(d), names[k]): int(c) for d, k, c in zip(g.document, g.gram, g.count)})
        assert got == want


def test_long_texts_are_sorted_by_reference(monkeypatch):
    text = ["abcabd" * 5, "cab"]
    want = [(g.terms.to_pylist(), g.document.tolist(), g.gram.tolist(), g.count.tolist()) for g in ng.grams(text, 2, 6)]
    monkeypatch.setattr(ng, "_sorted_places", lambda p, last, at, _: _by_order(p, last, at))
    assert want == [(g.terms.to_pylist(), g.document.tolist(), g.gram.tolist(), g.count.tolist()) for g in ng.grams(text, 2, 6)]


def _by_order(prefix, last, at, whole=ng._sorted_places):
    return whole(prefix, last, at, False)


def test_char_blocks_form_no_array_of_ngrams(spark, capsys):
    df = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("is_train"), F.concat(F.lit("word and w"), F.col("id")).alias("body"))
    a = tf.char_analyzer(2, 4, max_features=30)
    long, vocab = tf.tfidf(df, "k", "body", a)
    long.explain()
    assert "transform(" not in capsys.readouterr().out
    plain = tf.tfidf(df, "k", "body", tf.Analyzer(a.terms, True, (), True, 1, 30, True))
    assert sorted(vocab.select("term", "total_tf", "df").collect()) == sorted(plain[1].select("term", "total_tf", "df").collect())
    got, want = ({(r["k"], r["term"]): r["weight"] for r in x.collect()} for x in (long, plain[0]))
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-12 for x in want)


def test_count_vectorize_caches_no_terms(spark, monkeypatch):
    from pyspark.ml.feature import CountVectorizer

    monkeypatch.setattr(CountVectorizer, "fit", lambda *_: pytest.fail("caches the term arrays of all rows"))
    rows = [(1, ["a", "b", "a", ""]), (2, ["a", "c"]), (3, []), (4, None), (5, [""])]
    df = spark.createDataFrame(rows, "i int, t array<string>")
    got = {r["i"]: sorted(r["v"].values.tolist()) for r in tf.count_vectorize(df, "t", 0.4, "v").collect()}
    assert got == {1: [1.0, 2.0], 2: [1.0], 3: [], 4: [], 5: [1.0]}  # "a" and "", in 2 of 5 rows
    assert all(r["v"].numNonzeros() == 0 for r in tf.count_vectorize(df, "t", 0.9, "v").collect())


def test_count_vectorize_query_does_not_fit(spark, monkeypatch, tmp_path):
    from pyspark.ml.feature import CountVectorizer

    from feldspar.catalog import load

    monkeypatch.setattr(CountVectorizer, "fit", lambda *_: pytest.fail("caches the term arrays of all rows"))
    spark.createDataFrame([(i, f"X x w{i % 2}") for i in range(10)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = load()[0]["count_vectorize"](spark, str(tmp_path)).collect()
    assert {tuple(r[1:]) for r in rows} == {(3, 2)} and len(rows) == 10


def test_char_ngram_query_is_whole(spark, tmp_path):
    from feldspar.catalog import load

    texts = [" ".join(f"w{i * j}" for j in range(200)) for i in range(60)]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 1, 0)], "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r["term"] for r in load()[0]["tfidf_char_ngram"](spark, str(tmp_path)).select("term").distinct().collect()}
    assert got == {t[i : i + n] for t in texts for n in range(2, 7) for i in range(len(t) - n + 1)} and len(got) > 5000


def test_ngrams_are_added_up_before_the_shuffle(spark, monkeypatch):
    df = spark.range(0, 40, 1, 1).select(F.col("id").alias("k"), F.lit(1).alias("is_train"), F.concat(F.lit("word and w"), F.col("id") % 4).alias("__text"))
    monkeypatch.setattr(ng, "CHARS", 30)
    rows = tf.gram_counts(df, 2, 4).collect()
    assert len({r["term"] for r in rows}) == len(rows)
    want = Counter(t[i : i + n] for r in df.collect() for t in [r["__text"]] for n in (2, 3, 4) for i in range(len(t) - n + 1))
    assert {r["term"]: r["tf"] for r in rows} == want
    assert {r["term"]: r["df"] for r in rows}["wo"] == 40 and want["w0"] == 10


def test_cells_come_by_document():
    rng = ng.np.random.default_rng(3)
    cells = rng.permutation([(d, p, 1 + (d + p) % 7) for d in range(30) for p in range(0, 50, 1 + d % 3)]).T.astype("int64")
    for large in (0, 1 << 40):
        document, place, count = ng.by_document(cells[0] + large, cells[1] + large, cells[2])
        assert (ng.np.lexsort((place, document)) == range(len(place))).all() and (count == 1 + (document + place - 2 * large) % 7).all()
    assert [len(x) for x in ng.by_document(*cells[:, :0])] == [0, 0, 0]


def test_weights_travel_in_one_row_per_text(spark):
    df = spark.createDataFrame([(1, 1, "abab c"), (2, 0, ""), (3, 0, None), (4, 1, "zz")], "k long, is_train int, __text string")
    a = tf.char_analyzer(2, 3, 50)
    got = {r["k"]: r for r in tf.gram_cells(df, [("ab", 2.0), ("ba", 1.0), ("aba", 1.0)], a).collect()}
    x = [(1 + math.log(2)) * 2, 1.0, 1.0]
    norm = math.sqrt(sum(w * w for w in x))
    assert got[1]["__at"] == [0, 1, 2] and got[1]["__w"] == pytest.approx([w / norm for w in x])
    assert all(got[k]["__at"] == [] and got[k]["__w"] == [] for k in (2, 3, 4))
