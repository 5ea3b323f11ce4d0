"""Scores of stacked TF-IDF blocks: vectors are formed inside the row, and equal those of the long form."""

import pytest
from pyspark.sql import functions as F

from feldspar.operators import learn as ln
from feldspar.operators import textfeatures as tf

ANALYZERS = [tf.char_analyzer(2, 4, 300), tf.sublinear_word_analyzer(("the",), 40), tf.word_analyzer(min_df=0.1, max_features=30)]


@pytest.fixture(scope="module")
def docs(spark):
    words = "the cat dog élan runs slowly home again 12 ab".split()
    rows = [(i, int(i % 4 > 0), " ".join(words[(i * j + j // 2) % 10] for j in range(1, 3 + i % 9)), i % 2 if i % 7 else None, int(i % 3 == 0)) for i in range(120)]
    rows += [(200, 1, "", 0, 1), (201, 1, None, 1, 0), (202, 0, None, None, None)]
    return spark.createDataFrame(rows, "k long, is_train int, body string, t int, u int")


def test_scores_equal_those_of_the_long_form(spark, docs):
    blocks = [tf.tfidf(docs, "k", "body", a) for a in ANALYZERS]
    long = ln.materialize(ln.document_vectors(docs.drop("body"), "k", blocks))
    train = long.filter("is_train = 1")
    got, new = ln.tfidf_lr_score(docs, "k", "body", ["t", "u"], ANALYZERS, max_iter=30)
    assert new == ["t_tfidf_lr", "u_tfidf_lr"] and got.columns == ["k", "is_train", "t", "u", *new]
    got = {r["k"]: r for r in got.collect()}
    for t in ("t", "u"):
        model = ln.for_label(ln.logistic(0.1, train.count(), 30), t).fit(train.filter(F.col(t).isNotNull()))
        want = {r["k"]: r["p"] for r in model.transform(long).select("k", ln.probability_of_one().alias("p")).collect()}
        assert want.keys() == got.keys() and len(want) == 123
        assert all(got[k][f"{t}_tfidf_lr"] == pytest.approx(p, abs=1e-9) for k, p in want.items())


def test_scores_explode_and_exchange_no_cells(spark, docs, monkeypatch, capsys):
    monkeypatch.setattr(tf, "sparse_vector", lambda *_: pytest.fail("vectors are printed and parsed"))
    monkeypatch.setattr(tf, "stack_features", lambda *_: pytest.fail("cells are exploded and collected by key"))
    written, real = [], ln.stored
    monkeypatch.setattr(ln, "stored", lambda df, schema: written.append(df) or real(df, schema))
    out, _ = ln.tfidf_lr_score(docs, "k", "body", ["t"], ANALYZERS, max_iter=3)
    assert len(written) == 1 and written[0].count() == docs.filter("is_train = 1").count()
    for df in (written[0], out):
        df.explain()
        plan = capsys.readouterr().out
        assert "Generate" not in plan and "hashpartitioning" not in plan and "Join" not in plan


def test_norms_are_not_worked_out_for_every_weight():
    lists = tf.pa.array([[3.0, 4.0], [], [2.0]])
    assert tf._unit(lists).to_pylist() == [[0.6, 0.8], [], [1.0]] and tf._unit(lists.slice(1, 2)).to_pylist() == [[], [1.0]]


def test_query_has_the_whole_settings(spark, monkeypatch):
    from feldspar.catalog import load

    seen = []
    monkeypatch.setattr(ln, "tfidf_lr_score", lambda df, key, text, targets, analyzers, c=0.1, max_iter=100: seen.append((analyzers, max_iter)) or (df.select("doc_id"), []))
    load()[0]["tfidf_lr_score"](spark, "/root/testdata/sf0.001")
    (char, word), most = seen[0]
    assert (char.ngrams, char.max_features, word.max_features, most) == ((2, 6), 50_000, 10_000, 100)


def test_recipe_fits_its_words_once(spark, monkeypatch):
    from feldspar.operators import recipes

    fitted, real = [], tf.fitted
    monkeypatch.setattr(tf, "fitted", lambda *a: fitted.append(a) or real(*a))
    rows = [(i, int(i % 3 > 0), f"some word{i % 5} and w{i % 2} here" + " more" * (i % 4), i % 2 if i % 3 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, is_train int, body string, t int")
    out = recipes.text_features_to_predictions(df, "k", "body", ["t"], min_df=0.1, n_words=5, score_iterations=5).collect()
    assert len(fitted) == 1 and sorted(r["k"] for r in out) == [i for i in range(60) if i % 3 == 0]
