"""Scores after every boosting round against models cut to that many rounds."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from feldspar.operators import boosting as bo
from feldspar.operators import learn
from feldspar.operators import metrics as me


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3)).round(3)
    score = x[:, 0] + 0.5 * np.sin(3 * x[:, 1]) + rng.normal(size=400)
    data = [(i, *map(float, r), int(s > 0), float(s), int(i % 4 > 0)) for i, (r, s) in enumerate(zip(x, score))]
    data.append((400, 0.0, 0.0, 0.0, None, None, 1))
    return spark.createDataFrame(data, "id int, a double, b double, c double, y int, t double, is_train int")


def auc(pairs):
    pos, neg = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_margins_of_every_round_equal_shorter_models(rows):
    ready = learn.assemble(rows.filter("y is not null"), ["a", "b", "c"])
    estimator = GBTClassifier(labelCol="y", maxIter=4, maxDepth=2, seed=1)
    staged = bo.staged_margins(estimator.fit(ready), ready, "y")
    areas = {r["round"]: r["auc"] for r in me.roc_auc_by(staged.groupBy("round", "margin").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")), ["round"], "margin", "pos", "n").collect()}
    assert sorted(areas) == [1, 2, 3, 4]
    for r in areas:
        scored = estimator.copy({estimator.maxIter: r}).fit(ready).transform(ready)
        pairs = [(float(x["rawPrediction"][1]), x["y"]) for x in scored.select("rawPrediction", "y").collect()]
        assert areas[r] == pytest.approx(auc(pairs), abs=1e-12)
        margins = {round(m["margin"], 9): m["n"] for m in staged.filter(F.col("round") == r).groupBy("margin").agg(F.sum("n").alias("n")).collect()}
        seen = {}
        for raw, _ in pairs:
            seen[round(raw, 9)] = seen.get(round(raw, 9), 0) + 1
        assert margins == seen


def test_errors_of_every_round(rows):
    ready = learn.assemble(rows.filter("t is not null"), ["a", "b", "c"])
    estimator = GBTRegressor(labelCol="t", maxIter=3, maxDepth=2, seed=1, stepSize=0.4)
    staged = bo.staged_errors(estimator.fit(ready), ready, "t").groupBy("round").agg(F.sqrt(F.sum("error") / F.sum("n")).alias("e"))
    got = {r["round"]: r["e"] for r in staged.collect()}
    for r in (1, 2, 3):
        scored = estimator.copy({estimator.maxIter: r}).fit(ready).transform(ready)
        assert got[r] == pytest.approx(scored.agg(me.rmse("t", "prediction")).first()[0], rel=1e-12)


def test_chosen_round():
    scores = [0.5, 0.7, 0.6, 0.7, 0.65, 0.9]
    assert bo.chosen_round(scores, True, None) == 6
    assert bo.chosen_round(scores, True, 3) == 2
    assert bo.chosen_round(scores, True, 4) == 6
    assert bo.chosen_round([None, *scores], True, 3) == 3
    assert bo.chosen_round([3.0, 2.0, 2.5, 1.0], False, 2) == 4


def test_fit_reports_the_chosen_round(rows):
    model = GBTClassifier(maxIter=6, maxDepth=2, seed=1)
    one = bo.boosted_fit_cv(rows, ["a", "b", "c"], "y", model, "id", k=3, patience=2)[0].first()
    ready = learn.assemble(rows.filter("y is not null"), ["a", "b", "c"])
    train = ready.filter("is_train = 1").withColumn("fold", bo.hash_fold(F.col("id"), 3))
    scores = {name: [] for name in ("train", "test")}
    own = learn.for_label(model, "y").copy({model.maxIter: one["rounds"]})
    for f in range(3):
        fitted = own.fit(train.filter(F.col("fold") != f))
        for name, side in (("train", train.filter(F.col("fold") != f)), ("test", train.filter(F.col("fold") == f))):
            scores[name].append(learn.auc(fitted.transform(side), "y"))
    for name in scores:
        assert one[f"{name}_mean"] == pytest.approx(np.mean(scores[name]), abs=1e-9)
        assert one[f"{name}_std"] == pytest.approx(np.std(scores[name]), abs=1e-9)
    assert one["test"] == pytest.approx(learn.auc(own.fit(train).transform(ready.filter("is_train = 0")), "y"), abs=1e-9)
    assert one["metric"] == "auc" and 1 <= one["rounds"] <= 6


def test_regressor_in_blocks_of_time(rows):
    one, used = bo.boosted_fit_cv(rows, ["a", "b", "c"], "t", GBTRegressor(maxIter=3, maxDepth=2, seed=1), "id", k=2, patience=None, order=["id"])
    one = one.first()
    assert one["metric"] == "rmse" and one["rounds"] == 3 and 0 < one["train_mean"] < one["test_mean"] + 1 and used[0][0] == "a"


def test_single_class_has_no_area(spark):
    df = spark.createDataFrame([(0, 0.5, 1, 2), (0, 0.7, 1, 1), (1, 0.1, 0, 3), (1, 0.9, 2, 2), (1, 0.5, 1, 2)], "g int, s double, pos long, n long")
    got = {r["g"]: r["auc"] for r in me.roc_auc_by(df.filter("not (g = 0 and s = 0.5)"), ["g"], "s", "pos", "n").collect()}
    pairs = [(0.1, 0)] * 3 + [(0.9, 1)] * 2 + [(0.5, 1), (0.5, 0)]
    assert got[0] is None and got[1] == pytest.approx(auc(pairs))


def test_forest_rows_are_dealt_out_by_their_counts_per_tree(rows, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier

    monkeypatch.setattr(learn, "FOREST_CELLS", 500, raising=False)
    seen, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df: (seen.append((df.rdd.getNumPartitions(), df.count())), fit(self, df))[1])
    one = rows.filter("y is not null").coalesce(1)
    out = learn.validate_multilabel(one, ["a", "b", "c"], ["y"], learn.random_forest(10, 2))[0].first()
    assert seen == [(6, 300)] and out["auc_trn"] > 0.8  # 300 train rows of 10 trees in parts of 500
    assert learn.in_parts(one, GBTClassifier()).rdd.getNumPartitions() == 1
