"""Boosted trees with a number of rounds chosen by cross-validation, scored after every round.

A fitted model is applied once. The leaves a row falls into give its margin after every round, as a running sum in
Arrow batches; each batch counts its rows per (round, margin), so what is shuffled are distinct margins. The areas under
all curves then come from one running count ordered by fold, round and margin.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspar.functions.numeric import hash_fold
from feldspar.operators import metrics as me
from feldspar.operators.learn import FEATURES, assemble, for_label, importances, split
from feldspar.operators.profile import q
from feldspar.operators.splits import time_series_split
from feldspar.plans.storage import materialize

Boosted = GBTClassifier | GBTRegressor


def leaf_values(model) -> np.ndarray:
    """What each leaf of each tree adds to the margin: a row per tree, leaves from left to right."""
    trees = [[float(v) for v in re.findall(r"Predict: (\S+)", tree.toDebugString)] for tree in model.trees]
    table = np.zeros((len(trees), max(map(len, trees))))
    for row, values, weight in zip(table, trees, model.treeWeights):
        row[: len(values)] = np.array(values) * weight
    return table


def _per_round(model, rows: DataFrame, label: str, schema: str, count: Callable) -> DataFrame:
    """``count(margins of one round, labels)`` gives columns for each Arrow batch and round; rounds count from 1."""
    table = leaf_values(model)
    scored = model.copy().setLeafCol("__leaf").transform(rows.select(FEATURES, q(label).cast("double").alias("__y")))
    leaves = scored.select(vector_to_array("__leaf").alias("leaf"), F.col("__y").alias("y")).filter("y is not null")

    def batches(parts):
        names = ["round", *[f.split()[0] for f in schema.split(", ")]]
        for part in parts:
            if not part.num_rows:
                continue
            leaf = part.column(0).flatten().to_numpy().reshape(part.num_rows, -1).astype(np.int64)
            margins = np.cumsum(table[np.arange(len(table)), leaf], 1)
            y = part.column(1).to_numpy()
            for r in range(len(table)):
                columns = [np.atleast_1d(c) for c in count(margins[:, r], y)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.full(len(columns[0]), r + 1, np.int32), *columns)], names=names)

    return leaves.mapInArrow(batches, f"round int, {schema}")


def staged_margins(model, rows: DataFrame, label: str) -> DataFrame:
    """(round, margin, pos, n): rows and positive rows per distinct margin after each round; rows without label are left out."""

    def count(margin, y):
        distinct, at = np.unique(margin, return_inverse=True)
        return distinct, np.bincount(at, y == 1, len(distinct)).astype(np.int64), np.bincount(at, minlength=len(distinct)).astype(np.int64)

    return _per_round(model, rows, label, "margin double, pos long, n long", count)


def staged_errors(model, rows: DataFrame, label: str) -> DataFrame:
    """(round, error, n): sums of squared errors after each round."""
    return _per_round(model, rows, label, "error double, n long", lambda margin, y: (((margin - y) ** 2).sum(), np.int64(len(y))))


def _scores(parts: DataFrame, classifier: bool) -> DataFrame:
    keys = ["fold", "part", "round"]
    if classifier:
        counted = parts.groupBy(*keys, "margin").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
        return me.roc_auc_by(counted, keys, "margin", "pos", "n").withColumnRenamed("auc", "score")
    return parts.groupBy(*keys).agg(F.sqrt(F.sum("error") / F.sum("n")).alias("score"))


def boosting_curve(train: DataFrame, label: str, estimator: Boosted, fits: Sequence[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(round, train_mean, train_std, test_mean, test_std) over the (rows to fit, rows held out) of each fold.

    The score is the area under the curve for classifiers and the root mean squared error for regressors; a part with
    a single class has no area and is left out of the means. Standard deviations are those of the folds themselves.
    """
    classifier = isinstance(estimator, GBTClassifier)
    stage = staged_margins if classifier else staged_errors
    parts = None
    for f, (rows, held) in enumerate(fits):
        model = estimator.fit(rows)
        for name, side in (("train", rows), ("test", held)):
            one = stage(model, side, label).select(F.lit(f).alias("fold"), F.lit(name).alias("part"), "*")
            parts = one if parts is None else parts.unionByName(one)
    side = lambda name: F.when(F.col("part") == name, F.col("score"))
    sums = [f(side(name)).alias(f"{name}_{suffix}") for name in ("train", "test") for suffix, f in (("mean", F.avg), ("std", F.stddev_pop))]
    return _scores(parts, classifier).groupBy("round").agg(*sums)


def chosen_round(scores: Sequence[float | None], larger_is_better: bool, patience: int | None) -> int:
    """The round (from 1) to stop at: the best one before ``patience`` rounds without a better; without patience the last."""
    if patience is None:
        return len(scores)
    sign, best, at = 1 if larger_is_better else -1, None, 1
    for r, s in enumerate(scores, 1):
        if s is not None and (best is None or sign * s > best):
            best, at = sign * s, r
        elif r - at >= patience:
            break
    return at


def boosted_fit_cv(
    df: DataFrame, columns: Sequence[str], label: str, estimator: Boosted, key: str, k: int = 5, patience: int | None = 50, order: Sequence[str] = ()
) -> tuple[DataFrame, list[tuple[str, float]]]:
    """Choose the number of boosting rounds by the mean held-out score per round, refit with it, report.

    One row: metric (auc or rmse), rounds, mean and std of the folds' train and test scores at that round, and the refit's
    scores on train and test rows. Folds come from the md5 of ``key``, or are growing blocks of time where ``order``
    is given. Without ``patience`` all rounds are used.
    """
    classifier = isinstance(estimator, GBTClassifier)
    own = for_label(estimator, label)
    ready = assemble(df, columns).withColumn(label, q(label).cast("double"))
    train, test = split(ready)
    train = train.filter(q(label).isNotNull())
    if order:
        train = materialize(time_series_split(train.select(FEATURES, label, *order), order, k, "__fold"))
        fits = [(train.filter(q("__fold") < f), train.filter(q("__fold") == f)) for f in range(1, k + 1)]
    else:
        train = materialize(train.select(FEATURES, label, hash_fold(q(key), k).alias("__fold")))
        fits = [(train.filter(q("__fold") != f), train.filter(q("__fold") == f)) for f in range(k)]
    curve = {r["round"]: r for r in boosting_curve(train, label, own, fits).collect()}
    rounds = chosen_round([curve[r]["test_mean"] for r in sorted(curve)], classifier, patience)
    model = own.copy({own.maxIter: rounds}).fit(train)

    def score(rows: DataFrame) -> float | None:
        if not classifier:
            return model.transform(rows).agg(me.rmse(label, "prediction")).first()[0]
        counted = staged_margins(model, rows, label).filter(F.col("round") == rounds)
        counted = counted.groupBy("round", "margin").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
        row = me.roc_auc_by(counted, ["round"], "margin", "pos", "n").first()
        return row["auc"] if row else None

    at = curve[rounds]
    row = ("auc" if classifier else "rmse", rounds, at["train_mean"], at["train_std"], at["test_mean"], at["test_std"], score(train), score(test))
    schema = "metric string, rounds int, train_mean double, train_std double, test_mean double, test_std double, train double, test double"
    return df.sparkSession.createDataFrame([row], schema), importances(model, columns, 100)
