"""Training, validation, stacking and search as Spark ML jobs.

Rows stay distributed: the driver holds models, metric values and parameter grids only. Folds are columns, so
every fold is a filter; test scores are added by chained ``transform`` calls, not by joins.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product

import numpy as np
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import (
    HashingTF, NGram, OneHotEncoder, RegexTokenizer, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feldspar.functions import text as tx
from feldspar.functions.numeric import hash_fold, keyed_poisson
from feldspar.operators import metrics as me
from feldspar.operators import textfeatures as tf
from feldspar.operators.profile import TRAIN, q
from feldspar.operators.splits import kfold_contiguous, time_series_split
from feldspar.plans.ordering import POSITION, with_position
from feldspar.plans.permute import dealt, in_blocks, permuted
from feldspar.plans.storage import materialize, stored

FEATURES = "features"


def assemble(df: DataFrame, columns: Sequence[str], name: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name).transform(df)


def probability_of_one(column: str = "probability") -> Column:
    return vector_to_array(column)[1]


def auc(scored: DataFrame, label: str) -> float:
    """Exact area under the ROC curve (numBins=0: no thinning of the curve)."""
    rows = scored.withColumn("__y", q(label).cast("double"))
    return BinaryClassificationEvaluator(labelCol="__y", rawPredictionCol="rawPrediction", numBins=0).evaluate(rows)


def for_label(estimator: Estimator, label: str) -> Estimator:
    """The estimator with its label column set (the last stage's, for a pipeline)."""
    if isinstance(estimator, Pipeline):
        stages = list(estimator.getStages())
        return Pipeline(stages=[*stages[:-1], for_label(stages[-1], label)])
    return estimator.copy({estimator.getParam("labelCol"): label})


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.filter(q(TRAIN) == 1), df.filter(q(TRAIN) == 0)


# ---- estimators with the toolkit's settings ----


def logistic(c: float | None = None, n_train: int | None = None, max_iter: int = 100) -> LogisticRegression:
    """Ridge-penalised logistic regression; ``c`` is the inverse penalty over the sum of losses."""
    reg = 1.0 / (c * n_train) if c and n_train else 0.0
    return LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=0.0, standardization=False)


def random_forest(trees: int = 200, depth: int = 6, weight: str | None = None, seed: int = 7) -> RandomForestClassifier:
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed)
    return model.setWeightCol(weight) if weight else model


def gradient_boosting(trees: int = 200, depth: int = 5, step: float = 0.1, seed: int = 10, **more) -> GBTClassifier:
    return GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=step, seed=seed, **more)


def balanced_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Weight n / (2 * rows of the class), from the labelled train rows."""
    row = df.filter((q(TRAIN) == 1) & q(label).isNotNull()).agg(F.count(F.lit(1)).alias("n"), F.count_if(q(label) == 1).alias("one")).first()
    n, one = row["n"], row["one"]
    weight = F.when(q(label) == 1, F.lit(n / (2.0 * max(one, 1)))).otherwise(F.lit(n / (2.0 * max(n - one, 1))))
    return df.withColumn(name, weight)


def scaler_pipeline(estimator: Estimator) -> Pipeline:
    """Standard scaling and a model as one estimator."""
    scaler = StandardScaler(inputCol=FEATURES, outputCol="scaled", withMean=True, withStd=True)
    return Pipeline(stages=[scaler, estimator.copy({estimator.getParam("featuresCol"): "scaled"})])


#: Rows times trees of a partition of a forest's input. The fit caches a count per row and tree.
FOREST_CELLS = 20_000_000


def in_parts(train: DataFrame, estimator: Estimator) -> DataFrame:
    """The rows dealt to as many partitions as a forest's counts need; other estimators cache the rows alone and take them as they lie."""
    if not estimator.hasParam("numTrees"):
        return train
    parts = -(-train.count() * estimator.getOrDefault("numTrees") // FOREST_CELLS)
    return train.repartition(parts) if parts > 1 else train


# ---- validation ----


def _report(scored: DataFrame, label: str, **tags) -> DataFrame:
    rows = scored.select(q(label).cast("int").alias("__y"), F.col("prediction").cast("int").alias("__p"))
    return me.classification_report(rows, "__y", "__p").select(*[F.lit(v).alias(k) for k, v in tags.items()], "*")


def validate_multilabel(
    df: DataFrame, features: Sequence[str], targets: Sequence[str], estimator: Estimator
) -> tuple[DataFrame, DataFrame]:
    """Per target: fit, score both splits. Returns (target, auc_trn, auc_tst) and the per-class reports."""
    train, test = split(assemble(df, features))
    rows, reports = [], None
    for t in targets:
        model = for_label(estimator, t).fit(in_parts(train.filter(q(t).isNotNull()), estimator))
        scored = {"train": model.transform(train), "test": model.transform(test)}
        rows.append((t, auc(scored["train"], t), auc(scored["test"], t)))
        for name, part in scored.items():
            one = _report(part, t, target=t, split=name)
            reports = one if reports is None else reports.unionByName(one)
    return df.sparkSession.createDataFrame(rows, "target string, auc_trn double, auc_tst double"), reports


def validate_models(
    df: DataFrame, features: Sequence[str], label: str, models: Mapping[str, Estimator]
) -> tuple[DataFrame, DataFrame]:
    """Per named model: gini on both splits, and the per-class reports."""
    train, test = split(assemble(df, features))
    rows, reports = [], None
    for name, estimator in models.items():
        model = for_label(estimator, label).fit(in_parts(train, estimator))
        for part_name, part in (("train", train), ("test", test)):
            scored = model.transform(part)
            rows.append((name, part_name, 2 * auc(scored, label) - 1))
            one = _report(scored, label, model=name, split=part_name)
            reports = one if reports is None else reports.unionByName(one)
    return df.sparkSession.createDataFrame(rows, "model string, split string, gini double"), reports


def category_stages(columns: Sequence[str]) -> list:
    """Index and one-hot encode string columns; unseen values get their own slot."""
    indexed = [f"{c}__i" for c in columns]
    encoded = [f"{c}__v" for c in columns]
    return [
        StringIndexer(inputCols=list(columns), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"),
        VectorAssembler(inputCols=encoded, outputCol=FEATURES),
    ]


def _prepared(df: DataFrame, columns: Sequence[str], data_type: str) -> DataFrame:
    if data_type == "nume":
        return assemble(df, columns)
    return Pipeline(stages=category_stages(columns)).fit(df.filter(q(TRAIN) == 1)).transform(df)


def validate_regression(
    df: DataFrame, columns: Sequence[str], label: str, estimator: Estimator, data_type: str = "nume"
) -> tuple[DataFrame, DataFrame]:
    """Fit on train, predict all rows: (scored rows, (split, mae))."""
    ready = _prepared(df, columns, data_type)
    scored = for_label(estimator, label).fit(ready.filter(q(TRAIN) == 1)).transform(ready)
    return scored, scored.groupBy(TRAIN).agg(me.mae(label, "prediction").alias("mae"))


def validate_classification(
    df: DataFrame, columns: Sequence[str], label: str, estimator: Estimator, data_type: str = "nume"
) -> tuple[DataFrame, DataFrame]:
    """Fit on train, predict all rows: (scored rows, (split, accuracy))."""
    ready = _prepared(df, columns, data_type)
    scored = for_label(estimator, label).fit(ready.filter(q(TRAIN) == 1)).transform(ready)
    return scored, scored.groupBy(TRAIN).agg(me.accuracy(label, "prediction").alias("accuracy"))


# ---- stacking ----


@dataclass
class Base:
    """One base model: its estimator, input columns, column kind and task."""

    estimator: Estimator
    columns: Sequence[str]
    data_type: str = "nume"
    task: str = "regression"
    fitted: Model | None = field(default=None, repr=False)

    def fit(self, df: DataFrame, label: str, name: str) -> Model:
        goal = (q(label) > 0).cast("double") if self.task == "classification" else q(label).cast("double")
        if self.data_type == "nume":
            stages = [VectorAssembler(inputCols=list(self.columns), outputCol=f"{name}_x")]
        else:
            *first, last = category_stages(self.columns)
            stages = [*first, last.copy({last.getParam("outputCol"): f"{name}_x"})]
        own = self.estimator.copy(
            {
                self.estimator.getParam("featuresCol"): f"{name}_x",
                self.estimator.getParam("labelCol"): "__goal",
                self.estimator.getParam("predictionCol"): name,
            }
        )
        self.fitted = Pipeline(stages=[*stages, own]).fit(df.withColumn("__goal", goal))
        return self.fitted


def _base_scores(df: DataFrame, bases: Sequence[Base]) -> DataFrame:
    kept = df.columns
    for i, b in enumerate(bases):
        scored = b.fitted.transform(df)
        df = scored.select(*[q(c) for c in kept], q(f"base{i}"))
        kept = [*kept, f"base{i}"]
    return VectorAssembler(inputCols=[f"base{i}" for i in range(len(bases))], outputCol="__stacked").transform(df)


def train_stacking(first: DataFrame, second: DataFrame, label: str, bases: Sequence[Base]) -> Model:
    """Fit the bases on the first part; a linear regression on their predictions of the second."""
    for i, b in enumerate(bases):
        b.fit(first, label, f"base{i}")
    top = LinearRegression(featuresCol="__stacked", labelCol="__goal", predictionCol="prediction")
    return top.fit(_base_scores(second, bases).withColumn("__goal", q(label).cast("double")))


def predict_stacking(df: DataFrame, bases: Sequence[Base], top: Model) -> DataFrame:
    return top.transform(_base_scores(df, bases)).drop("__stacked")


def validate_stacking(
    first: DataFrame, second: DataFrame, validation: DataFrame, label: str, bases: Sequence[Base]
) -> tuple[DataFrame, float]:
    """(validation rows with predictions, validation MAE)."""
    scored = predict_stacking(validation, bases, train_stacking(first, second, label, bases))
    return scored, scored.agg(me.mae(label, "prediction")).first()[0]


# ---- cross validation and search ----


def cross_val_scores(
    df: DataFrame, estimator: Estimator, fold: str, k: int, score: Callable[[DataFrame], float]
) -> list[float]:
    """One score per fold: fit on the other folds, score the held-out one."""
    out = []
    for f in range(k):
        model = estimator.fit(df.filter(q(fold) != f))
        out.append(score(model.transform(df.filter(q(fold) == f))))
    return out


def rmse_of(label: str) -> Callable[[DataFrame], float]:
    return lambda scored: scored.agg(me.rmse(label, "prediction")).first()[0]


def importances(model: Model, columns: Sequence[str], k: int = 50) -> list[tuple[str, float]]:
    """The k most important inputs: tree importances, or absolute coefficients."""
    values = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    pairs = [(c, abs(float(values[i]))) for i, c in enumerate(columns)]
    return sorted(pairs, key=lambda p: (-p[1], p[0]))[:k]


def gini_of(label: str) -> Callable[[DataFrame], float]:
    return lambda scored: 2 * auc(scored, label) - 1


def fit_report_cv(
    df: DataFrame, columns: Sequence[str], label: str, estimator: Estimator, key: str, k: int = 5
) -> tuple[DataFrame, list[tuple[str, float]]]:
    """One row: metric, its train/test value and the mean, std, min and max over k folds; plus the importances.

    The metric is the root mean squared error for regressors and the normalised gini, 2 AUC - 1, for classifiers.
    """
    classifier = estimator.hasParam("rawPredictionCol")
    ready = assemble(df, columns).withColumn("__fold", hash_fold(q(key), k))
    if classifier:
        ready = ready.withColumn(label, q(label).cast("double"))
    train, test = split(ready)
    own, score = for_label(estimator, label), (gini_of if classifier else rmse_of)(label)
    model = own.fit(train)
    scores = cross_val_scores(train, own, "__fold", k, score)
    mean = sum(scores) / k
    std = (sum((s - mean) ** 2 for s in scores) / k) ** 0.5
    row = ("gini" if classifier else "rmse", score(model.transform(train)), score(model.transform(test)), mean, std, min(scores), max(scores))
    schema = "metric string, train double, test double, cv_mean double, cv_std double, cv_min double, cv_max double"
    return df.sparkSession.createDataFrame([row], schema), importances(model, columns)


def cross_val_auc(
    df: DataFrame, features: Sequence[str] | None, targets: Sequence[str], key: str, k: int = 3, c: float = 0.1, max_iter: int = 100
) -> DataFrame:
    """(target, auc): k-fold mean AUC of a logistic regression per target, and the mean over targets (null target)."""
    ready = assemble(df, features) if features else df
    train = ready.filter(q(TRAIN) == 1).withColumn("__fold", hash_fold(q(key), k))
    n = train.count()
    rows = []
    for t in targets:
        judge = BinaryClassificationEvaluator(labelCol=t, numBins=0)
        own = for_label(logistic(c, n, max_iter), t)
        cv = CrossValidator(estimator=own, estimatorParamMaps=[{}], evaluator=judge, numFolds=k, foldCol="__fold", parallelism=1)
        rows.append((t, float(cv.fit(train.withColumn(t, q(t).cast("double"))).avgMetrics[0])))
    rows.append((None, sum(r[1] for r in rows) / len(rows)))
    return df.sparkSession.createDataFrame(rows, "target string, auc double")


def predict_multilabel(
    df: DataFrame, features: Sequence[str] | None, targets: Sequence[str], key: str, estimator: Estimator | None = None
) -> DataFrame:
    """Key and the class-1 probability per target, for the test rows."""
    ready = assemble(df, features) if features else df
    train, test = split(ready)
    n = train.count()
    out = test.select(key, FEATURES)
    for t in targets:
        model = for_label(estimator or logistic(0.1, n), t).fit(train.filter(q(t).isNotNull()))
        scored = model.transform(out)
        out = scored.withColumn(t, probability_of_one()).drop("rawPrediction", "probability", "prediction")
    return out.drop(FEATURES)


def grid_search(
    df: DataFrame, estimator: Estimator, grid: Mapping[str, Sequence], evaluator, key: str, k: int = 5, parallelism: int = 4
) -> tuple[DataFrame, Model]:
    """Cross-validated grid: (one row per parameter map with its mean score, best model)."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    maps = builder.build()
    folded = df.withColumn("__fold", hash_fold(q(key), k))
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator, numFolds=k, foldCol="__fold", parallelism=parallelism
    )
    fitted = cv.fit(folded)
    rows = [({p.name: str(v) for p, v in m.items()}, float(s)) for m, s in zip(maps, fitted.avgMetrics)]
    return df.sparkSession.createDataFrame(rows, "params map<string,string>, score double"), fitted.bestModel


# The staged grids of the boosting searches, in this engine's parameter names. Its trees have no least
# size of a node to split, so the grids of that setting are left out; the least size of a leaf is another setting.
GBM_STAGES = (
    {"maxIter": tuple(range(20, 81, 10))},
    {"maxDepth": tuple(range(5, 16, 2))},
    {"maxDepth": (3, 4, 5)},
    {"minInstancesPerNode": tuple(range(20, 41, 5))},
    {"subsamplingRate": (0.6, 0.7, 0.75, 0.8, 0.85, 0.9)},
    {"stepSize": (0.01, 0.05, 0.1), "maxIter": (40, 80, 100)},
)
BOOSTED_STAGES = (
    {"maxDepth": (3, 5, 7, 9), "minInstancesPerNode": (1, 3, 5)},
    {"maxDepth": (3, 4), "minInstancesPerNode": (1, 2, 3)},
    {"minInfoGain": (0.0, 0.1, 0.2, 0.3, 0.4)},
    {"subsamplingRate": (0.6, 0.7, 0.8, 0.9), "featureSubsetStrategy": ("0.6", "0.7", "0.8", "0.9")},
    {"subsamplingRate": (0.75, 0.8, 0.85), "featureSubsetStrategy": ("0.75", "0.8", "0.85")},
)


def staged_search(
    df: DataFrame, columns: Sequence[str], label: str, estimator: Estimator, key: str, stages: Sequence[Mapping[str, Sequence]] | None = None, k: int = 5
) -> tuple[DataFrame, Estimator]:
    """Search stage after stage (the grids of the toolkit unless others are given); the best values of one stage are fixed for the next. AUC decides."""
    stages = GBM_STAGES if stages is None else stages
    ready = assemble(df.filter(q(TRAIN) == 1), columns).withColumn(label, q(label).cast("double"))
    ready = materialize(ready.select(key, FEATURES, label))
    judge = BinaryClassificationEvaluator(labelCol=label, numBins=0)
    own = for_label(estimator, label)
    table = None
    for i, grid in enumerate(stages):
        scores, best = grid_search(ready, own, grid, judge, key, k)
        part = scores.select(F.lit(i).alias("stage"), "params", "score")
        table = part if table is None else table.unionByName(part)
        own = own.copy({own.getParam(name): best.getOrDefault(name) for name in grid})
    return table, own


def time_series_search(
    df: DataFrame, columns: Sequence[str], label: str, estimator: Estimator, grid: Mapping[str, Sequence], order: Sequence[str], n_splits: int = 5
) -> tuple[DataFrame, dict]:
    """Grid over expanding time windows: block i is predicted from all blocks before it. Lowest mean RMSE wins."""
    ready = materialize(assemble(time_series_split(df, order, n_splits, "__block"), columns).select(FEATURES, label, "__block"))
    own = for_label(estimator, label)
    rows = []
    for values in product(*grid.values()):
        params = dict(zip(grid, values))
        candidate = own.copy({own.getParam(n): v for n, v in params.items()})
        scores = []
        for b in range(1, n_splits + 1):
            model = candidate.fit(ready.filter(q("__block") < b))
            scores.append(rmse_of(label)(model.transform(ready.filter(q("__block") == b))))
        rows.append((params, sum(scores) / n_splits))
    best = min(rows, key=lambda r: r[1])[0]
    out = [({k: str(v) for k, v in p.items()}, s) for p, s in rows]
    return df.sparkSession.createDataFrame(out, "params map<string,string>, rmse double"), best


# ---- scores as features ----


def sign_probability(
    df: DataFrame, columns: Sequence[str], label: str, order: Sequence[str], estimator: Estimator, k: int = 5, name: str = "logerror_sign_prob"
) -> tuple[DataFrame, list[str]]:
    """2 * P(label = 1) - 1: out of fold over contiguous blocks for train rows, full fit for test rows."""
    train, test = split(assemble(df, columns))
    folded = kfold_contiguous(train, order, k, "__fold")
    own = for_label(estimator, label)
    parts = []
    for f in range(k):
        parts.append(own.fit(folded.filter(q("__fold") != f)).transform(folded.filter(q("__fold") == f)).drop("__fold"))
    parts.append(own.fit(train).transform(test))
    out = None
    for p in parts:
        scored = p.select(*[q(c) for c in df.columns], (probability_of_one() * 2 - 1).alias(name))
        out = scored if out is None else out.unionByName(scored)
    return out, [name]


def document_vectors(df: DataFrame, key: str, blocks: Sequence[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows with a sparse ``features`` vector of all stacked blocks (empty for documents without terms)."""
    stacked, catalog = tf.stack_features(blocks, key)
    size = catalog.count()
    cells = stacked.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("index", "weight"))).alias("__cells"))
    joined = df.join(cells, key, "left")
    indices = F.coalesce(F.col("__cells.index").cast("array<int>"), F.array().cast("array<int>"))
    values = F.coalesce(F.col("__cells.weight"), F.array().cast("array<double>"))
    return joined.withColumn(FEATURES, tf.sparse_vector(F.lit(size), indices, values)).drop("__cells")


def tfidf_lr_score(
    df: DataFrame, key: str, text: str, targets: Sequence[str], analyzers: Sequence[tf.Analyzer], c: float = 0.1, max_iter: int = 100, vocabularies: Sequence[DataFrame] | None = None
) -> tuple[DataFrame, list[str]]:
    """Per target: logistic regression on stacked TF-IDF blocks; train scores are in-sample. ``vocabularies`` are those that ``tf.tfidf`` gave, if it did."""
    new = [f"{t}_tfidf_lr" for t in targets]
    if any(a.max_features is None for a in analyzers):
        out = materialize(document_vectors(df.drop(text), key, [tf.tfidf(df, key, text, a) for a in analyzers]))
        train = out.filter(q(TRAIN) == 1)
        n = train.count()
        for t, name in zip(targets, new):
            model = for_label(logistic(c, n, max_iter), t).fit(train.filter(q(t).isNotNull()))
            out = model.transform(out).withColumn(name, probability_of_one()).drop("rawPrediction", "probability", "prediction")
        return out.drop(FEATURES), new
    vocabularies = vocabularies or [tf.fitted(df, key, text, a) for a in analyzers]
    known = [sorted((r["term"], r["idf"]) for r in v.select("term", "idf").collect()) for v in vocabularies]  # max_features rows each
    # Cells take several times the bytes of their text: those of the train rows are written once, those of all rows are scored where they are formed.
    train = _written_vectors(tf.stacked_cells(df.filter(q(TRAIN) == 1).select(q(text), *map(q, targets)), text, analyzers, known), sum(map(len, known)), targets)
    n = train.count()
    models = [for_label(logistic(c, n, max_iter), t).fit(train.filter(q(t).isNotNull())) for t in targets]
    scored = tf.stacked_margins(df, text, analyzers, known, np.array([m.coefficients.toArray() for m in models]))
    one = [1.0 / (1.0 + F.exp(-(F.col("__margin")[i] + F.lit(float(m.intercept))))) for i, m in enumerate(models)]
    return scored.select(*[q(c) for c in df.columns if c != text], *[p.alias(name) for p, name in zip(one, new)]), new


def _written_vectors(cells: DataFrame, size: int, targets: Sequence[str]) -> DataFrame:
    """The targets and a sparse ``features`` vector of the cells ``__at``, ``__w``."""
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), F.col("__at").alias("indices"), F.col("__w").alias("values"))
    schema = T.StructType([*(cells.schema[t] for t in targets), T.StructField(FEATURES, VectorUDT())])
    return stored(cells.select(*map(q, targets), vector.alias(FEATURES)), schema)


def ngram_vectors(df: DataFrame, text: str, word_ngrams: int, buckets: int) -> DataFrame:
    """Hashed counts of word n-grams 1..word_ngrams of the normalised text, in one vector."""
    ready = df.withColumn("__text", tx.normalize(q(text)))
    stages: list = [RegexTokenizer(inputCol="__text", outputCol="__w1", pattern=r"\s+")]
    stages += [NGram(n=i, inputCol="__w1", outputCol=f"__w{i}") for i in range(2, word_ngrams + 1)]
    joined = Pipeline(stages=stages).fit(ready).transform(ready)
    grams = [F.col(f"__w{i}") for i in range(1, word_ngrams + 1)]
    joined = joined.withColumn("__grams", F.concat(*grams) if len(grams) > 1 else grams[0])
    hashed = HashingTF(inputCol="__grams", outputCol=FEATURES, numFeatures=buckets).transform(joined)
    return hashed.drop("__text", "__grams", *[f"__w{i}" for i in range(1, word_ngrams + 1)])


def ngram_estimator(params: Mapping[str, float], n_train: int) -> LogisticRegression:
    """Linear classifier: epochs bound the iterations, the learning rate is the inverse penalty."""
    return logistic(float(params["lr"]), n_train, max_iter=int(params["epoch"]))


def ngram_classifier_score(
    df: DataFrame, text: str, params: Mapping[str, Mapping[str, float]], key: str, k: int = 5, buckets: int = 1 << 21
) -> tuple[DataFrame, list[str], list[str]]:
    """Per target: label ``<t>_ft`` and class-1 probability ``<t>_ft_prob``; out of fold for train, full fit for test."""
    kept = list(df.columns)
    out = df.withColumn("__fold", hash_fold(q(key), k))
    for size in sorted({int(p["word_ngrams"]) for p in params.values()}):
        # Vectors are built once per size; every row is scored by all models of a target in one chain of projections.
        out = materialize(ngram_vectors(out, text, size, buckets))
        train = out.filter(q(TRAIN) == 1)
        n_train = train.count()
        for t, p in params.items():
            if int(p["word_ngrams"]) != size:
                continue
            own = for_label(ngram_estimator(p, n_train), t)
            known = train.filter(q(t).isNotNull())
            models = [own.fit(known.filter(q("__fold") != f)) for f in range(k)] + [own.fit(known)]
            before = list(out.columns)
            for i, model in enumerate(models):
                model.setPredictionCol(f"__label{i}").setProbabilityCol(f"__prob{i}").setRawPredictionCol(f"__raw{i}")
                out = model.transform(out)
            model_of = F.when(q(TRAIN) == 1, q("__fold")).otherwise(F.lit(k))
            one = [probability_of_one(f"__prob{i}") for i in range(k + 1)]
            label = F.coalesce(*[F.when(model_of == i, F.col(f"__label{i}")) for i in range(k + 1)]).cast("int")
            prob = F.coalesce(*[F.when(model_of == i, F.greatest(x, 1 - x)) for i, x in enumerate(one)])
            out = out.select(*[q(c) for c in before], label.alias(f"{t}_ft"), prob.alias(f"{t}_ft_prob"))
            out = tf.normalize_label_prob(out, f"{t}_ft", f"{t}_ft_prob")
        out = out.drop(FEATURES)
    labels, probs = [f"{t}_ft" for t in params], [f"{t}_ft_prob" for t in params]
    return out.select(*[q(c) for c in kept + [c for t in params for c in (f"{t}_ft", f"{t}_ft_prob")]]), labels, probs


# The searched n-gram classifier settings.
NGRAM_GRID = {"word_ngrams": (1, 2, 3), "epoch": (1, 5, 15, 25), "lr": (0.1, 0.4, 0.7, 1.0)}


def ngram_classifier_grid(
    df: DataFrame, text: str, label: str, grid: Mapping[str, Sequence] = NGRAM_GRID, buckets: int = 200_000
) -> tuple[DataFrame, dict, dict]:
    """(one row per setting with test precision and recall, best by precision, best by recall)."""
    precision = MulticlassClassificationEvaluator(labelCol="__y", metricName="weightedPrecision")
    recall = MulticlassClassificationEvaluator(labelCol="__y", metricName="weightedRecall")
    rows = []
    for n in grid["word_ngrams"]:
        ready = ngram_vectors(df, text, n, buckets).withColumn("__y", q(label).cast("double")).filter(F.col("__y").isNotNull())
        train, test = split(ready)
        size = train.count()
        for epoch, lr in product(grid["epoch"], grid["lr"]):
            scored = for_label(ngram_estimator({"epoch": epoch, "lr": lr}, size), "__y").fit(train).transform(test)
            rows.append((n, epoch, float(lr), precision.evaluate(scored), recall.evaluate(scored)))
    names = ("word_ngrams", "epoch", "lr")
    best_p = dict(zip(names, max(rows, key=lambda r: r[3])))
    best_r = dict(zip(names, max(rows, key=lambda r: r[4])))
    schema = "word_ngrams int, epoch int, lr double, precision double, recall double"
    return df.sparkSession.createDataFrame(rows, schema), best_p, best_r


# The swept document-frequency shares.
MIN_DF_SWEEP = (0.5, 0.4, 0.3, 0.2, 0.1, 0.01, 0.001)


def min_df_sweep(df: DataFrame, key: str, text: str, label: str, limits: Sequence[float] = MIN_DF_SWEEP, max_features: int = 10_000) -> DataFrame:
    """(mdf, tpr, fpr): TF-IDF at each document-frequency limit, logistic regression, two rates on the test rows.

    The terms are counted once, and one pass over the documents forms the vectors of all limits.
    """
    widest = tf.word_analyzer(min_df=float(min(limits)), max_features=None)
    docs = tf.document_terms(df, key, text, widest, [label])
    fitted = docs.filter(q(TRAIN) == 1)
    counted = materialize(tf.vocabulary(df, tf.term_counts(fitted), widest))
    n = fitted.count()
    for i, limit in enumerate(limits):
        docs = tf.with_vectors(docs, tf.best_terms(counted.filter(F.col("df") >= F.lit(float(limit)) * n), max_features), f"__x{i}")
    docs = materialize(docs.drop("__terms"))
    rows = []
    for i, limit in enumerate(limits):
        train, test = split(docs.select(TRAIN, label, q(f"__x{i}").alias(FEATURES)))
        scored = for_label(logistic(1.0, n), label).fit(train).transform(test)
        rates = scored.agg(me.positive_hit_rate(label, "prediction"), me.false_discovery_rate(label, "prediction")).first()
        rows.append((limit, rates[0], rates[1]))
    return df.sparkSession.createDataFrame(rows, "mdf double, tpr double, fpr double")


# ---- feature selection ----


def shuffled_target(df: DataFrame, target: str, key: str, seed: int) -> DataFrame:
    """The rows in key order (``__pos``) with the target column permuted: the target of each row moves to another position."""
    placed = materialize(with_position(df, [q(key)]))
    return _with_moved_target(placed, target, placed.count(), seed)


def _with_moved_target(placed: DataFrame, target: str, n: int, seed: int) -> DataFrame:
    moved = placed.select(permuted(F.col(POSITION), n, F.lit(seed)).alias("__to"), q(target))
    return placed.drop(target).join(moved, F.col(POSITION) == F.col("__to")).drop("__to")


def _blocks(n: int, n_splits: int) -> Column:
    size = max(n // (n_splits + 1), 1)
    first = size + n % (n_splits + 1)
    return F.when(F.col(POSITION) < first, 0).otherwise(F.floor((F.col(POSITION) - first) / size) + 1)


def permutation_importance(
    df: DataFrame, columns: Sequence[str], target: str, key: str, estimator: Estimator, runs: int = 5, n_splits: int = 3, seed: int = 17
) -> DataFrame:
    """(feature, benchmark, permutation, ratio): importances on the real against shuffled targets, best first.

    The rows are numbered in key order once. Shuffled runs move every target to another row by a bijection of positions;
    benchmark runs draw 80 % with replacement as Poisson weights of the key, so no row is copied. Every run fits on growing
    blocks of time. A feature that a model does not use counts as 1. All draws come from keys and positions, so the result
    does not depend on partitions.
    """
    own = for_label(estimator, target)
    weighted = own.copy({own.getParam("weightCol"): "__weight"})
    sums = {"benchmark": [0.0] * len(columns), "permutation": [0.0] * len(columns)}
    placed = with_position(assemble(df, columns).select(FEATURES, target, key), [q(key)])
    n = df.count()
    placed = materialize(in_blocks(placed.withColumn("__block", _blocks(n, n_splits)), n))

    def add(kind: str, rows: DataFrame, learner: Estimator) -> None:
        ready = materialize(in_blocks(rows, n))
        for b in range(1, n_splits + 1):
            values = learner.fit(ready.filter(F.col("__block") < b)).featureImportances
            for i in range(len(columns)):
                sums[kind][i] += float(values[i]) or 1.0

    for run in range(runs):
        add("permutation", _with_moved_target(placed, target, n, seed + run), own)
        drawn = placed.withColumn("__weight", keyed_poisson(q(key), 0.8, seed + run).cast("double"))
        add("benchmark", drawn.filter("__weight > 0"), weighted)
    total = runs * n_splits
    rows = [(c, b / total, p / total, b / p) for c, b, p in zip(columns, sums["benchmark"], sums["permutation"])]
    rows.sort(key=lambda r: (-r[3], r[0]))
    return df.sparkSession.createDataFrame(rows, "feature string, benchmark double, permutation double, ratio double")


def _accuracy(label: str) -> Callable[[DataFrame], float]:
    return lambda scored: scored.agg(me.accuracy(label, "prediction")).first()[0]


def _eliminate(
    train: DataFrame, held: DataFrame | None, kept: list[int], label: str, estimator: Estimator, step: int, stop: int
) -> tuple[list[int], dict[int, float]]:
    """Drop the inputs with the smallest absolute coefficient until ``stop`` remain; held-out accuracy per size."""
    own = for_label(estimator, label)
    own = own.copy({own.getParam("featuresCol"): "__x"})
    scores: dict[int, float] = {}
    kept = list(kept)
    while True:
        slicer = VectorSlicer(inputCol=FEATURES, outputCol="__x", indices=kept)
        model = own.fit(slicer.transform(train))
        if held is not None:
            scores[len(kept)] = _accuracy(label)(model.transform(slicer.transform(held)))
        if len(kept) <= stop:
            return kept, scores
        weakest = sorted(range(len(kept)), key=lambda i: abs(model.coefficients[i]))[: min(step, len(kept) - stop)]
        kept = [c for i, c in enumerate(kept) if i not in weakest]


def recursive_elimination(
    df: DataFrame, columns: Sequence[str], label: str, key: str, estimator: Estimator, k: int = 3, step: int = 1
) -> list[str]:
    """Cross-validated recursive elimination: the size with the best mean accuracy, then the columns of that size."""
    ready = assemble(df, columns).withColumns({"__fold": hash_fold(q(key), k), label: q(label).cast("double")})
    ready = materialize(ready.select(FEATURES, label, "__fold"))
    everything = list(range(len(columns)))
    totals: dict[int, float] = {}
    for f in range(k):
        _kept, scores = _eliminate(ready.filter(q("__fold") != f), ready.filter(q("__fold") == f), everything, label, estimator, step, 1)
        for size, s in scores.items():
            totals[size] = totals.get(size, 0.0) + s
    best = min(totals, key=lambda size: (-totals[size], size))
    kept, _scores = _eliminate(ready, None, everything, label, estimator, step, best)
    return [columns[i] for i in kept]


def greedy_rfe(
    df: DataFrame, columns: Sequence[str], label: str, key: str, estimator: Estimator, block: int = 100, k: int = 3, step: int = 1
) -> list[str]:
    """Add the columns block by block to the kept set and eliminate after each block."""
    kept: list[str] = []
    for i in range(0, len(columns), block):
        kept = recursive_elimination(df, [*kept, *columns[i : i + block]], label, key, estimator, k, step)
    return kept


def _binomial_tail(hits: int, n: int) -> float:
    """P(X >= hits) for a fair coin."""
    from math import comb

    return sum(comb(n, i) for i in range(hits, n + 1)) / 2.0**n


def with_shadows(placed: DataFrame, values: str, n: int, seed: int, name: str = "__shadow", width: int | None = None) -> DataFrame:
    """Add an array like ``values`` in which every place (``width`` of them) is shuffled over the rows by a permutation of its own.

    ``placed`` has ``__pos`` 0..n-1. Each value is sent to its new position; one shuffle brings the values of a position together.
    """
    if width is None:
        width = placed.agg(F.max(F.size(values))).first()[0] or 0
    own = [
        F.struct(permuted(F.col(POSITION), n, F.lit(seed), F.lit(i)).alias("__to"), F.lit(i).alias("__place"), F.get(values, F.lit(i)).alias("__value"))
        for i in range(width)
    ]
    met = placed.select(F.inline(F.array(*own))).groupBy("__to").agg(F.sort_array(F.collect_list(F.struct("__place", "__value"))).alias("__met"))
    return placed.join(met, F.col(POSITION) == F.col("__to")).withColumn(name, F.col("__met.__value")).drop("__to", "__met")


def boruta_select(
    df: DataFrame, columns: Sequence[str], label: str, key: str, forest: RandomForestClassifier, rounds: int = 20, alpha: float = 0.05
) -> DataFrame:
    """(feature, hits, decision): all-relevant selection against shadow copies.

    In each round every column gets a shadow, shuffled by a permutation of its own, and a forest is fitted on both. A hit is
    an importance above the best shadow's; hits are tested against a fair coin, corrected for the column count. Rows are
    numbered in key order once; shuffles and layout follow from the numbers, so the result does not depend on partitions.
    """
    hits = [0] * len(columns)
    inputs = F.array(*[q(c).cast("double") for c in columns]).alias("__own")
    placed = materialize(with_position(df.select(q(key), q(label).cast("double").alias("__y"), inputs), [q(key)]).drop(key))
    n = placed.count()
    placed = materialize(dealt(placed, n * len(columns)))
    own = for_label(forest, "__y").copy({forest.getParam("featuresCol"): "__both"})
    for r in range(rounds):
        both = with_shadows(placed, "__own", n, r, width=len(columns)).withColumn("__both", array_to_vector(F.concat("__own", "__shadow")))
        ready = materialize(in_blocks(both.select("__both", "__y", POSITION), n))
        values = own.copy({own.seed: r}).fit(ready).featureImportances
        best_shadow = max(float(values[len(columns) + i]) for i in range(len(columns)))
        for i in range(len(columns)):
            hits[i] += float(values[i]) > best_shadow
    limit = alpha / max(len(columns), 1)
    rows = []
    for c, h in zip(columns, hits):
        up, down = _binomial_tail(h, rounds), _binomial_tail(rounds - h, rounds)
        rows.append((c, h, "confirmed" if up < limit else "rejected" if down < limit else "tentative"))
    return df.sparkSession.createDataFrame(rows, "feature string, hits int, decision string")


def select_from_model(df: DataFrame, columns: Sequence[str], label: str, threshold: float = 0.2, estimator: Estimator | None = None) -> list[str]:
    """Columns whose absolute coefficient reaches the threshold."""
    train = assemble(df.filter(q(TRAIN) == 1), columns)
    model = for_label(estimator or logistic(), label).fit(train)
    return [c for i, c in enumerate(columns) if abs(model.coefficients[i]) >= threshold]


def select_threshold_grid(
    df: DataFrame, columns: Sequence[str], label: str, key: str, thresholds: Sequence[float] = (0.2, 0.4, 0.6, 0.8, 1.0), k: int = 5
) -> DataFrame:
    """(threshold, n_columns, auc): per fold, select on the other folds, refit on the selection, score the fold."""
    ready = assemble(df.filter(q(TRAIN) == 1), columns).withColumns({"__fold": hash_fold(q(key), k), label: q(label).cast("double")})
    ready = materialize(ready.select(FEATURES, label, "__fold"))
    own = for_label(logistic(), label)
    sums = {t: [0.0, 0.0] for t in thresholds}
    for f in range(k):
        train, held = ready.filter(q("__fold") != f), ready.filter(q("__fold") == f)
        coefficients = own.fit(train).coefficients
        for t in thresholds:
            kept = [i for i in range(len(columns)) if abs(coefficients[i]) >= t]
            sums[t][0] += len(kept) / k
            if not kept:
                sums[t][1] += 0.5 / k  # no input left: every row scores the same
                continue
            slicer = VectorSlicer(inputCol=FEATURES, outputCol="__x", indices=kept)
            model = own.copy({own.featuresCol: "__x"}).fit(slicer.transform(train))
            sums[t][1] += auc(model.transform(slicer.transform(held)), label) / k
    rows = [(float(t), n, a) for t, (n, a) in sums.items()]
    return df.sparkSession.createDataFrame(rows, "threshold double, n_columns double, auc double")


