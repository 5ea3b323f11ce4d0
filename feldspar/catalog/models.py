"""Training, validation, search, selection and composite recipes."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from feldspar.catalog.base import CLAIMS, PARTS, claims, comments, md5_fold, orders_split, parts, query
from feldspar.functions import text as tx
from feldspar.functions.numeric import hash_fold
from feldspar.operators import boosting as bo
from feldspar.operators import learn as ln
from feldspar.operators import recipes as cp
from feldspar.operators import textfeatures as tf
from feldspar.plans.storage import materialize

NUMBERS = ["n_words", "n_chars", "n_upper", "n_digits", "n_marks"]


def _numbers(spark, d):
    """Labelled documents with text measures (log scale); a hash split marks the train rows.

    Written once, because every fit and score below reads it again.
    """
    df = comments(spark, d).filter("toxic is not null")
    text = F.col("comment_text")
    measures = {
        "n_words": tx.word_count(text),
        "n_chars": F.col("n_chars"),
        "n_upper": F.regexp_count(text, F.lit("[A-Z]")),
        "n_digits": F.regexp_count(text, F.lit("[0-9]")),
        "n_marks": F.regexp_count(text, F.lit("[.!?]")),
    }
    out = df.select(
        "doc_id",
        "toxic",
        "quality",
        "lang",
        "source",
        *[F.log1p(c.cast("double")).alias(n) for n, c in measures.items()],
        (hash_fold(F.col("doc_id"), 10) < 7).cast("int").alias("is_train"),
    )
    return materialize(out)


def _prices(spark, d):
    """Orders with numeric inputs and a signed target around the mean price."""
    df = orders_split(spark, d).withColumn("priority_cat", F.coalesce("priority_cat", F.lit("none")))
    return df.select(
        "o_orderkey",
        "day",
        "status_cat",
        "priority_cat",
        "is_train",
        (F.col("price") / 1000 - 250).alias("logerror"),
        (F.col("price") > 250000).cast("int").alias("logerror_sign"),
        F.year("day").cast("double").alias("year"),
        F.month("day").cast("double").alias("month"),
        F.dayofmonth("day").cast("double").alias("dom"),
        (F.col("o_custkey") % 100).cast("double").alias("cust"),
    )


INPUTS = ["year", "month", "dom", "cust"]


@query("validate_multilabel")
def _(spark, d):
    return ln.validate_multilabel(_numbers(spark, d), NUMBERS, ["toxic", "quality"], ln.logistic(max_iter=20))[0]


@query("logistic_classif")
def _(spark, d):
    return ln.validate_multilabel(_numbers(spark, d), NUMBERS, ["toxic"], ln.logistic(max_iter=20))[1]


@query("validate_models")
def _(spark, d):
    models = {"lr": ln.logistic(max_iter=20), "gbm": ln.gradient_boosting(trees=3, depth=3)}
    return ln.validate_models(_numbers(spark, d), NUMBERS, "quality", models)[0]


@query("validate_regression")
def _(spark, d):
    return ln.validate_regression(_prices(spark, d), INPUTS, "logerror", GBTRegressor(maxIter=3, maxDepth=3, seed=7))[1]


@query("validate_classification")
def _(spark, d):
    return ln.validate_classification(_prices(spark, d), ["status_cat", "priority_cat"], "logerror_sign", ln.logistic(max_iter=10), "cate")[1]


@query("stacking")
def _(spark, d):
    df = _prices(spark, d)
    part = hash_fold(F.col("o_orderkey"), 3)
    bases = [
        ln.Base(LinearRegression(), INPUTS),
        ln.Base(ln.logistic(max_iter=10), ["status_cat", "priority_cat"], "cate", "classification"),
    ]
    scored, _mae = ln.validate_stacking(df.filter(part == 0), df.filter(part == 1), df.filter(part == 2), "logerror", bases)
    return scored.select("o_orderkey", "logerror", "prediction")


@query("boosted_fit_cv")
def _(spark, d):
    model = GBTClassifier(maxIter=20, maxDepth=3, seed=27, subsamplingRate=0.8)
    return bo.boosted_fit_cv(_numbers(spark, d), NUMBERS, "toxic", model, "doc_id", patience=10)[0]


@query("boosted_fit_cv_regress")
def _(spark, d):
    model = GBTRegressor(maxIter=10, maxDepth=3, stepSize=0.3, seed=27)
    return bo.boosted_fit_cv(_prices(spark, d), INPUTS, "logerror", model, "o_orderkey", k=3, patience=10, order=["day", "o_orderkey"])[0]


def _binary_boost_sql(k: int) -> str:
    """With one 0/1 input every round ranks rows by that input, so that the first round is chosen."""
    area = """CASE WHEN {up} THEN 1 WHEN {down} THEN -1 ELSE 0 END
      * ((sum(y * x) * sum((1 - y) * (1 - x)) - sum(y * (1 - x)) * sum((1 - y) * x))::DOUBLE / nullif(sum(y) * sum(1 - y), 0)) / 2 + 0.5"""
    rate = "sum({w}y * x)::DOUBLE * nullif(sum({w}(1 - x)), 0) {sign} sum({w}y * (1 - x))::DOUBLE * nullif(sum({w}x), 0)"
    parts = " UNION ALL ".join(
        f"""SELECT {f} AS f, fold = {f} AS held, y, x FROM t""" for f in range(k)
    )
    return f"""WITH t AS (SELECT c_custkey, target AS y, CASE WHEN balance > 3000 THEN 1 ELSE 0 END AS x, is_train, {md5_fold('c_custkey', k)} AS fold FROM ({CLAIMS})),
r AS (SELECT y, x FROM t WHERE is_train = 1), p AS (SELECT * FROM ({parts.replace('FROM t', 'FROM t WHERE is_train = 1')})),
d AS (SELECT f, {rate.format(w='', sign='>')} AS up, {rate.format(w='', sign='<')} AS down FROM p WHERE NOT held GROUP BY f),
s AS (SELECT p.f, held, {area.format(up='any_value(up)', down='any_value(down)')} AS auc FROM p JOIN d ON d.f = p.f GROUP BY p.f, held),
w AS (SELECT {rate.format(w='', sign='>')} AS up, {rate.format(w='', sign='<')} AS down FROM r)
SELECT 'auc' AS metric, CAST(1 AS INT) AS rounds, avg(auc) FILTER (WHERE NOT held) AS train_mean, stddev_pop(auc) FILTER (WHERE NOT held) AS train_std,
  avg(auc) FILTER (WHERE held) AS test_mean, stddev_pop(auc) FILTER (WHERE held) AS test_std,
  (SELECT {area.format(up='any_value(up)', down='any_value(down)')} FROM r, w) AS train,
  (SELECT {area.format(up='any_value(up)', down='any_value(down)')} FROM t, w WHERE is_train = 0) AS test FROM s"""


@query("boosted_fit_cv_binary", _binary_boost_sql(5), rounds=["train_mean", "train_std", "test_mean", "test_std", "train", "test"])
def _(spark, d):
    df = claims(spark, d).withColumn("x", (F.col("balance") > 3000).cast("int"))
    return bo.boosted_fit_cv(df, ["x"], "target", GBTClassifier(maxIter=4, maxDepth=1, seed=27), "c_custkey", patience=2)[0]


@query("fit_report_cv")
def _(spark, d):
    return ln.fit_report_cv(_prices(spark, d), INPUTS, "logerror", LinearRegression(), "o_orderkey", k=3)[0]


REPORT = ["train", "test", "cv_mean", "cv_std", "cv_min", "cv_max"]


def _report_sql(metric: str, rows: str, fit: str, score: str, k: int) -> str:
    """Fit on the train rows and on those outside each fold; ``score`` is an aggregate over rows y, x and the fitted columns."""
    folds = " UNION ALL ".join(f"SELECT {f} AS f, t.* FROM t WHERE is_train = 1" for f in range(k))
    return f"""WITH t AS ({rows}), p AS ({folds}),
d AS (SELECT f, {fit} FROM p WHERE fold <> f GROUP BY f), w AS (SELECT {fit} FROM t WHERE is_train = 1),
s AS (SELECT p.f, {score} AS v FROM p JOIN d ON d.f = p.f WHERE fold = p.f GROUP BY p.f)
SELECT '{metric}' AS metric, (SELECT {score} FROM t, w WHERE is_train = 1) AS train, (SELECT {score} FROM t, w WHERE is_train = 0) AS test,
  avg(v) AS cv_mean, stddev_pop(v) AS cv_std, min(v) AS cv_min, max(v) AS cv_max FROM s"""


@query(
    "fit_report_cv_line",
    _report_sql(
        "rmse",
        f"SELECT c_custkey, balance AS y, region::DOUBLE AS x, is_train, {md5_fold('c_custkey', 3)} AS fold FROM ({CLAIMS})",
        "regr_slope(y, x) AS a, regr_intercept(y, x) AS b",
        "sqrt(avg((y - a * x - b) * (y - a * x - b)))",
        3,
    ),
    rounds=REPORT,
)
def _(spark, d):
    df = claims(spark, d).withColumn("x", F.col("region").cast("double"))
    return ln.fit_report_cv(df, ["x"], "balance", LinearRegression(solver="normal"), "c_custkey", k=3)[0]


@query(
    "fit_report_cv_gini",
    _report_sql(
        "gini",
        f"SELECT c_custkey, target AS y, CASE WHEN region < 2 THEN 1 ELSE 0 END AS x, is_train, {md5_fold('c_custkey', 3)} AS fold FROM ({CLAIMS})",
        "sign(avg(y) FILTER (WHERE x = 1) - avg(y) FILTER (WHERE x = 0)) AS up",
        "any_value(up) * (sum(y * x) * sum((1 - y) * (1 - x)) - sum(y * (1 - x)) * sum((1 - y) * x))::DOUBLE / nullif(sum(y) * sum(1 - y), 0)",
        3,
    ),
    rounds=REPORT,
)
def _(spark, d):
    df = claims(spark, d).withColumn("x", (F.col("region") < 2).cast("int"))
    return ln.fit_report_cv(df, ["x"], "target", ln.logistic(max_iter=50), "c_custkey", k=3)[0]


# One 0/1 input and two targets: a logistic regression ranks rows by the input, and unpenalised it gives each input's own rate.
TWO = f"""SELECT c_custkey, CASE WHEN region < 2 THEN 1 ELSE 0 END AS x, target, CASE WHEN seg_cat IN ('BUILDING', 'MACHINERY') THEN 1 ELSE 0 END AS other, is_train,
  {md5_fold('c_custkey', 3)} AS fold FROM ({CLAIMS})"""
_LONG = f"SELECT c_custkey, x, is_train, fold, unnest(['target', 'other']) AS target, unnest([target, other]) AS y FROM ({TWO})"
_UP = "sign(avg(y) FILTER (WHERE x = 1) - avg(y) FILTER (WHERE x = 0)) AS up"
_AREA = """any_value(up) * (sum(y * x) * sum((1 - y) * (1 - x)) - sum(y * (1 - x)) * sum((1 - y) * x))::DOUBLE / nullif(sum(y) * sum(1 - y), 0) / 2 + 0.5"""


def _two(spark, d):
    df = claims(spark, d).withColumn("x", (F.col("region") < 2).cast("int"))
    return df.withColumn("other", F.col("seg_cat").isin("BUILDING", "MACHINERY").cast("int"))


@query(
    "validate_multilabel_binary",
    f"""WITH t AS ({_LONG}), w AS (SELECT target, {_UP} FROM t WHERE is_train = 1 GROUP BY target),
a AS (SELECT t.target, is_train, {_AREA} AS auc FROM t JOIN w ON w.target = t.target GROUP BY t.target, is_train)
SELECT target, max(auc) FILTER (WHERE is_train = 1) AS auc_trn, max(auc) FILTER (WHERE is_train = 0) AS auc_tst FROM a GROUP BY target""",
    rounds=["auc_trn", "auc_tst"],
)
def _(spark, d):
    return ln.validate_multilabel(_two(spark, d), ["x"], ["target", "other"], ln.logistic(max_iter=50))[0]


@query(
    "cross_val_auc_binary",
    f"""WITH t AS ({_LONG}), f AS (SELECT unnest([0, 1, 2]) AS f),
w AS (SELECT target, f, {_UP} FROM t, f WHERE is_train = 1 AND fold <> f GROUP BY target, f),
a AS (SELECT t.target, fold, {_AREA} AS auc FROM t JOIN w ON w.target = t.target AND fold = f WHERE is_train = 1 GROUP BY t.target, fold),
m AS (SELECT target, avg(auc) AS auc FROM a GROUP BY target)
SELECT target, auc FROM m UNION ALL SELECT NULL, avg(auc) FROM m""",
    rounds=["auc"],
)
def _(spark, d):
    return ln.cross_val_auc(_two(spark, d), ["x"], ["target", "other"], "c_custkey", max_iter=50)


@query(
    "predict_multilabel_binary",
    f"""WITH t AS ({TWO}), r AS (SELECT x, avg(target) AS target, avg(other) AS other FROM t WHERE is_train = 1 GROUP BY x)
SELECT c_custkey, r.target, r.other FROM t JOIN r ON r.x = t.x WHERE is_train = 0""",
    rounds=["target", "other"],
    digits=3,
)
def _(spark, d):
    return ln.predict_multilabel(_two(spark, d), ["x"], ["target", "other"], "c_custkey", ln.logistic(max_iter=100))


@query(
    "sign_probability_binary",
    f"""WITH t AS (SELECT *, CASE WHEN is_train = 1 THEN ntile(3) OVER (PARTITION BY is_train ORDER BY c_custkey) END AS block FROM ({TWO})),
f AS (SELECT unnest([1, 2, 3]) AS f),
o AS (SELECT f, x, 2 * avg(target) - 1 AS p FROM t, f WHERE is_train = 1 AND block <> f GROUP BY f, x),
w AS (SELECT x, 2 * avg(target) - 1 AS p FROM t WHERE is_train = 1 GROUP BY x)
SELECT c_custkey, CASE WHEN is_train = 1 THEN o.p ELSE w.p END AS logerror_sign_prob
FROM t JOIN w ON w.x = t.x LEFT JOIN o ON o.x = t.x AND o.f = block""",
    rounds=["logerror_sign_prob"],
    digits=3,
)
def _(spark, d):
    out, new = ln.sign_probability(_two(spark, d), ["x"], "target", ["c_custkey"], ln.logistic(max_iter=100), k=3)
    return out.select("c_custkey", *new)


@query(
    "validate_models_binary",
    f"""WITH t AS (SELECT x, target AS y, is_train FROM ({TWO})), w AS (SELECT {_UP} FROM t WHERE is_train = 1)
SELECT 'lr' AS model, CASE is_train WHEN 1 THEN 'train' ELSE 'test' END AS split, 2 * ({_AREA}) - 1 AS gini FROM t, w GROUP BY is_train""",
    rounds=["gini"],
)
def _(spark, d):
    return ln.validate_models(_two(spark, d), ["x"], "target", {"lr": ln.logistic(max_iter=50)})[0]


@query(
    "validate_regression_line",
    f"""WITH t AS (SELECT balance AS y, region::DOUBLE AS x, is_train FROM ({CLAIMS})),
w AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM t WHERE is_train = 1)
SELECT is_train, avg(abs(y - a * x - b)) AS mae FROM t, w GROUP BY is_train""",
    rounds=["mae"],
)
def _(spark, d):
    df = claims(spark, d).withColumn("x", F.col("region").cast("double"))
    return ln.validate_regression(df, ["x"], "balance", LinearRegression(solver="normal"))[1]


def _tree_sql() -> str:
    """Trees over one 0/1 input rank rows by it: its higher rate of the target comes first."""
    rows = f"SELECT CASE WHEN balance > 3000 THEN 1 ELSE 0 END AS x, target AS y, is_train FROM ({CLAIMS})"
    return f"""WITH t AS ({rows}), w AS (SELECT {_UP} FROM t WHERE is_train = 1), a AS (SELECT is_train, {_AREA} AS auc FROM t, w GROUP BY is_train)
SELECT 'target' AS target, max(auc) FILTER (WHERE is_train = 1) AS auc_trn, max(auc) FILTER (WHERE is_train = 0) AS auc_tst FROM a"""


@query("random_forest_classif_binary", _tree_sql(), rounds=["auc_trn", "auc_tst"])
def _(spark, d):
    df = claims(spark, d).withColumn("x", (F.col("balance") > 3000).cast("int"))
    return ln.validate_multilabel(ln.balanced_weight(df, "target"), ["x"], ["target"], ln.random_forest(weight="weight"))[0]


@query("gbm_classif_binary", _tree_sql(), rounds=["auc_trn", "auc_tst"])
def _(spark, d):
    df = claims(spark, d).withColumn("x", (F.col("balance") > 3000).cast("int"))
    return ln.validate_multilabel(df, ["x"], ["target"], ln.gradient_boosting(trees=10, depth=1))[0]


@query("cross_val_auc")
def _(spark, d):
    return ln.cross_val_auc(_numbers(spark, d), NUMBERS, ["toxic", "quality"], "doc_id", max_iter=10)


@query("predict_multilabel")
def _(spark, d):
    return ln.predict_multilabel(_numbers(spark, d), NUMBERS, ["toxic", "quality"], "doc_id", ln.logistic(max_iter=10))


@query("grid_search_gbm")
def _(spark, d):
    stages = [{"maxIter": (2, 4)}, {"maxDepth": (2, 3)}]
    return ln.staged_search(_numbers(spark, d), NUMBERS, "toxic", ln.gradient_boosting(trees=3, depth=2), "doc_id", stages, k=2)[0]


@query("grid_search_boosted_classif")
def _(spark, d):
    stages = [{"minInfoGain": (0.0, 0.2)}, {"subsamplingRate": (0.8, 0.9)}]
    model = GBTClassifier(maxIter=2, maxDepth=3, seed=27)
    return ln.staged_search(_numbers(spark, d), NUMBERS, "quality", model, "doc_id", stages, k=2)[0]


@query("grid_search_boosted_regress")
def _(spark, d):
    df = _prices(spark, d)
    model = GBTRegressor(maxIter=2, maxDepth=3, seed=27)
    return ln.time_series_search(df, INPUTS, "logerror", model, {"minInstancesPerNode": (7, 9)}, ["day", "o_orderkey"], n_splits=3)[0]


@query("random_forest_classif")
def _(spark, d):
    df = ln.balanced_weight(_numbers(spark, d), "toxic")
    return ln.validate_multilabel(df, NUMBERS, ["toxic"], ln.random_forest(20, 5, "weight"))[0]


@query("gbm_classif")
def _(spark, d):
    return ln.validate_multilabel(_numbers(spark, d), NUMBERS, ["quality"], ln.gradient_boosting(5, 4))[0]


@query("scaler_model_chain")
def _(spark, d):
    return ln.predict_multilabel(_numbers(spark, d), NUMBERS, ["toxic"], "doc_id", ln.scaler_pipeline(ln.logistic(max_iter=20)))


@query("sign_probability")
def _(spark, d):
    df = _prices(spark, d)
    out, new = ln.sign_probability(df, INPUTS, "logerror_sign", ["day", "o_orderkey"], ln.logistic(max_iter=10), k=3)
    return out.select("o_orderkey", *new)


@query("tfidf_lr_score")
def _(spark, d):
    analyzers = [tf.char_analyzer(), tf.sublinear_word_analyzer()]
    out, new = ln.tfidf_lr_score(comments(spark, d), "doc_id", "comment_text", ["toxic", "quality"], analyzers)
    return out.select("doc_id", *new)


@query("ngram_classifier_score")
def _(spark, d):
    params = {"toxic": {"epoch": 5, "lr": 1.0, "word_ngrams": 1}, "quality": {"epoch": 5, "lr": 0.4, "word_ngrams": 2}}
    df = comments(spark, d).select("doc_id", "comment_text", "toxic", "quality", "is_train")
    out, labels, probs = ln.ngram_classifier_score(df, "comment_text", params, "doc_id", k=3, buckets=1 << 14)
    return out.select("doc_id", *labels, *probs)


@query("ngram_classifier_grid")
def _(spark, d):
    df = comments(spark, d).filter("toxic is not null").withColumn("is_train", (hash_fold(F.col("doc_id"), 10) < 7).cast("int"))
    grid = {"word_ngrams": (1, 2), "epoch": (5,), "lr": (0.1, 1.0)}
    return ln.ngram_classifier_grid(df, "comment_text", "toxic", grid, buckets=1 << 14)[0]


@query("min_df_sweep")
def _(spark, d):
    df = comments(spark, d).filter("toxic is not null").withColumn("is_train", (hash_fold(F.col("doc_id"), 10) < 7).cast("int"))
    return ln.min_df_sweep(df, "doc_id", "comment_text", "toxic")


@query("permutation_importance")
def _(spark, d):
    model = GBTClassifier(maxIter=2, maxDepth=3, seed=7)
    return ln.permutation_importance(_numbers(spark, d), NUMBERS, "quality", "doc_id", model)


@query("greedy_rfe")
def _(spark, d):
    df = _numbers(spark, d)
    kept = ln.greedy_rfe(df, NUMBERS, "quality", "doc_id", ln.logistic(max_iter=5), block=3, k=2)
    return df.select("doc_id", *kept)


@query("boruta_select")
def _(spark, d):
    return ln.boruta_select(_numbers(spark, d), NUMBERS, "quality", "doc_id", RandomForestClassifier(numTrees=10, maxDepth=4))


@query("select_from_model")
def _(spark, d):
    return ln.select_threshold_grid(_numbers(spark, d), NUMBERS, "quality", "doc_id", thresholds=(0.0001, 0.001, 0.2), k=2)


# ---- composite recipes ----


_MEAN = f"(SELECT avg(ps_car_13) FROM ({PARTS}))"
_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query(
    "feature_generate",
    "SELECT p_partkey, "
    + ", ".join(f"CAST(CASE WHEN ps_car_02_cat = '{t}' THEN 1 ELSE 0 END AS INT) AS \"ps_car_02_cat_{t}\"" for t in _TYPES)
    + f""", CAST(CASE WHEN ps_car_02_cat IS NULL THEN 1 ELSE 0 END AS INT) AS ps_car_02_cat_nan, ps_car_12, coalesce(ps_car_13, {_MEAN}) AS ps_car_13,
  1 / ps_car_12 AS ps_car_12_inv, 1 / coalesce(ps_car_13, {_MEAN}) AS ps_car_13_inv, ps_car_12 * coalesce(ps_car_13, {_MEAN}) AS "ps_car_12 ps_car_13"
FROM ({PARTS})""",
    rounds=["ps_car_12", "ps_car_13", "ps_car_12_inv", "ps_car_13_inv", "ps_car_12 ps_car_13"],
)
def _(spark, d):
    out, new = cp.feature_generate(parts(spark, d), ["ps_car_02_cat"], ["ps_car_12", "ps_car_13"])
    return out.select("p_partkey", "ps_car_12", "ps_car_13", *new)


@query("feature_generate2")
def _(spark, d):
    df = parts(spark, d)
    out, new = cp.feature_generate2(df, df.columns, "target", squared="ps_car_15", scaled="ps_car_13", rounded="ps_car_12")
    clean = {c: c.replace("-", "_x_") for c in new}
    return out.select("p_partkey", *[F.col(f"`{c}`").alias(n) for c, n in clean.items()])


@query("text_feature_recipe")
def _(spark, d):
    df = comments(spark, d).select("doc_id", "comment_text", "toxic", "quality", "is_train")
    return cp.text_features_to_predictions(df, "doc_id", "comment_text", ["toxic", "quality"], min_df=0.02, n_words=50, max_features=2000, score_iterations=20)
