"""Composite feature recipes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspar.functions import text as tx
from feldspar.operators import encode as en
from feldspar.operators import learn as ln
from feldspar.operators import missing as mv
from feldspar.operators import numeric as nm
from feldspar.operators import quality as fq
from feldspar.operators import textfeatures as tf
from feldspar.operators.profile import TRAIN, columns_with_suffix, q
from feldspar.plans.storage import materialize


def feature_generate(df: DataFrame, categories: Sequence[str], numbers: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Indicators, mean imputation, inverses, pair products."""
    df, dummies = en.one_hot(df, categories)
    df = mv.mean_impute(df, numbers)
    df, inverses = nm.inverse_features(df, numbers)
    df, products = nm.polynomial_features(df, numbers)
    return df, dummies + inverses + products


def feature_generate2(
    df: DataFrame, columns: Sequence[str], target: str, squared: str, scaled: str, rounded: str, k: int = 20
) -> tuple[DataFrame, list[str]]:
    """Magic numbers, pair codes of the ``_cat`` columns, the k most informative pairs as indicators."""
    df, magic = nm.magic_features(df, squared, scaled, rounded)
    df, pairs = en.interaction_codes(df, columns_with_suffix(columns, "_cat"))
    best = fq.top_mutual_info(df.filter(q(TRAIN) == 1), pairs, target, k).select("column").collect()  # k rows
    df, dummies = en.one_hot(df, [r["column"] for r in best])
    return df, magic + dummies


def text_features_to_predictions(
    df: DataFrame, key: str, text: str, targets: Sequence[str], min_df: float = 0.001, n_words: int = 150, max_features: int = 10_000, score_iterations: int = 100
) -> DataFrame:
    """From documents to test predictions: key and one probability per target.

    TF-IDF words, scaled word count, informative-word flags with out-of-fold and smoothed target means per
    target, and TF-IDF regression scores are assembled into one vector; a logistic regression per target
    predicts the test rows. Word flags stay one array, so the plan does not grow with the vocabulary.
    """
    analyzer = tf.word_analyzer(min_df=min_df, max_features=max_features)
    words = tf.tfidf(df, key, text, analyzer)
    chi2 = tf.term_chi2(words[0], df, key, targets)
    bag = sorted(r["word"] for r in tf.bag_of_words(chi2, n_words).collect() if r["word"])  # n_words per target at most
    scored, score_columns = ln.tfidf_lr_score(df, key, text, targets, [analyzer], max_iter=score_iterations, vocabularies=[words[1]])
    flagged = tf.word_exist_array(df.select(key, TRAIN, text, *targets), text, bag)
    flagged = flagged.withColumn("word_count", tx.word_count(q(text))).drop(text)
    flagged = nm.standard_scale(flagged, ["word_count"])
    arrays: list[str] = []
    for t in targets:
        flagged, new = en.encode_flags(flagged, "word_exist", len(bag), t, key)
        arrays += new
    dense = flagged.join(scored.select(key, *score_columns), key)
    numbers = [q("word_count"), *[q(c) for c in score_columns]]
    dense = dense.withColumn("__dense", array_to_vector(F.concat(F.array(*numbers), *[q(a) for a in arrays])))
    vectors = ln.document_vectors(dense.select(key, TRAIN, *targets, "__dense"), key, [words])
    ready = ln.assemble(vectors.withColumnRenamed(ln.FEATURES, "__sparse"), ["__dense", "__sparse"])
    ready = materialize(ready.select(key, TRAIN, *targets, ln.FEATURES))  # read again by every fit and score
    n = ready.filter(q(TRAIN) == 1).count()
    return ln.predict_multilabel(ready, None, targets, key, ln.logistic(0.1, n, score_iterations))
