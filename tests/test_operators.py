"""Operators against direct re-computation on small tables."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from feldspar.functions import calendar as cal
from feldspar.functions import numeric as fn
from feldspar.functions import text as tx
from feldspar.operators import encode, history, learn, metrics, missing, numeric, profile, quality, sets, splits
from feldspar.operators import textfeatures as tf
from feldspar.sources import tables as io

INF = float("inf")


def test_divide_follows_float_rules(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (6.0, 3.0), (None, 0.0), (1.0, None)], "a double, b double")
    got = [r[0] for r in df.select(fn.divide(F.col("a"), F.col("b"))).collect()]
    assert got == [INF, -INF, None, 2.0, None, None]


def test_log1p_and_rounding(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (-2.0,)], "x double")
    assert [r[0] for r in df.select(fn.log1p(F.col("x"))).collect()] == [-INF, 0.0, None]
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,)], "x double")
    assert [r[0] for r in df.select(fn.round_even(F.col("x"), 2)).collect()] == [0.12, 0.38, 2.5]


def test_noise_is_centred_and_level_zero_is_identity(spark):
    df = spark.range(20000).select("id", F.lit(100.0).alias("x"))
    key = F.col("id")
    noisy = df.select("id", fn.laplace_noise(F.col("x"), 2.0, key).alias("l"), fn.multiplicative_noise(F.col("x"), 0.1, key).alias("m"))
    row = noisy.agg(F.avg("l"), F.avg(F.abs(F.col("l") - 100)), F.avg("m"), F.stddev("m"), F.kurtosis("m"), F.corr("l", "m")).first()
    assert abs(row[0] - 100) < 0.1 and abs(row[1] - 2.0) < 0.1 and abs(row[2] - 100) < 0.5 and abs(row[3] - 10) < 0.5
    assert abs(row[4]) < 0.15
    assert df.select(fn.multiplicative_noise(F.col("x"), 0).alias("m")).distinct().collect() == [(100.0,)]
    with pytest.raises(ValueError):
        fn.multiplicative_noise(F.col("x"), 0.1)


def test_noise_does_not_depend_on_partitions(spark):
    df = spark.range(500).select("id", F.lit(100.0).alias("x"))
    draw = lambda d: sorted(map(tuple, d.select("id", fn.laplace_noise(F.col("x"), 2.0, F.col("id")), fn.keyed_normal(F.col("id"), 3)).collect()))
    assert draw(df.repartition(3)) == draw(df.repartition(30))
    other = df.select(fn.keyed_normal(F.col("id"), 3).alias("a"), fn.keyed_normal(F.col("id"), 4).alias("b"))
    assert abs(other.agg(F.corr("a", "b")).first()[0]) < 0.15


def test_inf_and_nan_impute_combined_equals_sequence(spark):
    data = [(1, 1.0, None, 5.0, INF), (1, INF, 2.0, 5.0, 1.0), (1, None, 4.0, 7.0, 3.0), (0, -INF, None, None, 1.0), (0, 2.0, 1.0, INF, None)]
    df = spark.createDataFrame(data, "is_train int, a double, b double, c double, d double")
    cols = ["a", "b", "c", "d"]
    one, f1 = missing.nan_inf_impute(df, cols)
    two, f2 = missing.nan_impute(df, cols)
    two, f3 = missing.inf_impute(two, cols)
    assert f1 == f2 + f3
    names = ["is_train", *cols, *f1]
    assert sorted(map(tuple, one.select(names).collect())) == sorted(map(tuple, two.select(names).collect()))


def test_impute_test_only_takes_train_mean(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (1, 4.0, 5.0), (0, None, INF)], "is_train int, a double, b double")
    out, flags = missing.nan_impute(df, ["a"])
    out, more = missing.inf_impute(out, ["b"])
    assert flags == [] and more == []
    assert tuple(out.filter("is_train = 0").select("a", "b").first()) == (3.0, 4.0)


def test_assert_no_nulls_names_the_columns(spark):
    df = spark.createDataFrame([(1, 1.0), (0, None)], "is_train int, a double")
    with pytest.raises(ValueError, match="a \\(test: 1\\)"):
        profile.assert_no_nulls(df, ["a"])


def test_null_pattern_beyond_62_columns(spark):
    df = spark.range(3).select(*[F.when(F.col("id") > i % 3, F.lit(1)).alias(f"c{i}") for i in range(70)])
    got = profile.null_pattern_count(df, df.columns).collect()
    assert sum(r["n_rows"] for r in got) == 3 and all(len(r["pattern"]) == 70 for r in got)


@pytest.fixture()
def labelled(spark):
    rng = np.random.default_rng(11)
    n = 400
    pdf = pd.DataFrame({"id": np.arange(n), "c": rng.choice(["a", "b", "c", None], n, p=[0.6, 0.2, 0.1, 0.1]), "y": rng.integers(0, 2, n), "is_train": (np.arange(n) % 5 > 0).astype(int)})
    pdf.loc[3, "c"] = "only-once"
    pdf.loc[5, "c"] = "unseen"
    return spark.createDataFrame(pdf).withColumn("c", F.when(F.col("c").isNotNull(), F.col("c")))


def test_oof_equals_the_fold_loop(spark, labelled):
    out, (name,) = encode.oof_target_mean(labelled.withColumn("fold", fn.hash_fold(F.col("id"), 5)), ["c"], "y", "id", fold="fold")
    got = out.toPandas().set_index("id")
    train = got[got.is_train == 1]
    for f in range(5):
        rest = train[train.fold != f]
        want = train[train.fold == f]["c"].map(rest.groupby("c")["y"].mean()).fillna(rest["y"].mean())
        assert np.allclose(got.loc[want.index, name], want)
    test = got[got.is_train == 0]
    assert np.allclose(test[name], test["c"].map(train.groupby("c")["y"].mean()).fillna(train["y"].mean()))


def test_smoothing(spark, labelled):
    out, (name,) = encode.smoothed_target_mean(labelled, ["c"], "y", 20, 5)
    got = out.toPandas()
    train = got[got.is_train == 1]
    stats = train.groupby("c")["y"].agg(["mean", "count"])
    lam = 1 / (1 + np.exp(-(stats["count"] - 20) / 5))
    prior = train["y"].mean()
    want = got["c"].map(prior * (1 - lam) + stats["mean"] * lam).fillna(prior)
    assert np.allclose(got[name], want)


def test_flag_arrays_equal_single_columns(spark, labelled):
    flags = labelled.withColumn("f", F.array((F.col("id") % 3 == 0).cast("int"), (F.col("id") % 7 == 0).cast("int"), F.lit(0)))
    out, (oof, smooth) = encode.encode_flags(flags, "f", 3, "y", "id", min_samples_leaf=20, smoothing=5)
    wide = flags.select("*", *[F.col("f")[i].alias(f"f{i}") for i in range(3)])
    wide, names = encode.oof_target_mean(wide, ["f0", "f1", "f2"], "y", "id")
    wide, smooth_names = encode.smoothed_target_mean(wide, ["f0", "f1", "f2"], "y", 20, 5)
    a = out.toPandas().set_index("id")
    b = wide.toPandas().set_index("id").loc[a.index]
    assert np.allclose(np.stack(a[oof]), b[names])
    assert np.allclose(np.stack(a[smooth]), b[smooth_names])


def test_one_hot_of_many_values(spark):
    df, new = encode.one_hot(spark.range(1001), ["id"])
    assert len(new) == 1002
    assert df.select(*new).toPandas().to_numpy().sum() == 1001
    long = encode.one_hot_long(spark.range(1001).withColumn("k", F.col("id")), "k", ["id"]).collect()
    assert sorted(r["feature"] for r in long) == sorted(f"id_{i}" for i in range(1001))


def test_adjusted_mutual_info_of_many_classes(spark):
    df = spark.range(2002).select((F.col("id") % 1001).alias("t"), (F.col("id") % 1001).alias("same"), F.lit(1).alias("one"))
    got = {r["column"]: r["ami"] for r in quality.adjusted_mutual_info(df, ["same", "one"], "t").collect()}
    assert abs(got["same"] - 1) < 1e-9 and abs(got["one"]) < 1e-9


def test_binary_encode_first_appearance(spark):
    df = spark.createDataFrame([(1, 1, "b"), (2, 1, "a"), (3, 1, "b"), (4, 0, "c"), (5, 0, None)], "k int, is_train int, v string")
    out, new = encode.binary_encode(df, ["v"], ["k"])
    assert new == ["v_b0", "v_b1"]
    assert [tuple(r) for r in out.orderBy("k").select(new).collect()] == [(0, 0), (0, 1), (0, 0), (1, 0), (1, 1)]


@pytest.mark.parametrize("n,k", [(10, 3), (11, 5), (7, 7)])
def test_contiguous_folds(spark, n, k):
    got = [r["fold"] for r in splits.kfold_contiguous(spark.range(n), ["id"], k).orderBy("id").collect()]
    assert got == [f for f, part in enumerate(np.array_split(np.arange(n), k)) for _ in part]


def test_contiguous_blocks_with_fewer_rows_than_folds(spark):
    got = [r["fold"] for r in splits.contiguous_blocks(spark.range(3), ["id"], 5).orderBy("id").collect()]
    assert got == [0, 1, 2]


def test_exact_stratified_folds_are_even(spark, labelled):
    got = splits.stratified_kfold(labelled, "id", 5, target="y").groupBy("y", "fold").count().toPandas()
    assert (got.groupby("y")["count"].agg(lambda s: s.max() - s.min()) <= 1).all()


def test_union_fills_absent_columns(spark):
    out = sets.union_train_test(spark.range(2).withColumn("a", F.lit(1)), spark.range(1))
    assert sorted((r["is_train"], r["a"]) for r in out.collect()) == [(0, None), (1, 1), (1, 1)]


def test_calendar_edge_days(spark):
    df = spark.sql("SELECT explode(array(date'2016-01-01', date'2016-02-01', date'2018-12-31')) AS d")
    got = [tuple(r) for r in df.select(cal.week(F.col("d")), cal.week_of_quarter(F.col("d")), cal.week_of_month(F.col("d"))).collect()]
    assert got == [(1, 1, 1), (5, -47, 1), (1, -38, -46)]  # ISO weeks 1, 40 and 48


def _visits(spark, seed=2, n=120):
    rng = np.random.default_rng(seed)
    days = pd.date_range("2021-01-01", periods=n)
    parts = []
    for e in ("x", "y"):
        keep = np.sort(rng.choice(n, int(n * 0.7), replace=False))
        parts.append(pd.DataFrame({"e": e, "d": days[keep].date, "v": rng.integers(1, 20, len(keep)).astype(float)}))
    pdf = pd.concat(parts, ignore_index=True)
    pdf["is_train"] = (pd.to_datetime(pdf["d"]) < days[-20]).astype(int)
    return pdf, spark.createDataFrame(pdf)


def test_history_equals_rolling_and_shift(spark):
    pdf, df = _visits(spark)
    out, new = history.history_mean_count_std(df, "e", "d", "v", [])
    got = out.toPandas()
    test_days = pd.to_datetime(pdf.loc[pdf.is_train == 0, "d"])
    offset = (test_days.max() - test_days.min()).days
    for e, part in pdf.groupby("e"):
        part = part.assign(d=pd.to_datetime(part["d"]))
        series = part.assign(v=part["v"].where(part.is_train == 1)).set_index("d")["v"].asfreq("D")
        mine = got[got.e == e].assign(d=lambda x: pd.to_datetime(x["d"])).set_index("d").sort_index()
        for length, tp in ((7, offset + 1), (30, offset + 1), (60, offset + 61)):
            roll = series.rolling(length, min_periods=1)
            for stat in ("mean", "count", "std"):
                want = getattr(roll, stat)().shift(tp).loc[mine.index]
                name = f"store_visitors_{stat}_over_day_{tp}-{tp + length - 1}_in_past"
                assert np.allclose(mine[name].astype(float), want, equal_nan=True), name
    assert len(new) == 32


def _slow_decay(series, length, tp):
    """Step-by-step reference on a pandas series, with plain loops."""
    roll = series.rolling(length, min_periods=1)
    mean, weight = roll.mean(), roll.count().where(roll.count() > 0) / length
    first = weight.reset_index(drop=True).first_valid_index()
    reach, rest, steps = len(series) - first - 2, tp, []
    while rest > reach:
        steps.append(reach)
        rest -= reach
    for s in [*steps, rest]:
        mean = mean.shift(s).interpolate(limit_direction="both")
        w = weight.shift(s).tolist()
        known = [i for i, x in enumerate(w) if not math.isnan(x)]
        for i in range(len(w)):
            if i < known[0]:
                w[i] = w[known[0]] * 0.95 ** (known[0] - i)
            elif i > known[-1]:
                w[i] = w[known[-1]] * 0.95 ** (i - known[-1])
        gaps = [i for i, x in enumerate(w) if math.isnan(x)]
        weight = pd.Series(w, index=series.index).interpolate()
        weight.iloc[gaps] *= 0.95
    return mean, mean * weight


def test_decayed_history(spark):
    rng = np.random.default_rng(8)
    values = rng.integers(1, 9, 80).astype(float)
    values[rng.choice(80, 40, replace=False)] = np.nan
    values[:5] = np.nan
    got = pd.DataFrame(history.decayed_features(values), columns=history.decay_columns())
    assert got.shape[1] == 74
    for length, tp in ((1, 7), (1, 49), (7, 1), (7, 50), (30, 91), (90, 1)):
        mean, weighted = _slow_decay(pd.Series(values), length, tp)
        span = f"{tp}-{tp + length - 1}_in_past"
        assert np.allclose(got[f"store_visitors_mean_{span}"], mean, equal_nan=True), span
        assert np.allclose(got[f"store_visitors_weighted_mean_{span}"], weighted, equal_nan=True), span
    short = history.decayed_features(np.array([np.nan, 1.0, 2.0]))
    assert np.isnan(short).all()


def test_ridge_trend_equals_direct_fit(spark):
    rng = np.random.default_rng(4)
    n = 260
    pdf = pd.DataFrame({"e": np.where(np.arange(n) % 13 == 0, "small", "big"), "id": np.arange(n), "a": rng.normal(size=n), "b": rng.normal(50, 9, n), "is_train": (np.arange(n) % 5 > 0).astype(int)})
    pdf["y"] = 3 * pdf.a - 0.2 * pdf.b + rng.normal(size=n)
    df = spark.createDataFrame(pdf)
    out, (name,) = history.ridge_trend(df, "e", "y", "id", features=["a", "b"])
    folds = {r["id"]: r["f"] for r in df.select("id", fn.hash_fold(F.col("id"), 5).alias("f")).collect()}
    got = out.toPandas().set_index("id").sort_index()
    assert got[got.e == "small"][name].isna().all()
    big = pdf[pdf.e == "big"].set_index("id")
    big["f"] = pd.Series(folds)

    def fit(rows):
        x, y = rows[["a", "b"]].to_numpy(), rows["y"].to_numpy()
        xc = x - x.mean(0)
        w = np.linalg.solve(xc.T @ xc + np.eye(2), xc.T @ (y - y.mean()))
        return lambda r: y.mean() + (r[["a", "b"]].to_numpy() - x.mean(0)) @ w

    train = big[big.is_train == 1]
    for f in range(5):
        part = train[train.f == f]
        assert np.allclose(got.loc[part.index, name], fit(train[train.f != f])(part))
    test = big[big.is_train == 0]
    assert np.allclose(got.loc[test.index, name], fit(train)(test))


def test_auc_equals_all_pairs(spark):
    rng = np.random.default_rng(1)
    y, s = rng.integers(0, 2, 300), rng.integers(0, 25, 300) / 10
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean((pos[:, None] > neg).astype(float) + 0.5 * (pos[:, None] == neg))
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s}))
    assert abs(metrics.roc_auc(df, "y", "s").first()[0] - want) < 1e-12
    assert abs(metrics.gini_normalized(df, "y", "s").first()[0] - (2 * want - 1)) < 1e-12


def test_precision_is_zero_without_positive_predictions(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    assert tuple(df.agg(metrics.positive_hit_rate("y", "p"), metrics.false_discovery_rate("y", "p")).first()) == (0.0, 0.0)


def test_adjusted_mutual_info_extremes(spark):
    df = spark.createDataFrame([(i % 2, str(i % 2), str(i), "one") for i in range(100)], "t int, same string, own string, one string")
    got = {r["column"]: r["ami"] for r in quality.adjusted_mutual_info(df, ["same", "own", "one"], "t").collect()}
    assert abs(got["same"] - 1) < 1e-9 and abs(got["own"]) < 1e-6 and abs(got["one"]) < 1e-9


def test_z_test_needs_both_sides(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(19)] + [("b", float(i)) for i in range(30)], "g string, x double")
    assert quality.z_test(df, "g", ["x"]).collect() == []


def test_tfidf_toy_corpus(spark):
    docs = [(0, 1, "The quick brown fox jumped over the lazy dog."), (1, 1, "The dog."), (2, 1, "The fox")]
    df = spark.createDataFrame(docs, "id int, is_train int, text string")
    long, vocab = tf.tfidf(df, "id", "text", tf.word_analyzer(min_df=1))
    idf = {r["term"]: r["idf"] for r in vocab.collect()}
    assert len(idf) == 8 and abs(idf["the"] - 1) < 1e-12 and abs(idf["dog"] - (math.log(4 / 3) + 1)) < 1e-12
    got = {r["term"]: r["weight"] for r in long.filter("id = 1").collect()}
    norm = math.hypot(1, idf["dog"])
    assert abs(got["the"] - 1 / norm) < 1e-12 and abs(got["dog"] - idf["dog"] / norm) < 1e-12


def test_unbounded_vocabulary_gives_the_same_weights(spark):
    docs = [(i, 1, " ".join(f"w{j}" for j in range(i + 1))) for i in range(12)]
    df = spark.createDataFrame(docs, "id int, is_train int, text string")
    a, _ = tf.tfidf(df, "id", "text", tf.word_analyzer(min_df=1))
    b, _ = tf.tfidf(df, "id", "text", tf.word_analyzer(min_df=1, max_features=None))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_char_ngrams(spark):
    df = spark.createDataFrame([("aB  c",), ("x",), ("",)], "t string")
    got = [r[0] for r in df.select(tx.char_ngrams(F.col("t"), 2, 3)).collect()]
    assert got == [["ab", "b ", " c", "ab ", "b c"], [], []]


def test_accents_and_normalisation(spark):
    df = spark.createDataFrame([("Café ñandú\nßx (a/b)!",)], "t string")
    row = df.select(tx.strip_accents(F.col("t")), tx.ascii_fold(F.col("t")), tx.normalize(F.col("t")), tx.word_count(F.col("t"))).first()
    assert row[0] == "Cafe nandu\nßx (a/b)!" and row[1] == "Cafe nandu\nx (a/b)!"
    assert row[2] == "caf and x  ( a / b )  ! " and row[3] == 5


def test_labeled_text_reports_bad_lines(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([("good text __label__1",), (" __label__0",), ("no label",)], "value string").coalesce(1).write.text(path)
    lines = io.scan_labeled_text(spark, path)
    assert io.bad_lines(lines).first()[0] == 1
    assert sorted((r["text"], r["label"]) for r in lines.filter("ok").collect()) == [(" ", 0), ("good text", 1)]


def test_gz_path_adds_only_what_is_missing():
    assert io.gz_path("a", "p/") == "p/a.csv.gz"
    assert io.gz_path("p/a.csv.gz", "p/") == "p/a.csv.gz"


def test_inverse_and_polynomial_names(spark):
    df = spark.createDataFrame([(1, 0.0, 2.0, "s"), (0, 4.0, 5.0, "t")], "is_train int, a double, b double, c string")
    out, new = numeric.inverse_columns(df, ["a", "c"])
    assert new == ["a_inv", "a_inv_inf"] and [tuple(r) for r in out.select(new).collect()] == [(0.0, 1), (0.25, 0)]
    assert numeric.polynomial_features(df, ["a", "b"])[1] == ["a b"]
    assert numeric.polynomial_features(df, ["a", "b"], False)[1] == ["a^2", "a b", "b^2"]


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(6)
    n = 300
    pdf = pd.DataFrame({"id": np.arange(n), "x1": rng.normal(size=n), "x2": rng.normal(size=n), "x3": rng.normal(size=n)})
    pdf["y"] = (pdf.x1 + 0.2 * rng.normal(size=n) > 0).astype(int)
    pdf["is_train"] = (pdf.id % 4 > 0).astype(int)
    return spark.createDataFrame(pdf).cache()


def test_models_find_the_signal(spark, separable):
    table, _report = learn.validate_multilabel(separable, ["x1", "x2", "x3"], ["y"], learn.logistic(max_iter=10))
    assert table.first()["auc_tst"] > 0.9
    assert learn.select_from_model(separable, ["x1", "x2", "x3"], "y", 2.0) == ["x1"]
    assert "x1" in learn.recursive_elimination(separable, ["x1", "x2", "x3"], "y", "id", learn.logistic(max_iter=5), k=2)


def test_shuffled_target_keeps_values(spark, separable):
    out = learn.shuffled_target(separable.select("id", "x1", "y"), "y", "id", 3)
    assert out.count() == 300 and out.agg(F.sum("y")).first()[0] == separable.agg(F.sum("y")).first()[0]
    assert out.orderBy("id").select("y").collect() != separable.orderBy("id").select("y").collect()


def test_classifier_scores_scan_once_per_size(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice(["good", "bad", "dull", "fine"], 6)), i % 2, int(i % 3 == 0), int(i % 5 > 0)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, text string, a int, b int, is_train int")
    params = {t: {"epoch": 3, "lr": 0.5, "word_ngrams": 1} for t in ("a", "b")}
    out, labels, probs = learn.ngram_classifier_score(df, "text", params, "id", k=3, buckets=64)
    assert out.count() == 120 and out.columns == [*df.columns, "a_ft", "a_ft_prob", "b_ft", "b_ft_prob"]
    assert out.filter("a_ft_prob is null or a_ft_prob < 0 or a_ft_prob > 1 or b_ft is null").count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RDD") + plan.count("Relation") <= 2  # the written vectors, not one scan per model


def test_rounding_equals_that_of_decimal_numbers(spark):
    from feldspar.catalog.base import TIE_SHIFT, rounded

    rng = np.random.default_rng(3)
    values = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1e300, -1e17, 0.5, -0.5, 1.005, 5e-324, -TIE_SHIFT * 1e-5]
    values += [float(v) for e in (-7, -3, 0, 3, 6, 9, 12) for v in rng.normal(size=300) * 10.0**e] + [k / 128 for k in range(-200, 200)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 5, 8):
        plain = F.round(F.col("x") + F.lit(TIE_SHIFT * 10**-digits), digits) + F.lit(0.0)
        both = rounded(df.withColumn("y", plain), ["x"], digits)
        assert both.filter("NOT (x <=> y)").count() == 0
        assert both.filter("x = 0 AND cast(x AS string) = '-0.0'").count() == 0


def test_wide_imputation_asks_for_methods_that_are_compiled(spark):
    """Sessions that do not come from local_session have a limit of 65535 bytes."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "65535")
        df = spark.createDataFrame([(1, 1.0), (0, None)], "is_train int, a double")
        missing.nan_inf_impute(df, ["a"])
        assert int(spark.conf.get(name)) <= 8000
    finally:
        spark.conf.set(name, before)
