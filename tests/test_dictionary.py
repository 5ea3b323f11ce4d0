"""One dictionary for many columns: codes, counts of values, wide indicators."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from feldspar.operators import encode
from feldspar.plans import dictionary
from feldspar.plans.lookup import MAX_BYTES_CONF


def _frame(spark):
    rows = [(i, i % 2, None if i % 7 == 0 else f"s{(i * 37) % 11}", (i * 13) % 5 - 2, None if i % 3 else float(i % 9)) for i in range(200)]
    return spark.createDataFrame(rows, "k int, is_train int, s string, n long, x double")


def _ranks(values: pd.Series) -> list[int]:
    place = {v: i for i, v in enumerate(sorted(values.dropna().unique()))}
    return [place.get(v, -1) if pd.notna(v) else -1 for v in values]


def test_codes_of_mixed_types(spark):
    df = _frame(spark)
    out, new = encode.category_codes(df, ["s", "n", "x"])
    got = out.toPandas().sort_values("k")
    assert new == ["s_cat", "n_cat", "x_cat"] and list(got.columns) == [*df.columns, *new]
    for c in "snx":
        assert got[f"{c}_cat"].tolist() == _ranks(got[c])


def test_codes_beyond_the_broadcast_bound(spark):
    df = _frame(spark)
    small = encode.category_codes(df, ["s", "n", "x"])[0].toPandas().sort_values("k").reset_index(drop=True)
    spark.conf.set(MAX_BYTES_CONF, "0")
    try:
        big = encode.category_codes(df, ["s", "n", "x"])[0].toPandas().sort_values("k").reset_index(drop=True)
    finally:
        spark.conf.unset(MAX_BYTES_CONF)
    pd.testing.assert_frame_equal(small, big)


def test_codes_replace_columns_of_their_name(spark):
    df = _frame(spark).withColumn("s_cat", F.lit(9))
    out, _ = encode.category_codes(df, ["s"])
    assert out.columns.count("s_cat") == 1 and out.agg(F.min("s_cat")).first()[0] == -1


def test_codes_of_empty_and_null_columns(spark):
    empty = encode.category_codes(_frame(spark).limit(0), ["s", "n"])[0]
    assert empty.count() == 0
    nulls = spark.createDataFrame([(1, None), (2, None)], "k int, s string")
    assert [r["s_cat"] for r in encode.category_codes(nulls, ["s"])[0].collect()] == [-1, -1]
    assert encode.category_codes(nulls, [])[1] == []


def test_pairs_and_bits_share_a_scan(spark):
    df = _frame(spark)
    out, new = encode.interaction_codes(df, ["s", "n", "x"])
    assert new == ["s-n", "s-x", "n-x"]
    got = out.toPandas()
    texts = got["s"].fillna("nan") + "-" + got["n"].astype(str)
    assert got["s-n"].tolist() == _ranks(texts)
    bits, names = encode.binary_encode(df, ["s", "n"], ["k"])
    rows = bits.toPandas().sort_values(["is_train", "k"], ascending=[False, True])
    for c in "sn":
        own = [n for n in names if n.startswith(f"{c}_b")]
        code = sum(rows[n].astype(int) * 2 ** (len(own) - 1 - i) for i, n in enumerate(own)).tolist()
        values = rows[c].fillna("nan").tolist()
        place = {v: i for i, v in enumerate(dict.fromkeys(values))}
        assert code == [place[v] for v in values]


def test_wide_columns_keep_their_indicator_by_name(spark):
    df = _frame(spark)
    out, new = encode.one_hot(df, ["s", "n"], widest=5)
    assert new == ["s_hot", *[f"n_{v}" for v in range(-2, 3)], "n_nan"]
    got = out.toPandas()
    assert got["s_hot"].tolist() == ("s_" + got["s"].fillna("nan")).tolist()
    long = encode.one_hot_long(df, "k", ["s"]).toPandas().set_index("k")["feature"]
    assert long.loc[got["k"]].tolist() == got["s_hot"].tolist()


def test_figures_per_column(spark):
    df = _frame(spark)
    figures = dictionary.count_values(df, {c: F.col(c) for c in ("s", "n", "x")}).figures(F.sum(dictionary.COUNT).alias("rows"))
    pdf = df.toPandas()
    assert {c: (figures[c]["values"], figures[c]["rows"]) for c in "snx"} == {c: (pdf[c].nunique(), pdf[c].notna().sum()) for c in "snx"}
