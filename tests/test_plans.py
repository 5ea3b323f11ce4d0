"""The scale paths give the same results as the small-data paths."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from feldspar.operators import groupstats, history
from feldspar.plans import lookup, ordering
from feldspar.plans.percolumn import tables_by_column


@pytest.fixture()
def skewed(spark):
    """A third of all rows share one key; some keys are null."""
    n = 3000
    rng = np.random.default_rng(5)
    key = np.where(np.arange(n) % 3 == 0, 7, rng.integers(0, 400, n)).astype(object)
    key[::50] = None
    pdf = pd.DataFrame({"id": np.arange(n), "k": key, "x": rng.normal(size=n).round(2)})
    pdf.loc[::11, "x"] = np.nan
    df = spark.createDataFrame(pdf.astype({"k": "Int64"}))
    return df.withColumn("x", F.when(~F.isnan("x"), F.col("x"))).withColumn("is_train", (F.col("id") % 4 > 0).cast("int"))


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple(str(v) for v in t))


@pytest.mark.parametrize("null_safe", [True, False])
def test_spread_join_equals_broadcast_join(spark, skewed, null_safe):
    table = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("s")).filter("k is null or k % 2 = 1")
    small = lookup.lookup_join(skewed, table, ["k"], "n", null_safe)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(lookup.MAX_BYTES_CONF, "0")
    try:
        big = lookup.lookup_join(skewed, table, ["k"], "n", null_safe)
        assert "SortMergeJoin" in big._jdf.queryExecution().executedPlan().toString()
        assert big.columns == small.columns
        assert rows(big) == rows(small)
        assert big.count() == skewed.count()
    finally:
        spark.conf.unset(lookup.MAX_BYTES_CONF)


def test_positions_follow_the_order(spark, skewed):
    got = ordering.with_position(skewed.repartition(9), [F.col("x"), F.col("id")]).toPandas()
    got = got.sort_values(ordering.POSITION)
    assert got[ordering.POSITION].tolist() == list(range(len(got)))
    want = skewed.toPandas().sort_values(["x", "id"], na_position="first")
    assert got["id"].tolist() == want["id"].tolist()


def test_positions_with_heavy_ties(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("v"))
    got = ordering.with_position(df, [F.col("v")], ties=True)
    spans = {r["v"]: (r["a"], r["b"]) for r in got.groupBy("v").agg(F.min("__pos").alias("a"), F.max("__pos").alias("b")).collect()}
    assert spans == {0: (0, 2499), 1: (2500, 4999)}
    assert got.select("__pos").distinct().count() == 5000


def test_group_positions(spark, skewed):
    got = ordering.group_positions(skewed, ["k"], [F.col("id")]).toPandas()
    got["want"] = got.sort_values("id").groupby("k", dropna=False).cumcount()
    assert (got["__pos"] == got["want"]).all()


def test_sorted_quantiles_equal_percentile(spark, skewed):
    df = skewed.filter("k is not null")
    probs = [0.1, 0.5, 0.9]
    small = ordering.grouped_quantiles(df, ["k"], ["x"], probs, largest_group=10)
    big = ordering.grouped_quantiles(df, ["k"], ["x"], probs, largest_group=10, in_memory=0)
    a, b = (f.toPandas().sort_values("k").reset_index(drop=True) for f in (small, big))
    assert a["k"].tolist() == b["k"].tolist()
    for p in probs:
        assert np.allclose(a[f"x@{p}"], b[f"x@{p}"], atol=1e-12, equal_nan=True)


def test_group_stats_equal_pandas(spark, skewed):
    """Hot and null groups, null values, repeated values, several columns at once."""
    df = skewed.withColumn("w", (F.col("id") % 5).cast("int")).withColumn("h", F.when(F.col("id") < 2, F.lit("one")).when(F.col("id") < 3, F.lit("two")))
    got, new = groupstats.group_stats(df, ["x", "w"], ["k", "h"])
    got = got.toPandas().sort_values("id").reset_index(drop=True)
    for g in ("k", "h"):
        keys = got[g].astype(object).where(got[g].notna(), "nan")
        for o in ("x", "w"):
            by = got[o].astype(float).groupby(keys)
            expected = {"count": keys.groupby(keys).transform("size"), **{s: by.transform(s) for s in ("mean", "std", "median", "max", "min")}}
            for s, e in expected.items():
                assert np.allclose(got[f"{o}_{s}_on_{g}"].astype(float), e.fillna(0).astype(float)), (o, s, g)
    assert len(new) == 2 * 2 * 6
    empty, _ = groupstats.group_stats(df.limit(0), ["x"], ["k"])
    assert empty.count() == 0


def test_running_counts(spark, skewed):
    got = ordering.running_counts(skewed, [F.col("id")], {"n": F.col("x").isNull()}).toPandas().sort_values("id")
    assert got["n"].tolist() == got["x"].isna().cumsum().tolist()


def test_tables_by_column_keep_null_groups(spark, skewed):
    df = skewed.withColumn("parity", F.when(F.col("id") % 10 > 0, F.col("id") % 2))
    tables = tables_by_column(df, ["k", "parity"], [F.count("x").alias("c")])
    for c in ("k", "parity"):
        want = df.groupBy(c).agg(F.count(F.lit(1)).alias("__n"), F.count("x").alias("c"))
        assert rows(tables[c].select(c, "__n", "c")) == rows(want.select(c, "__n", "c"))


def test_flag_history_paths_agree(spark):
    days = pd.date_range("2020-01-01", periods=500)
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"e": rng.integers(0, 3, 500), "d": days.date, "v": rng.integers(1, 9, 500).astype(float), "f": rng.integers(0, 2, 500), "is_train": 1})
    df = spark.createDataFrame(pdf)
    small, new = history.flag_history(df, "e", "d", "v", "f")
    big, _ = history.flag_history(df, "e", "d", "v", "f", in_memory=0)
    a, b = (x.toPandas().sort_values(["e", "d"])[new].to_numpy(float) for x in (small, big))
    assert np.allclose(a, b, equal_nan=True)


def test_results_do_not_depend_on_partitions(spark, skewed):
    from feldspar.operators.encode import category_codes, oof_target_mean

    def run():
        df, _ = oof_target_mean(skewed, ["k"], "x", "id")
        df, _ = category_codes(df, ["k"])
        return df.toPandas().sort_values("id").reset_index(drop=True)

    first = run()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        pd.testing.assert_frame_equal(first, run())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
