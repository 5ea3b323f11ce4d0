"""Keyed shuffles, weights and the selections built on them."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from feldspar.functions import numeric as fn
from feldspar.operators import learn
from feldspar.plans.ordering import POSITION
from feldspar.plans.permute import permuted


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 100, 1001])
def test_every_size_is_a_bijection(spark, n):
    one = [r[0] for r in spark.range(n).select(permuted(F.col("id"), n, F.lit(1)).alias("p")).collect()]
    assert sorted(one) == list(range(n))
    if n > 50:
        two = [r[0] for r in spark.range(n).select(permuted(F.col("id"), n, F.lit(2)).alias("p")).collect()]
        assert one != two and sum(a == i for i, a in enumerate(one)) < 10


def test_positions_are_spread_evenly(spark):
    n, keys = 10, 4000
    rows = spark.range(keys).select("id", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    cells = rows.groupBy("i", permuted(F.col("i"), n, F.col("id")).alias("p")).count().collect()
    assert len(cells) == n * n and max(abs(c["count"] - keys / n) for c in cells) < 5 * (keys / n) ** 0.5


def test_poisson(spark):
    drawn = spark.range(40000).select(fn.keyed_poisson(F.col("id"), 0.8, 5).alias("w"))
    row = drawn.agg(F.avg("w"), F.variance("w"), F.avg((F.col("w") == 0).cast("int"))).first()
    assert abs(row[0] - 0.8) < 0.02 and abs(row[1] - 0.8) < 0.03 and abs(row[2] - np.exp(-0.8)) < 0.01


def test_shadows_are_shuffled_apart(spark):
    n = 300
    placed = spark.range(n).select(F.col("id").alias(POSITION), F.array(*[(F.col("id") * 10 + c).cast("double") for c in range(3)]).alias("x"))
    rows = sorted((r[POSITION], r["x"], r["s"]) for r in learn.with_shadows(placed, "x", n, 4, "s").collect())
    own, shadow = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    assert (np.sort(shadow, 0) == np.sort(own, 0)).all()
    source = (shadow - np.arange(3)) / 10
    for a in range(3):
        assert abs(np.corrcoef(source[:, a], np.arange(n))[0, 1]) < 0.2
        for b in range(a):
            assert abs(np.corrcoef(source[:, a], source[:, b])[0, 1]) < 0.2


@pytest.fixture(scope="module")
def signal(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(600, 3)).round(4)
    y = (x[:, 0] + 0.4 * rng.normal(size=600) > 0).astype(int)
    return spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))], "id int, a double, b double, c double, y int")


def test_boruta_confirms_the_signal_under_any_partitioning(signal):
    forest = RandomForestClassifier(numTrees=8, maxDepth=4)
    one, two = ({r["feature"]: (r["hits"], r["decision"]) for r in learn.boruta_select(signal.repartition(p), ["a", "b", "c"], "y", "id", forest, rounds=10).collect()} for p in (3, 30))
    assert one == two
    assert one["a"] == (10, "confirmed") and one["b"][1] != "confirmed" and one["c"][1] != "confirmed"


def test_permutation_importance_under_any_partitioning(signal):
    model = GBTClassifier(maxIter=2, maxDepth=3, seed=7)
    one, two = ([tuple(r) for r in learn.permutation_importance(signal.repartition(p), ["a", "b", "c"], "y", "id", model, runs=2).collect()] for p in (3, 30))
    assert [r[0] for r in one] == [r[0] for r in two] and one[0][0] == "a" and one[0][3] > 1
    for a, b in zip(one, two):
        assert a[1:] == pytest.approx(b[1:], rel=1e-9)


def test_rows_are_dealt_out_by_their_work(spark, monkeypatch):
    """Few bytes, but many permutations: the rows must not meet in one task, nor may the layout change a draw."""
    from feldspar.plans import permute

    placed = spark.range(4000).select(F.col("id").alias(POSITION), F.array(F.col("id"), -F.col("id")).alias("x"))
    before = sorted(map(tuple, learn.with_shadows(placed.coalesce(1), "x", 4000, 4, "s").select(POSITION, "s").collect()))
    monkeypatch.setattr(permute, "MOVED", 1000)
    spread = permute.dealt(placed.coalesce(1), 8000)
    assert spread.rdd.getNumPartitions() == 8
    assert sorted(map(tuple, learn.with_shadows(spread, "x", 4000, 4, "s", width=2).select(POSITION, "s").collect())) == before


def test_a_permutation_is_the_same_for_a_literal_and_a_column_as_key(spark):
    rows = spark.range(500).select("id", F.lit(3).alias("k")).repartition(2)
    pairs = rows.select(permuted(F.col("id"), 500, F.lit(9), F.col("k")).alias("a"), permuted(F.col("id"), 500, F.lit(9), F.lit(3)).alias("b"))
    assert all(r.a == r.b for r in pairs.collect())
