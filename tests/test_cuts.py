"""Keys at ranks against a sort, by way of small brackets and samples."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feldspar.operators import splits
from feldspar.plans import cuts


@pytest.fixture(params=["sorted", "narrowed"])
def few(request, monkeypatch):
    if request.param == "narrowed":
        monkeypatch.setattr(cuts, "SORTED", 90)
        monkeypatch.setattr(cuts, "SAMPLE", 500)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def test_mixed_keys_with_nulls(spark, few):
    rng = np.random.default_rng(1)
    rows = [(None if i % 9 == 0 else float(rng.normal()), f"s{rng.integers(0, 50)}" if i % 7 else None, i) for i in range(1500)]
    df = spark.createDataFrame(rows, "a double, b string, c int").repartition(5)
    ranks = [0, 166, 167, 1499]
    assert [tuple(k) for k in cuts.keys_at(df, ["a", "b", "c"], ranks, 1500)] == [ordered(rows)[r] for r in ranks]


@pytest.mark.parametrize("values", [[5] * 900, [1] * 400 + [2] * 500, [3] * 850 + list(range(4, 54)), list(range(-50, 0)) + [0] * 850, [i % 4 for i in range(900)]])
def test_equal_keys(spark, few, values):
    df = spark.createDataFrame([(v,) for v in values], "a int")
    ranks = [0, 449, 450, 899]
    assert [k[0] for k in cuts.keys_at(df, ["a"], ranks, 900)] == [sorted(values)[r] for r in ranks]


@pytest.mark.parametrize("n", [0, 1, 5, 103])
def test_splits_follow_positions(spark, n):
    df = spark.range(n).select((F.col("id") * 7 % 211).alias("v"), "id").repartition(3)
    order = ["v", "id"]
    got = lambda out, c: [r[c] for r in out.orderBy(*order).collect()]
    base, extra = divmod(n, 4)
    assert got(splits.kfold_contiguous(df, order, 4), "fold") == [f for f in range(4) for _ in range(base + (f < extra))]
    size = max(n // 4, 1)
    assert got(splits.contiguous_blocks(df, order, 4), "fold") == [min(i // size, 3) for i in range(n)]
    size = max(n // 4, 1)
    first = size + n % 4
    assert got(splits.time_series_split(df, order, 3), "block") == [0 if i < first else (i - first) // size + 1 for i in range(n)]
    assert got(splits.train_test_split_ordered(df, order, 0.33), "is_train") == [int(i < int(n * 0.67)) for i in range(n)]


def test_no_row_is_moved(spark):
    df = spark.range(1000)
    out = splits.kfold_contiguous(df, ["id"], 5)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_keys_are_collected_without_a_sort_across_the_cluster(spark, few, monkeypatch):
    """A sort by ranges scans its input twice, and a filter works out the order columns for each comparison."""
    df = spark.range(1500).select((F.col("id") * 7 % 1511).alias("v.w"), "id").repartition(3)
    monkeypatch.setattr(type(df), "sort", lambda *_: pytest.fail("sorted across the cluster"))
    monkeypatch.setattr(type(df), "filter", lambda *_: pytest.fail("filtered"))
    values = sorted(i * 7 % 1511 for i in range(1500))
    assert [k[0] for k in cuts.keys_at(df, ["v.w", "id"], [0, 700, 1499], 1500)] == [values[0], values[700], values[1499]]
