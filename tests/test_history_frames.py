"""Sliding frames against a fresh computation of every frame."""

import datetime

import numpy as np
import pandas as pd
import pytest

from feldspar.operators import history as hi


def frames(rng, n):
    start = np.sort(rng.integers(0, n + 1, n))
    return start, np.maximum(start, np.sort(rng.integers(0, n + 1, n)))


@pytest.mark.parametrize("seed", range(6))
def test_percentiles_and_moments(seed, monkeypatch):
    monkeypatch.setattr(hi, "FRAME_ROWS", 7)
    rng = np.random.default_rng(seed)
    n = int(rng.integers(0, 60))
    values = rng.integers(1, 6, n) / 3.0 if seed % 2 else np.exp(rng.normal(0, 3, n))
    start, stop = frames(rng, n)
    with np.errstate(all="ignore"):
        got = hi._frame_statistics(values, start, stop) if n else {}
    percentiles = hi._sliding_percentiles(values, start, stop, (0.1, 0.5, 0.9))
    for i, (a, b) in enumerate(zip(start, stop)):
        part = pd.Series(values[a:b])
        same = part.nunique() <= 1
        expected = {
            "cnt": len(part), "mean": part.mean(), "hmean": len(part) / (1 / part).sum() if len(part) else np.nan, "std": part.std(),
            "skew": np.nan if same else part.skew(), "kurt": np.nan if same else part.kurt(),
        }
        for name, value in expected.items():
            assert got[name][i] == pytest.approx(value, rel=1e-9, abs=1e-9, nan_ok=True), (name, part.tolist())
        for p, v in zip((0.1, 0.5, 0.9), percentiles[i]):
            assert v == pytest.approx(part.quantile(p), rel=1e-12, nan_ok=True)


def test_gaps_masked_days_and_null_entity(spark):
    day = lambda i: datetime.date(2020, 1, 1) + datetime.timedelta(i)
    rows = [(e, day(i), float(i % 7 + 1), int(i < 100)) for e in ("a", None) for i in range(0, 110, 3)]
    rows += [("a", day(0), 50.0, 1), ("b", day(105), 9.0, 0), ("c", None, 2.0, 1)]
    df = spark.createDataFrame(rows, "e string, d date, v double, is_train int")
    out, new = hi.history_distribution(df, "e", "d", "v", ["v"])
    got = out.toPandas()
    assert len(got) == len(rows) and len(new) == 45
    tp = max(r[1] for r in rows if not r[3] and r[1]) - min(r[1] for r in rows if not r[3] and r[1])
    last = got[got.e.isna() & (got.d == day(108))].iloc[0]
    frame = [r[2] for r in rows if r[0] is None and r[3] and 0 <= (day(108) - r[1]).days - tp.days < 30]
    assert last[f"cnt_on_{tp.days + 29}-{tp.days}(30)"] == len(frame)
    assert last[f"med_on_{tp.days + 29}-{tp.days}(30)"] == pytest.approx(np.median(frame))
    assert got[got.e == "b"][new].isna().all(axis=None) and got[got.e == "c"][new].isna().all(axis=None)


def test_value_must_be_positive(spark):
    rows = [("a", datetime.date(2020, 1, 1), 0.0, 1), ("a", datetime.date(2020, 1, 2), 1.0, 0)]
    with pytest.raises(ValueError):
        hi.history_distribution(spark.createDataFrame(rows, "e string, d date, v double, is_train int"), "e", "d", "v", ["v"])
