"""Missing and infinite value handling: one profiling aggregate over all columns, then one projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspar.functions.numeric import INF, is_infinite
from feldspar.operators.profile import TRAIN, q
from feldspar.plans.methods import small_methods


def mean_impute(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null becomes the column mean over train and test rows together."""
    row = df.agg(*[F.avg(q(c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return df.withColumns({c: F.coalesce(q(c).cast("double"), F.lit(row[f"m{i}"])) for i, c in enumerate(columns)})


def inf_impute(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Infinite values in train: both splits get 0 and a signed ``_inf`` flag. In test only: the train mean."""
    if not columns:
        return df, []
    train = q(TRAIN) == 1
    profile = df.agg(
        *[F.count_if(is_infinite(q(c)) & train).alias(f"a{i}") for i, c in enumerate(columns)],
        *[F.count_if(is_infinite(q(c)) & ~train).alias(f"b{i}") for i, c in enumerate(columns)],
        *[F.avg(F.when(train & ~is_infinite(q(c)), q(c))).alias(f"m{i}") for i, c in enumerate(columns)],
    ).first()
    changed, flags = {}, {}
    for i, c in enumerate(columns):
        x = q(c)
        if profile[f"a{i}"]:
            flags[f"{c}_inf"] = F.when(x == INF, 1).when(x == -INF, -1).otherwise(0)
            changed[c] = F.when(is_infinite(x), F.lit(0.0)).otherwise(x)
        elif profile[f"b{i}"]:
            changed[c] = F.when(is_infinite(x), F.lit(profile[f"m{i}"])).otherwise(x)
    return df.withColumns({**flags, **changed}) if changed else df, list(flags)


def nan_impute(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Null values in train: both splits get 0 and a ``_nan`` flag. In test only: the train mean."""
    if not columns:
        return df, []
    train = q(TRAIN) == 1
    profile = df.agg(
        *[F.count_if(q(c).isNull() & train).alias(f"a{i}") for i, c in enumerate(columns)],
        *[F.count_if(q(c).isNull() & ~train).alias(f"b{i}") for i, c in enumerate(columns)],
        *[F.avg(F.when(train, q(c))).alias(f"m{i}") for i, c in enumerate(columns)],
    ).first()
    changed, flags = {}, {}
    for i, c in enumerate(columns):
        if profile[f"a{i}"]:
            flags[f"{c}_nan"] = q(c).isNull().cast("int")
            changed[c] = F.coalesce(q(c).cast("double"), F.lit(0.0))
        elif profile[f"b{i}"]:
            changed[c] = F.coalesce(q(c).cast("double"), F.lit(profile[f"m{i}"]))
    return df.withColumns({**flags, **changed}) if changed else df, list(flags)


def nan_inf_impute(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """:func:`nan_impute` followed by :func:`inf_impute`, from one profiling pass. Returns the new flag columns."""
    if not columns:
        return df, []
    small_methods(df.sparkSession)
    train = q(TRAIN) == 1
    x = [q(c) for c in columns]
    profile = df.agg(
        F.count_if(train).alias("n"),
        *[F.count_if(c.isNull() & train).alias(f"na{i}") for i, c in enumerate(x)],
        *[F.count_if(c.isNull() & ~train).alias(f"nb{i}") for i, c in enumerate(x)],
        *[F.count_if(is_infinite(c) & train).alias(f"ia{i}") for i, c in enumerate(x)],
        *[F.count_if(is_infinite(c) & ~train).alias(f"ib{i}") for i, c in enumerate(x)],
        *[F.avg(F.when(train, c)).alias(f"m{i}") for i, c in enumerate(x)],
        *[F.sum(F.when(train & ~is_infinite(c), c)).alias(f"s{i}") for i, c in enumerate(x)],
    ).first()
    filled, nan_flags = {}, {}
    for i, c in enumerate(columns):
        if profile[f"na{i}"]:
            nan_flags[f"{c}_nan"] = x[i].isNull().cast("int")
            filled[c] = F.coalesce(x[i].cast("double"), F.lit(0.0))
        elif profile[f"nb{i}"]:
            filled[c] = F.coalesce(x[i].cast("double"), F.lit(profile[f"m{i}"]))
    df = df.withColumns({**nan_flags, **filled}) if filled else df
    finite, inf_flags = {}, {}
    for i, c in enumerate(columns):
        if profile[f"ia{i}"]:
            inf_flags[f"{c}_inf"] = F.when(x[i] == INF, 1).when(x[i] == -INF, -1).otherwise(0)
            finite[c] = F.when(is_infinite(x[i]), F.lit(0.0)).otherwise(x[i])
        elif profile[f"ib{i}"]:
            # The train mean after the fill, in which train nulls count as 0.
            mean = (profile[f"s{i}"] or 0.0) / profile["n"] if profile["n"] else None
            finite[c] = F.when(is_infinite(x[i]), F.lit(mean)).otherwise(x[i])
    df = df.withColumns({**inf_flags, **finite}) if finite else df
    return df, [*nan_flags, *inf_flags]
