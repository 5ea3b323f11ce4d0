"""Target and category encodings.

Out-of-fold statistics need no loop over folds: with per-category sums S, counts N and per-fold sums s, n,
the mean over the other folds is (S - s) / (N - n). All folds and columns come from one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feldspar.functions.numeric import hash_fold, multiplicative_noise
from feldspar.operators.profile import TRAIN, q
from feldspar.operators.splits import contiguous_blocks
from feldspar.plans.dictionary import VALUE, attach_codes, count_values
from feldspar.plans.lookup import lookup_join
from feldspar.plans.percolumn import tables_by_column
from feldspar.plans.storage import materialize


def _fold_aggregates(target: str, fold: str, k: int) -> list[Column]:
    y = q(target).cast("double")
    out = [F.sum(y).alias("__ysum"), F.count(y).alias("__ycnt")]
    for f in range(k):
        inside = F.when(q(fold) == f, y)
        out += [F.coalesce(F.sum(inside), F.lit(0.0)).alias(f"__sum{f}"), F.count(inside).alias(f"__cnt{f}")]
    return out


def _other_folds(fold: Column, k: int) -> Column:
    """(S - s) / (N - n) of the row's fold; null where no other fold has a row."""
    s = F.lit(0.0)
    n = F.lit(0).cast("long")
    for f in range(k):
        s = F.when(fold == f, F.col(f"__sum{f}")).otherwise(s)
        n = F.when(fold == f, F.col(f"__cnt{f}")).otherwise(n)
    return (F.col("__ysum") - s) / F.nullif(F.col("__ycnt") - n, F.lit(0).cast("long"))


def _work_columns(k: int) -> list[str]:
    return ["__n", "__ysum", "__ycnt", *[f"__{p}{f}" for p in ("sum", "cnt") for f in range(k)]]


def _totals(table: DataFrame, k: int):
    names = ["__ysum", "__ycnt", *[f"__{p}{f}" for p in ("sum", "cnt") for f in range(k)]]
    return table.agg(*[F.sum(n).alias(n) for n in names]).first()


def _ratio(s: float, n: int) -> float | None:
    return s / n if n else None


def oof_target_mean(
    df: DataFrame, columns: Sequence[str], target: str, key: str, k: int = 5, fold: str | None = None
) -> tuple[DataFrame, list[str]]:
    """Out-of-fold category means.

    Train rows: mean target of the category over the other folds. Test rows: over all train rows. Null and
    unseen categories: the mean of those same rows regardless of category. ``fold`` names an existing fold
    column; otherwise folds come from the md5 of ``key``.
    """
    work = df if fold else df.withColumn("__fold", hash_fold(q(key), k))
    fold = fold or "__fold"
    train = work.filter(q(TRAIN) == 1).select(*dict.fromkeys([*columns, target, fold]))
    tables = tables_by_column(train, columns, _fold_aggregates(target, fold, k))
    new = []
    for c in columns:
        total = _totals(tables[c], k)
        rest = F.lit(None).cast("double")
        for f in range(k):
            mean = _ratio((total["__ysum"] or 0.0) - (total[f"__sum{f}"] or 0.0), (total["__ycnt"] or 0) - (total[f"__cnt{f}"] or 0))
            rest = F.when(q(fold) == f, F.lit(mean)).otherwise(rest)
        overall = F.lit(_ratio(total["__ysum"] or 0.0, total["__ycnt"] or 0))
        joined = lookup_join(work, tables[c], [c], weight="__n", null_safe=False, stored=True)
        seen = F.col("__ysum") / F.nullif(F.col("__ycnt"), F.lit(0).cast("long"))
        value = F.when(q(TRAIN) == 1, F.coalesce(_other_folds(q(fold), k), rest)).otherwise(F.coalesce(seen, overall))
        name = f"oof_{target}@{c}"
        work = joined.withColumn(name, value).drop(*_work_columns(k))
        new.append(name)
    return work.drop("__fold"), new


def smoothed_target_mean(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    min_samples_leaf: int = 200,
    smoothing: float = 10,
    noise_level: float = 0,
    seed: int = 7,
    key: str | None = None,
) -> tuple[DataFrame, list[str]]:
    """Category mean m shrunk to the prior: prior*(1-l) + m*l with l = 1/(1+exp(-(n-min_leaf)/smoothing)).

    The same train table serves train and test rows (train values are in-sample); null and unseen give the prior.
    Noise is drawn from ``key``, anew for every column.
    """
    train = df.filter(q(TRAIN) == 1).select(*dict.fromkeys([*columns, target]))
    y = q(target).cast("double")
    tables = tables_by_column(train, columns, [F.sum(y).alias("__ysum"), F.count(y).alias("__ycnt")])
    new = []
    for i, c in enumerate(columns):
        total = tables[c].agg(F.sum("__ysum").alias("s"), F.sum("__ycnt").alias("n")).first()
        prior = F.lit(_ratio(total["s"] or 0.0, total["n"] or 0))
        mean = F.col("__ysum") / F.nullif(F.col("__ycnt"), F.lit(0).cast("long"))
        lam = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("__ycnt") - min_samples_leaf) / F.lit(float(smoothing))))
        joined = lookup_join(df, tables[c], [c], weight="__n", null_safe=False, stored=True)
        value = F.coalesce(prior * (F.lit(1.0) - lam) + mean * lam, prior)
        name = f"smooth_{target}@{c}"
        df = joined.withColumn(name, multiplicative_noise(value, noise_level, None if key is None else q(key), seed + i)).drop("__n", "__ysum", "__ycnt")
        new.append(name)
    return df, new


def likelihood_encoding(
    df: DataFrame, columns: Sequence[str], target: str, order: Sequence[str], k: int = 5
) -> tuple[DataFrame, list[str]]:
    """Target mean over the other contiguous row blocks; null is its own category, unseen gives 0."""
    train = contiguous_blocks(df.filter(q(TRAIN) == 1), order, k, "__fold")
    test = df.filter((q(TRAIN) != 1) | q(TRAIN).isNull()).withColumn("__fold", F.lit(None).cast("int"))
    tables = tables_by_column(
        train.select(*dict.fromkeys([*columns, target, "__fold"])), columns, _fold_aggregates(target, "__fold", k)
    )
    work = train.unionByName(test)
    new = []
    for c in columns:
        joined = lookup_join(work, tables[c], [c], weight="__n", stored=True)
        seen = F.col("__ysum") / F.nullif(F.col("__ycnt"), F.lit(0).cast("long"))
        value = F.when(q(TRAIN) == 1, _other_folds(F.col("__fold"), k)).otherwise(seen)
        name = f"{c}_tar_avg"
        work = joined.withColumn(name, F.coalesce(value, F.lit(0.0))).drop(*_work_columns(k))
        new.append(name)
    return work.drop("__fold"), new


def encode_flags(
    df: DataFrame, flags: str, width: int, target: str, key: str, k: int = 5, min_samples_leaf: int = 200, smoothing: float = 10
) -> tuple[DataFrame, list[str]]:
    """Out-of-fold and smoothed target means for an array of ``width`` 0/1 flags, as two arrays.

    For hundreds of indicator columns: only set flags are exploded and aggregated; unset ones follow by
    subtraction from the totals. The statistics are ``width`` rows and enter the projection as literal arrays.
    """
    y = q(target).cast("double")
    fold = hash_fold(q(key), k)
    train = df.filter((q(TRAIN) == 1) & y.isNotNull()).select(q(flags).alias("f"), y.alias("y"), fold.alias("fold"))
    per = lambda: [
        *[F.coalesce(F.sum(F.when(F.col("fold") == f, F.col("y"))), F.lit(0.0)).alias(f"s{f}") for f in range(k)],
        *[F.count_if(F.col("fold") == f).alias(f"n{f}") for f in range(k)],
    ]
    total = train.agg(*per()).first()
    hits = train.select("fold", "y", F.posexplode("f").alias("i", "v")).filter("v = 1").groupBy("i").agg(*per())
    on = {r["i"]: r for r in hits.collect()}  # one row per flag position
    S, N = sum(total[f"s{f}"] for f in range(k)), sum(total[f"n{f}"] for f in range(k))
    prior = S / N if N else 0.0
    if N == 0:
        raise ValueError("no train row has a target")

    def mean(s: float, n: int, default: float) -> float:
        return s / n if n else default

    import math

    oof: list[list[float]] = []
    full: list[list[float]] = []
    smooth: list[list[float]] = []
    for i in range(width):
        r = on.get(i)
        row_oof, row_full, row_smooth = [], [], []
        for bit in (0, 1):
            s = [(r[f"s{f}"] if r else 0.0) if bit else total[f"s{f}"] - (r[f"s{f}"] if r else 0.0) for f in range(k)]
            n = [(r[f"n{f}"] if r else 0) if bit else total[f"n{f}"] - (r[f"n{f}"] if r else 0) for f in range(k)]
            for f in range(k):
                rest = mean(S - total[f"s{f}"], N - total[f"n{f}"], prior)
                row_oof.append(mean(sum(s) - s[f], sum(n) - n[f], rest))
            row_full.append(mean(sum(s), sum(n), prior))
            lam = 1.0 / (1.0 + math.exp(min(-(sum(n) - min_samples_leaf) / smoothing, 700.0)))
            row_smooth.append(prior * (1 - lam) + mean(sum(s), sum(n), prior) * lam)
        oof.append(row_oof)
        full.append(row_full)
        smooth.append(row_smooth)

    def pick(table: list[list[float]], offset: Column) -> Column:
        flat = F.lit([v for row in table for v in row]).cast("array<double>")
        step = len(table[0]) if table else 1
        return F.transform(q(flags), lambda v, i: F.get(flat, (i * step + offset(v)).cast("int")))

    oof_name, smooth_name = f"oof_{target}@{flags}", f"smooth_{target}@{flags}"
    out = df.withColumn(
        oof_name,
        F.when(q(TRAIN) == 1, pick(oof, lambda v: v * k + fold)).otherwise(pick(full, lambda v: v)),
    ).withColumn(smooth_name, pick(smooth, lambda v: v))
    return out, [oof_name, smooth_name]


def category_codes(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Code in sorted order of the distinct values over train and test; null is -1. One scan serves all columns."""
    new = {f"{c}_cat": q(c) for c in columns}
    out, _ = attach_codes(df, new)
    return out.withColumns({n: F.coalesce(q(n), F.lit(-1)).cast("int") for n in new}), list(new)


def interaction_codes(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Sorted code of ``str(a)-str(b)`` for each column pair; null becomes ``nan``. One scan serves all pairs."""
    texts = {c: F.coalesce(q(c).cast("string"), F.lit("nan")) for c in columns}
    new = {f"{a}-{b}": F.concat_ws("-", texts[a], texts[b]) for a, b in combinations(columns, 2)}
    out, _ = attach_codes(df, new)
    return out.withColumns({n: q(n).cast("int") for n in new}), list(new)


def one_hot(df: DataFrame, columns: Sequence[str], widest: int = 4096) -> tuple[DataFrame, list[str]]:
    """Indicator column per value plus one for null.

    A column with more than ``widest`` values gets one column ``<c>_hot`` instead, the name of its indicator that is 1;
    ``one_hot_long`` gives the same as rows. One scan counts the values of all columns.
    """
    if not columns:
        return df, []
    counted = count_values(df, {c: q(c) for c in columns})
    figures = counted.figures()
    new = {}
    for c in columns:
        if c in figures and figures[c]["values"] > widest:
            new[f"{c}_hot"] = _indicator(c)
            continue
        for v in sorted(r[0] for r in counted.of(c).select(VALUE).collect()):  # at most ``widest``
            new[f"{c}_{v}"] = q(c).eqNullSafe(F.lit(v)).cast("int")
        new[f"{c}_nan"] = q(c).isNull().cast("int")
    return df.withColumns(new), list(new)


def _indicator(c: str) -> Column:
    return F.concat(F.lit(f"{c}_"), F.coalesce(q(c).cast("string"), F.lit("nan")))


def one_hot_long(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, feature): the indicators of every row that are 1, for columns with more values than a schema can hold."""
    return df.select(q(key), F.explode(F.array(*[_indicator(c) for c in columns])).alias("feature"))


def binary_encode(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Bits (most significant first) of the value's index by first appearance over train, then test rows."""
    texts = {f"__code{i}": F.coalesce(q(c).cast("string"), F.lit("nan")) for i, c in enumerate(columns)}
    out, sizes = attach_codes(df, texts, [F.lit(1) - q(TRAIN), *[q(o) for o in order]])
    new = {}
    for c, code in zip(columns, texts):
        bits = max((sizes[code] - 1).bit_length(), 1)
        new |= {f"{c}_b{i}": F.shiftright(q(code), bits - 1 - i).bitwiseAND(F.lit(1).cast("long")).cast("int") for i in range(bits)}
    return out.withColumns(new).drop(*texts), list(new)
