"""Lagged history over irregular daily series.

Rows are first reduced to one row per (entity, day), so a window partition holds at most the days of one
entity however many rows it has. RANGE frames on an integer day or month number replace gap-filled grids.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feldspar.functions.calendar import day_number, month_number
from feldspar.functions.numeric import hash_fold
from feldspar.operators.missing import mean_impute
from feldspar.operators.profile import TRAIN, assert_no_nulls, q
from feldspar.plans.lookup import lookup_join
from feldspar.plans.ordering import grouped_quantiles, running_counts
from feldspar.plans.spread import spread
from feldspar.plans.storage import materialize


def daily_series(
    df: DataFrame, entity: str, day: str, value: str, order: Sequence[str], use_test_target: bool = False
) -> DataFrame:
    """(entity, day, ``__d`` day number, ``__v`` value, ``__n`` rows): of equal days the last row wins.

    Test rows come after train rows; their value is masked unless ``use_test_target``.
    """
    v = q(value).cast("double")
    if not use_test_target:
        v = F.when(q(TRAIN) == 1, v)
    rank = F.struct(F.lit(1) - q(TRAIN), *[q(o) for o in order])
    daily = df.groupBy(entity, day).agg(F.max_by(v, rank).alias("__v"), F.count(F.lit(1)).alias("__n"))
    return spread(daily, entity).withColumn("__d", day_number(q(day)))


def horizon(df: DataFrame, day: str) -> int:
    """Days between the first and last test day."""
    row = df.filter(q(TRAIN) == 0).agg(F.min(day).alias("a"), F.max(day).alias("b")).first()
    if row["a"] is None:
        raise ValueError("there are no test rows")
    return (row["b"] - row["a"]).days


def history_mean_count_std(
    df: DataFrame, entity: str, day: str, value: str, order: Sequence[str], use_test_target: bool = False, prefix: str = "store_visitors"
) -> tuple[DataFrame, list[str]]:
    """Mean, count and sample std of the L days that ended tp days ago, for the (L; tp) grid past the horizon."""
    offset = horizon(df, day)
    weeks = math.ceil(offset / 7.0)
    grid = (
        [(1, (weeks + i) * 7) for i in range(4)]
        + [(7, offset + i * 7 + 1) for i in range(4)]
        + [(30, offset + i * 30 + 1) for i in range(2)]
        + [(60, offset + i * 60 + 1) for i in range(2)]
    )
    daily = daily_series(df, entity, day, value, order, use_test_target)
    whole = Window.partitionBy(entity)
    daily = daily.withColumns(
        {"__first": F.min("__d").over(whole), "__any": F.max(F.col("__v").isNotNull()).over(whole)}
    )
    new = {}
    for length, tp in grid:
        frame = Window.partitionBy(entity).orderBy("__d").rangeBetween(-(tp + length - 1), -tp)
        span = f"over_day_{tp}-{tp + length - 1}_in_past"
        alive = F.col("__any") & (F.col("__d") - tp >= F.col("__first"))
        new[f"{prefix}_mean_{span}"] = F.avg("__v").over(frame)
        new[f"{prefix}_count_{span}"] = F.when(alive, F.count("__v").over(frame))
        if length > 1:
            new[f"{prefix}_std_{span}"] = F.stddev_samp("__v").over(frame)
    table = daily.select(entity, day, "__n", *[c.alias(n) for n, c in new.items()])
    return lookup_join(df, table, [entity, day], weight="__n").drop("__n"), list(new)


def skew_kurt(n: Column, g1: Column, g2: Column) -> tuple[Column, Column]:
    """Bias-corrected skewness (n >= 3) and excess kurtosis (n >= 4) from the population ones."""
    n = n.cast("double")
    skew = F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))
    kurt = F.when(n >= 4, (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0)) * ((n + 1) * g2 + 6))
    return skew, kurt


# The frame lengths in days and the order of the statistics' columns.
HISTORY_LENGTHS = (30, 60, 90, 180, 360)
HISTORY_STATS = ("cnt", "mean", "med", "hmean", "std", "skew", "kurt", "pct10", "pct90")
#: Frames laid side by side in memory.
FRAME_ROWS = 4096


def _sliding_percentiles(values: np.ndarray, start: np.ndarray, stop: np.ndarray, probs: Sequence[float]) -> np.ndarray:
    """Linear-interpolation percentiles of values[start:stop] for frames whose ends never move back; NaN where empty.

    One sorted list follows the frames: a value enters and leaves it once.
    """
    out = np.full((len(start), len(probs)), np.nan)
    held: list[float] = []
    first = last = 0
    for i, (a, b) in enumerate(zip(start.tolist(), stop.tolist())):
        for v in values[last:b].tolist():
            insort(held, v)
        last = max(last, b)
        for v in values[first:a].tolist():
            del held[bisect_left(held, v)]
        first = max(first, a)
        if held:
            for j, p in enumerate(probs):
                at = p * (len(held) - 1)
                low = int(at)
                high = min(low + 1, len(held) - 1)
                out[i, j] = held[low] * (1 - (at - low)) + held[high] * (at - low)
    return out


def _frame_statistics(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> dict[str, np.ndarray]:
    """Count, mean, harmonic mean, sample std, bias-corrected skewness and kurtosis of values[start:stop]; NaN where undefined."""
    n = (stop - start).astype(float)
    width = int(n.max()) if len(n) else 0
    parts = []
    for at in range(0, len(n), FRAME_ROWS):
        rows = slice(at, at + FRAME_ROWS)
        cells = start[rows, None] + np.arange(width)
        inside = cells < stop[rows, None]
        v = np.where(inside, values[np.minimum(cells, len(values) - 1)], 0.0) if len(values) else np.zeros(cells.shape)
        m = n[rows]
        mean = v.sum(1) / m
        inverse = np.where(inside, 1.0 / np.where(inside, v, 1.0), 0.0).sum(1)
        gap = np.where(inside, v - mean[:, None], 0.0)
        square = gap * gap
        m2, m3, m4 = square.sum(1) / m, (square * gap).sum(1) / m, (square * square).sum(1) / m
        varied = m2 > 0
        skew = np.where(varied & (m >= 3), m3 / m2**1.5 * np.sqrt(m * (m - 1)) / (m - 2), np.nan)
        kurt = np.where(varied & (m >= 4), (m - 1) / ((m - 2) * (m - 3)) * ((m + 1) * (m4 / (m2 * m2) - 3) + 6), np.nan)
        std = np.where(m >= 2, np.sqrt(square.sum(1) / (m - 1)), np.nan)
        same = np.where(inside, v == v[:, :1], True).all(1)  # a mean that is off by its last bit is no spread
        parts.append((mean, m / inverse, np.where(same & (m >= 2), 0.0, std), np.where(same, np.nan, skew), np.where(same, np.nan, kurt)))
    return dict(zip(("mean", "hmean", "std", "skew", "kurt"), map(np.concatenate, zip(*parts)))) | {"cnt": n}


def history_distribution(
    df: DataFrame, entity: str, day: str, value: str, order: Sequence[str], use_test_target: bool = False
) -> tuple[DataFrame, list[str]]:
    """Nine statistics of the last 30, 60, 90, 180 and 360 days before the horizon; values must be positive.

    The rows are read once for one value per (entity, day), from which the horizon and all frames follow. An entity's days
    are one group, bounded by the calendar however many rows it has.
    """
    v = q(value).cast("double")
    if not use_test_target:
        v = F.when(q(TRAIN) == 1, v)
    rank = F.struct(F.lit(1) - q(TRAIN), *[q(o) for o in order])
    sums = [F.max_by(v, rank).alias("v"), F.count(F.lit(1)).alias("n"), F.max(q(TRAIN) == 0).alias("test")]
    daily = materialize(df.groupBy(entity, day).agg(*sums))
    known = daily.agg(F.min(F.when(F.col("test"), q(day))).alias("a"), F.max(F.when(F.col("test"), q(day))).alias("b"), F.count_if(F.col("v") <= 0).alias("bad")).first()
    if known["a"] is None:
        raise ValueError("there are no test rows")
    if known["bad"]:
        raise ValueError(f"{value} must be greater than 0")
    tp = (known["b"] - known["a"]).days
    names = {length: [f"{s}_on_{tp + length - 1}-{tp}({length})" for s in HISTORY_STATS] for length in HISTORY_LENGTHS}
    new = [n for part in names.values() for n in part]

    def describe(table: pa.Table) -> pa.Table:
        table = table.sort_by("d")
        d = table.column("d").to_numpy()
        v = table.column("v").to_numpy(zero_copy_only=False).astype(float)
        present = ~np.isnan(v)
        values, days = v[present], d[present]
        alive = (d - tp >= d[0]) & present.any()
        stop = np.searchsorted(days, d - tp, "right")
        columns = {}
        for length, of in names.items():
            start = np.searchsorted(days, d - (tp + length - 1), "left")
            with np.errstate(all="ignore"):
                stats = _frame_statistics(values, start, stop)
            stats["pct10"], stats["med"], stats["pct90"] = _sliding_percentiles(values, start, stop, (0.1, 0.5, 0.9)).T
            counts = stats.pop("cnt").astype(np.int64)
            for s, name in zip(HISTORY_STATS, of):
                if s == "cnt":
                    columns[name] = pa.array(counts, mask=~alive)
                else:
                    columns[name] = pa.array(stats[s], mask=np.isnan(stats[s]))
        return pa.table({"e": table.column("e"), "day": table.column("day"), "n": table.column("n"), **columns})

    types = daily.schema
    fields = [T.StructField("e", types[entity].dataType), T.StructField("day", types[day].dataType), T.StructField("n", T.LongType())]
    fields += [T.StructField(n, T.LongType() if n.startswith("cnt_") else T.DoubleType()) for n in new]
    days = daily.select(q(entity).alias("e"), q(day).alias("day"), "n", "v", day_number(q(day)).cast("long").alias("d"))
    table = spread(days.filter("day is not null"), "e").groupBy("e").applyInArrow(describe, T.StructType(fields))
    table = table.withColumnsRenamed({"e": entity, "day": day, "n": "__n"})
    return lookup_join(df, table, [entity, day], weight="__n").drop("__n"), new


FLAG_MONTHS = (1, 2, 3, 6, 12)
FLAG_STATS = ("cnt", "mean", "med", "hmean", "std", "skew", "kurt", "pct10", "pct90")


def flag_history(
    df: DataFrame, entity: str, day: str, value: str, flag: str, mask_test: bool = False, in_memory: int = 2_000_000
) -> tuple[DataFrame, list[str]]:
    """Nine statistics of the entity's rows with the same flag in the r whole months before the row's month.

    Rows are reduced to one row of power sums per (entity, flag, month) before any window runs; quantiles
    come from value counts. A null flag matches nothing.
    """
    v = q(value).cast("double")
    if mask_test:
        v = F.when(q(TRAIN) == 1, v)
    work = df.withColumns({"__v": v, "__m": month_number(q(day))})
    known = work.filter(q(flag).isNotNull() & q(entity).isNotNull())
    # Power sums are taken about the global mean, which keeps the differences small.
    center = known.agg(F.avg("__v")).first()[0] or 0.0
    d = F.col("__v") - F.lit(center)
    keys = [entity, flag, "__m"]
    months = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        F.count("__v").alias("c"),
        *[F.coalesce(F.sum(F.pow(d, F.lit(float(p)))), F.lit(0.0)).alias(f"p{p}") for p in (1, 2, 3, 4)],
        F.sum(F.lit(1.0) / F.when(F.col("__v") == 0, F.lit(0.1)).otherwise(F.col("__v"))).alias("inv"),
        F.min("__v").alias("lo"),
        F.max("__v").alias("hi"),
    )
    raw: dict[str, Column] = {}
    for r in FLAG_MONTHS:
        w = Window.partitionBy(entity, flag).orderBy("__m").rangeBetween(-r, -1)
        raw |= {f"{x}_{r}": F.sum(x).over(w) for x in ("c", "__n", "p1", "p2", "p3", "p4", "inv")}
        raw |= {f"lo_{r}": F.min("lo").over(w), f"hi_{r}": F.max("hi").over(w)}
    months = months.select(*keys, "__n", *[c.alias(n) for n, c in raw.items()])
    stats: dict[str, Column] = {}
    for r in FLAG_MONTHS:
        c, rows = F.col(f"c_{r}"), F.col(f"__n_{r}")
        n = F.nullif(c, F.lit(0).cast("long")).cast("double")
        m1, m2, m3, m4 = [F.col(f"p{p}_{r}") / n for p in (1, 2, 3, 4)]
        var = F.greatest(m2 - m1 * m1, F.lit(0.0))
        varied = F.col(f"hi_{r}") > F.col(f"lo_{r}")
        third = m3 - 3 * m1 * m2 + 2 * m1 * m1 * m1
        fourth = m4 - 4 * m1 * m3 + 6 * m1 * m1 * m2 - 3 * m1 * m1 * m1 * m1
        safe = F.nullif(var, F.lit(0.0))
        skew, kurt = skew_kurt(n, third / (safe * F.sqrt(safe)), fourth / (safe * safe) - 3)
        name = lambda s, r=r: f"{flag}_{s}_{r}month(s)"
        stats |= {
            name("cnt"): F.when(rows > 0, c),
            name("mean"): m1 + F.lit(center),
            name("hmean"): n / F.col(f"inv_{r}"),
            name("std"): F.when(n > 1, F.when(varied, F.sqrt(var * n / F.nullif(n - 1, F.lit(0.0)))).otherwise(F.lit(0.0))),
            name("skew"): F.when(varied, skew).when(n >= 3, F.lit(0.0)),
            name("kurt"): F.when(varied, kurt).when(n >= 4, F.lit(0.0)),
        }
    table = months.select(*keys, "__n", *[c.alias(n) for n, c in stats.items()])
    table = table.join(_flag_quantiles(known, keys, flag, in_memory), keys, "left")
    names = [f"{flag}_{s}_{r}month(s)" for s in FLAG_STATS for r in FLAG_MONTHS]
    out = lookup_join(work, table, keys, weight="__n", null_safe=False)
    return out.select(*[q(c) for c in df.columns], *[q(c) for c in names]), names


def _flag_quantiles(known: DataFrame, keys: Sequence[str], flag: str, in_memory: int) -> DataFrame:
    """Exact 10 %, 50 % and 90 % points of the last r months, one row per (entity, flag, month)."""
    entity, _, month = keys
    probs = {"pct10": 0.1, "med": 0.5, "pct90": 0.9}
    present = known.filter(F.col("__v").isNotNull())
    counts = materialize(present.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__cnt")))
    largest = counts.groupBy(entity, flag).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    reach = max(FLAG_MONTHS)
    ahead = F.explode(F.sequence(F.lit(1), F.lit(reach))).alias("__ahead")
    if largest <= in_memory:
        spread = counts.select(*keys, "__v", "__cnt", ahead).withColumn("__m", F.col("__m") + F.col("__ahead"))
        weights = {r: F.when(F.col("__ahead") <= r, F.col("__cnt")).otherwise(F.lit(0)) for r in FLAG_MONTHS}
        arrays = [
            F.percentile("__v", F.array(*[F.lit(p) for p in probs.values()]), weights[r]).alias(f"__q{r}")
            for r in FLAG_MONTHS
        ]
        picked = spread.groupBy(*keys).agg(*arrays)
        return picked.select(
            *keys,
            *[F.get(F.col(f"__q{r}"), F.lit(i)).alias(f"{flag}_{s}_{r}month(s)") for r in FLAG_MONTHS for i, s in enumerate(probs)],
        )
    ranges = F.explode(F.array(*[F.lit(r) for r in FLAG_MONTHS])).alias("__r")
    rows = present.select(*keys, "__v", ranges).select("*", F.explode(F.sequence(F.lit(1), F.col("__r"))).alias("__ahead"))
    rows = rows.withColumn("__m", F.col("__m") + F.col("__ahead")).drop("__ahead")
    long = grouped_quantiles(rows, [*keys, "__r"], ["__v"], list(probs.values()), largest * reach, in_memory)
    return long.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("__r") == r, F.col(f"`__v@{p}`"))).alias(f"{flag}_{s}_{r}month(s)")
            for r in FLAG_MONTHS
            for s, p in probs.items()
        ]
    )


def day_grid(daily: DataFrame, entity: str) -> DataFrame:
    """Every day between an entity's first and last day, with its value or null."""
    spans = daily.groupBy(entity).agg(F.min("__d").alias("__a"), F.max("__d").alias("__b"))
    grid = spans.select(entity, F.explode(F.sequence("__a", "__b")).alias("__d"))
    return grid.join(daily.select(entity, "__d", "__v"), [entity, "__d"], "left")


def weekday_interpolate(daily: DataFrame, entity: str) -> DataFrame:
    """Per entity and weekday: gaps are interpolated by position, a leading gap takes the next value, a trailing one stays."""
    grid = day_grid(daily, entity).withColumn("__w", F.pmod(F.col("__d") + 3, F.lit(7)))  # day 0 was a Thursday
    by = Window.partitionBy(entity, "__w").orderBy("__d")
    back, ahead = by.rowsBetween(Window.unboundedPreceding, 0), by.rowsBetween(0, Window.unboundedFollowing)
    here = F.when(F.col("__v").isNotNull(), F.col("__d"))
    filled = grid.withColumns(
        {
            "__pv": F.last("__v", True).over(back),
            "__pd": F.last(here, True).over(back),
            "__nv": F.first("__v", True).over(ahead),
            "__nd": F.first(here, True).over(ahead),
        }
    )
    share = (F.col("__d") - F.col("__pd")) / F.nullif(F.col("__nd") - F.col("__pd"), F.lit(0))
    between = F.col("__pv") + (F.col("__nv") - F.col("__pv")) * share
    value = F.coalesce(F.col("__v"), F.when(F.col("__pv").isNull(), F.col("__nv")).otherwise(between))
    return filled.select(
        entity, F.date_add(F.lit("1970-01-01").cast("date"), F.col("__d")).alias("day"), F.col("__w").alias("weekday"), value.alias("value")
    )


def null_state_running_count(
    df: DataFrame, columns: Sequence[str], order: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """In the given order: the number of rows so far whose null state equals this row's, per column."""
    conditions = {}
    for i, c in enumerate(columns):
        conditions[f"__null{i}"] = q(c).isNull()
        conditions[f"__full{i}"] = q(c).isNotNull()
    counted = running_counts(df, [q(o) for o in order], conditions)
    new = {
        f"{c}_nan_cond_accu": F.when(q(c).isNull(), F.col(f"__null{i}")).otherwise(F.col(f"__full{i}"))
        for i, c in enumerate(columns)
    }
    return counted.withColumns(new).drop(*conditions), list(new)


# ---- decayed history: an iterative shift and fill over one entity's day grid ----

# Fixed values: (window length, days back, with standard deviation).
DECAY_GRID = (
    (1, tuple(7 * i for i in range(1, 8)), False),
    (7, tuple(7 * i + 1 for i in range(8)), True),
    (30, tuple(30 * i + 1 for i in range(4)), True),
    (60, tuple(60 * i + 1 for i in range(2)), True),
    (90, (1,), True),
)
DECAY = 0.95


def _rolling(values: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    window = pd.Series(values).rolling(length, min_periods=1)
    return window.mean().to_numpy(), window.std().to_numpy(), window.count().to_numpy()


def _moved(x: np.ndarray, by: int) -> np.ndarray:
    out = np.full(len(x), np.nan)
    if by < len(x):
        out[by:] = x[: len(x) - by]
    return out


def _hold_fill(x: np.ndarray) -> np.ndarray:
    """Linear inside, end values held outside."""
    known = np.flatnonzero(~np.isnan(x))
    return x if len(known) == 0 else np.interp(np.arange(len(x)), known, x[known])


def _decay_fill(x: np.ndarray) -> np.ndarray:
    """Geometric decay away from the known range; linear times the decay in its gaps."""
    known = np.flatnonzero(~np.isnan(x))
    at = np.arange(len(x))
    out = np.interp(at, known, x[known])
    inner = np.isnan(x) & (at > known[0]) & (at < known[-1])
    out[inner] *= DECAY
    before, after = at < known[0], at > known[-1]
    out[before] = x[known[0]] * DECAY ** (known[0] - at[before])
    out[after] = x[known[-1]] * DECAY ** (at[after] - known[-1])
    return out


def _steps(total: int, size: int) -> list[int]:
    whole = (total - 1) // size
    return [size] * whole + [total - whole * size]


def decay_columns(prefix: str = "store_visitors") -> list[str]:
    names = []
    for length, points, with_std in DECAY_GRID:
        for tp in points:
            span = f"{tp}-{tp + length - 1}_in_past"
            names += [f"{prefix}_mean_{span}", f"{prefix}_weighted_mean_{span}"]
            if with_std:
                names += [f"{prefix}_std_{span}", f"{prefix}_weighted_std_{span}"]
    return names


def decayed_features(values: np.ndarray) -> np.ndarray:
    """All decayed history columns of one gap-filled daily series, in the order of :func:`decay_columns`."""
    out: list[np.ndarray] = []
    for length, points, with_std in DECAY_GRID:
        mean, std, count = _rolling(values, length)
        weight = np.where(count > 0, count, np.nan) / length
        known = np.flatnonzero(~np.isnan(weight))
        reach = len(values) - int(known[0]) - 2 if len(known) else 0
        for tp in points:
            if reach <= 0:  # too few days after the first value to shift at all
                out += [np.full(len(values), np.nan)] * (4 if with_std else 2)
                continue
            m, w, s = mean, weight, std
            for step in _steps(tp, reach):
                m = _hold_fill(_moved(m, step))
                w = _decay_fill(_moved(w, step))
                s = _hold_fill(_moved(s, step))
            out += [m, m * w]
            if with_std:
                out += [s, s * w]
    return np.column_stack(out)


def history_decayed(
    df: DataFrame, entity: str, day: str, value: str, order: Sequence[str], use_test_target: bool = False
) -> tuple[DataFrame, list[str]]:
    """Rolling statistics shifted into the past with decaying weights; remaining nulls take the column mean.

    The fill is iterative over one entity's days, so it runs per entity on the reduced daily series.
    """
    names = decay_columns()
    daily = daily_series(df, entity, day, value, order, use_test_target)
    kind = dict(daily.dtypes)[entity]
    schema = T.StructType(
        [T.StructField("__entity", T._parse_datatype_string(kind)), T.StructField("__d", T.IntegerType())]
        + [T.StructField("__f", T.ArrayType(T.DoubleType()))]
    )

    def one_entity(pdf: pd.DataFrame) -> pd.DataFrame:
        days = pdf["__d"].to_numpy()
        values = pdf["__v"].to_numpy(dtype=float)
        if np.isnan(values).all():
            return pd.DataFrame({"__entity": pdf["__entity"], "__d": days, "__f": [None] * len(days)})
        grid = np.full(days.max() - days.min() + 1, np.nan)
        grid[days - days.min()] = values
        feats = decayed_features(grid)[days - days.min()]
        cells = [[None if np.isnan(x) else float(x) for x in row] for row in feats]
        return pd.DataFrame({"__entity": pdf["__entity"], "__d": days, "__f": cells})

    slim = daily.select(q(entity).alias("__entity"), "__d", "__v", "__n")
    feats = slim.groupBy("__entity").applyInPandas(one_entity, schema)
    table = slim.join(feats, ["__entity", "__d"]).select(
        "__entity", "__d", "__n", *[F.get("__f", F.lit(i)).alias(n) for i, n in enumerate(names)]
    )
    out = lookup_join(df.withColumn("__day", day_number(q(day))), table, {entity: "__entity", "__day": "__d"}, weight="__n")
    return mean_impute(out.drop("__n", "__day"), names), names


# ---- ridge trend ----

TREND_FEATURES = (
    "dom", "doy", "doq", "dot", "dow", "woq", "wom", "moq", "year", "quarter", "month", "week", "dayofwork", "dayofholiday",
)


def ridge_trend(
    df: DataFrame,
    entity: str,
    target: str,
    key: str,
    features: Sequence[str] = TREND_FEATURES,
    alpha: float = 1.0,
    min_rows: int = 150,
    k: int = 5,
    name: str = "ridge_trend",
) -> tuple[DataFrame, list[str]]:
    """Per entity: ridge regression on calendar features, out of fold for train rows and full fit for test rows.

    One aggregate gives the sums of x, y, xx' and xy per (entity, fold); the matrix of "all other folds" is the
    total minus the fold. Only these small matrices reach Python. Entities with fewer train rows give null.
    """
    assert_no_nulls(df, features)
    p = len(features)
    x = [q(f).cast("double") for f in features]
    fold = hash_fold(q(key), k)
    # Centre on the global means: the solution is the same and the sums stay small.
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)], F.avg(q(target).cast("double")).alias("my")).first()
    z = [c - F.lit(row[f"m{i}"]) for i, c in enumerate(x)]
    shift = row["my"] or 0.0
    y = q(target).cast("double") - F.lit(shift)
    work = df.withColumns({"__fold": fold, "__x": F.array(*z), "__y": y})
    train = work.filter((q(TRAIN) == 1) & F.col("__y").isNotNull())
    zc = [F.col("__x")[i] for i in range(p)]
    sums = train.groupBy(entity, "__fold").agg(
        F.array(
            F.count(F.lit(1)).cast("double"),
            F.sum("__y"),
            *[F.sum(a) for a in zc],
            *[F.sum(a * F.col("__y")) for a in zc],
            *[F.sum(zc[i] * zc[j]) for i in range(p) for j in range(i, p)],
        ).alias("__sums")
    )
    folded = sums.groupBy(entity).agg(F.collect_list(F.struct("__fold", "__sums")).alias("parts"))  # k entries at most
    kind = dict(df.dtypes)[entity]
    upper = np.triu_indices(p)

    def solve(total: np.ndarray) -> list[float] | None:
        n = total[0]
        if n < 1:
            return None
        sx, sxy = total[2 : 2 + p], total[2 + p : 2 + 2 * p]
        xx = np.zeros((p, p))
        xx[upper] = total[2 + 2 * p :]
        xx = xx + xx.T - np.diag(np.diag(xx))
        mean_x, mean_y = sx / n, total[1] / n
        coef = np.linalg.solve(xx - n * np.outer(mean_x, mean_x) + alpha * np.eye(p), sxy - n * mean_x * mean_y)
        return [float(mean_y - coef @ mean_x), *coef.tolist()]

    def fits(batches):
        for pdf in batches:
            rows = []
            for key_value, parts in zip(pdf["__entity"], pdf["parts"]):
                per = {int(e["__fold"]): np.asarray(e["__sums"], dtype=float) for e in parts}
                total = sum(per.values())
                if total[0] >= min_rows:
                    rows.append(
                        {
                            "__entity": key_value,
                            "__w": int(total[0]),
                            "full": solve(total),
                            **{f"f{f}": solve(total - per[f]) if f in per else solve(total) for f in range(k)},
                        }
                    )
            yield pd.DataFrame(rows, columns=["__entity", "__w", "full", *[f"f{f}" for f in range(k)]])

    schema = f"__entity {kind}, __w long, full array<double>, " + ", ".join(f"f{f} array<double>" for f in range(k))
    table = folded.select(q(entity).alias("__entity"), "parts").mapInPandas(fits, schema)
    joined = lookup_join(work, table, {entity: "__entity"}, weight="__w", null_safe=False)
    coef = F.col("full")
    for f in range(k):
        coef = F.when((q(TRAIN) == 1) & (F.col("__fold") == f), F.col(f"f{f}")).otherwise(coef)
    joined = joined.withColumn("__c", coef)
    dot = F.col("__c")[0] + F.lit(shift)
    for i in range(p):
        dot = dot + F.col("__c")[i + 1] * F.col("__x")[i]
    out = joined.withColumn(name, F.when(F.col("__c").isNotNull(), dot))
    return out.select(*[q(c) for c in df.columns], q(name)), [name]
