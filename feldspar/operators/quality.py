"""Feature-quality statistics from group sums and contingency tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspar.operators.profile import q
from feldspar.plans.lookup import lookup_join
from feldspar.plans.percolumn import tables_by_column
from feldspar.plans.storage import materialize


def _unpivot(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column"), q(c).cast("double").alias("x")) for c in columns])
    return df.select(q(group).alias("g"), F.inline(cells))


def f_test(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """(column, f): one-way ANOVA of each column over the groups; all columns in one unpivoted aggregate.

    The total mean includes rows without a group; groups do not. Null values are left out.
    """
    long = _unpivot(df, group, columns).filter("x is not null")
    groups = long.groupBy("column", "g").agg(F.count("x").alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v"))
    totals = groups.groupBy("column").agg((F.sum(F.col("m") * F.col("n")) / F.sum("n")).alias("mean"), F.sum("n").alias("rows"))
    known = lookup_join(groups.filter("g is not null"), totals, ["column"], weight="rows")
    gap = F.col("m") - F.col("mean")
    parts = known.groupBy("column").agg(
        F.sum(gap * gap * F.col("n")).alias("between"),
        F.sum(F.col("v") * F.col("n")).alias("within"),
        F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") - 1).alias("dfw"),
    )
    zero = F.lit(0).cast("long")
    ms_between = F.col("between") / F.nullif(F.col("k") - 1, zero)
    ms_within = F.col("within") / F.nullif(F.col("dfw"), zero)
    return parts.select("column", (ms_between / F.nullif(ms_within, F.lit(0.0))).alias("f"))


def select_by_f(df: DataFrame, group: str, columns: Sequence[str], limit: float) -> DataFrame:
    """Columns whose F exceeds the limit."""
    return f_test(df, group, columns).filter(F.col("f") > limit)


def z_test(df: DataFrame, group: str, columns: Sequence[str], min_size: int = 20) -> DataFrame:
    """(column, z): each category against all other rows, weighted by category size.

    A category's rest is the total minus the category, from sums about the column mean. Null is a category.
    Both sides need ``min_size`` rows.
    """
    means = df.agg(*[F.avg(q(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    centred = df.select(q(group), *[(q(c).cast("double") - F.lit(means[f"m{i}"] or 0.0)).alias(f"c{i}") for i, c in enumerate(columns)])
    long = _unpivot(centred, group, [f"c{i}" for i in range(len(columns))])
    sums = [
        F.count(F.lit(1)).alias("n"),
        F.count("x").alias("k"),
        F.coalesce(F.sum("x"), F.lit(0.0)).alias("s"),
        F.coalesce(F.sum(F.col("x") * F.col("x")), F.lit(0.0)).alias("ss"),
    ]
    groups = long.groupBy("column", "g").agg(*sums)
    totals = groups.groupBy("column").agg(*[F.sum(c).alias(f"t_{c}") for c in ("n", "k", "s", "ss")])
    both = lookup_join(groups, totals, ["column"], weight="t_n")

    def side(n, k, s, ss):
        mean = s / F.nullif(k, F.lit(0).cast("long"))
        var = (ss - s * mean) / F.nullif(k - 1, F.lit(0).cast("long"))
        return mean, F.greatest(var, F.lit(0.0)) / n

    rest = [F.col(f"t_{c}") - F.col(c) for c in ("n", "k", "s", "ss")]
    big = both.filter((F.col("n") >= min_size) & (rest[0] >= min_size))
    m1, e1 = side(F.col("n"), F.col("k"), F.col("s"), F.col("ss"))
    m2, e2 = side(*rest)
    z = F.abs(m1 - m2) / F.nullif(F.sqrt(e1 + e2), F.lit(0.0))
    scored = big.groupBy("column").agg((F.sum(z * F.col("n")) / F.sum("n")).alias("z"))
    names = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(f"c{i}"), F.lit(c))])
    return scored.select(names[F.col("column")].alias("column"), "z")


def group_measurement(df: DataFrame, columns: Sequence[str], group: str, measure=f_test) -> DataFrame:
    """Apply a measure to many columns and rank descending: (column, score)."""
    scores = measure(df, group, columns)
    return scores.withColumnRenamed(scores.columns[1], "score").orderBy(F.desc_nulls_last("score"), "column")


def histogram_cosine(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(column, similarity): cosine of the value histograms of class 0 and class 1."""
    tables = tables_by_column(df, columns, [F.count_if(q(target) == 0).alias("n0"), F.count_if(q(target) == 1).alias("n1")])
    out = None
    for c in columns:
        t = tables[c].filter(q(c).isNotNull())
        a, b = F.col("n0").cast("double"), F.col("n1").cast("double")
        norm = F.sqrt(F.sum(a * a)) * F.sqrt(F.sum(b * b))
        row = t.agg((F.sum(a * b) / F.nullif(norm, F.lit(0.0))).alias("similarity")).select(F.lit(c).alias("column"), "similarity")
        out = row if out is None else out.unionByName(row)
    return out


# Coefficients of the Stirling series of ln(n!).
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680)


def _log_factorial(n: np.ndarray) -> np.ndarray:
    n = np.asarray(n, dtype=float)
    small = np.array([math.lgamma(i + 1.0) for i in range(32)])
    big = np.maximum(n, 32.0)
    series = sum(c / big ** (2 * i + 1) for i, c in enumerate(_STIRLING))
    stirling = big * np.log(big) - big + 0.5 * np.log(2 * math.pi * big) + series
    return np.where(n < 32, small[np.minimum(n, 31).astype(int)], stirling)


def _expected_cell(a: int, b: int, n: int) -> float:
    """Expected mutual-information term of one contingency cell with marginals a, b under random labels.

    By Bernstein's inequality for the hypergeometric distribution, P(|k - mean| >= t) <= 2 exp(-t^2 / (2 (mean + t/3))).
    The terms left out have t >= 230 + sqrt(230^2 + 1380 mean), so that their weight is at most 2 exp(-690) < 1e-299.
    """
    low, high = max(1, a + b - n), min(a, b)
    mean = a * b / n
    spread = 230 + math.sqrt(230**2 + 1380 * mean)
    low, high = max(low, int(mean - spread)), min(high, int(mean + spread) + 1)
    if high < low:
        return 0.0
    k = np.arange(low, high + 1, dtype=float)
    log_p = (
        _log_factorial(np.array([a, b, n - a, n - b])).sum()
        - _log_factorial(np.array([n]))[0]
        - _log_factorial(k)
        - _log_factorial(a - k)
        - _log_factorial(b - k)
        - _log_factorial(n - a - b + k)
    )
    return float(np.sum(k / n * np.log(n * k / (a * b)) * np.exp(log_p)))


def adjusted_mutual_info(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(column, ami) = (MI - E[MI]) / (max(H1, H2) - E[MI]).

    One pass counts the cells (column, value, class) of all columns in long form; everything else comes from these
    counts. E[MI] needs only the marginals: sizes that occur often are counted first (equal sizes contribute equally),
    and each pair of a value size and a class size is evaluated in Arrow batches across the cluster.
    """
    named = [F.struct(F.lit(c).alias("column"), q(c).cast("string").alias("v")) for c in columns]
    cells = df.select(q(target).cast("string").alias("t"), F.explode(F.array(*named)).alias("x"))
    cells = materialize(cells.groupBy("x.column", "x.v", "t").agg(F.count(F.lit(1)).cast("double").alias("k")))
    total = cells.filter(F.col("column") == columns[0]).agg(F.sum("k")).first()[0] or 0.0
    n = F.lit(float(total))
    values = cells.groupBy("column", "v").agg(F.sum("k").alias("a"))
    classes = cells.filter(F.col("column") == columns[0]).groupBy("t").agg(F.sum("k").alias("b"))
    values, classes = materialize(values), materialize(classes)
    told = cells.join(values.withColumnsRenamed({"column": "c2", "v": "v2"}), (F.col("column") == F.col("c2")) & F.col("v").eqNullSafe(F.col("v2")))
    told = told.join(classes.withColumnRenamed("t", "t2"), F.col("t").eqNullSafe(F.col("t2")))
    mi = told.groupBy("column").agg(F.sum(F.col("k") / n * F.log(n * F.col("k") / (F.col("a") * F.col("b")))).alias("mi"))
    h = values.groupBy("column").agg((-F.sum(F.col("a") / n * F.log(F.col("a") / n))).alias("h"), F.count(F.lit(1)).alias("values"))
    g = classes.agg((-F.sum(F.col("b") / n * F.log(F.col("b") / n))).alias("g"), F.count(F.lit(1)).alias("classes")).first()

    def expected_of(batches):
        for pdf in batches:
            cell = [m * _expected_cell(int(a), int(b), int(total)) for a, b, m in zip(pdf["a"], pdf["b"], pdf["m"])]
            yield pd.DataFrame({"column": pdf["column"], "e": cell})

    sizes = values.groupBy("column", "a").agg(F.count(F.lit(1)).alias("m_a"))
    class_sizes = classes.groupBy("b").agg(F.count(F.lit(1)).alias("m_b")).crossJoin(cells.select("column").distinct())
    pairs = sizes.join(class_sizes, "column").select("column", "a", "b", (F.col("m_a") * F.col("m_b")).alias("m"))
    expected = pairs.mapInPandas(expected_of, "column string, e double").groupBy("column").agg(F.sum("e").alias("e"))
    top = F.greatest(F.col("h"), F.lit(g["g"]))
    trivial = (F.col("values") <= 1) & F.lit(g["classes"] <= 1)  # two constant labellings agree fully
    ami = F.when(trivial, F.lit(1.0)).otherwise((F.col("mi") - F.col("e")) / F.nullif(top - F.col("e"), F.lit(0.0)))
    return mi.join(h, "column").join(expected, "column").select("column", ami.alias("ami"))


def top_mutual_info(df: DataFrame, columns: Sequence[str], target: str, k: int = 20) -> DataFrame:
    return adjusted_mutual_info(df, columns, target).orderBy(F.desc_nulls_last("ami"), "column").limit(k)
