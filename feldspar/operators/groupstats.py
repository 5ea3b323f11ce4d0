"""Group statistics, ratios, histograms and correlation tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feldspar.functions.numeric import divide
from feldspar.operators.missing import nan_inf_impute
from feldspar.operators.profile import TRAIN, q
from feldspar.plans.lookup import lookup_join
from feldspar.plans.ordering import running_counts
from feldspar.plans.percolumn import tables_by_column
from feldspar.plans.storage import materialize

STATS = ("count", "mean", "std", "median", "max", "min")


def value_counts(df: DataFrame, groups: Sequence[Column], values: Sequence[Column]) -> DataFrame:
    """(s, k, o, v, c): how often value column o has the value v in the group k of group column s; one scan for all pairs."""
    keys = F.array(*[F.struct(F.lit(i).alias("s"), g.alias("k")) for i, g in enumerate(groups)])
    cells = F.array(*[F.struct(F.lit(i).alias("o"), v.alias("v")) for i, v in enumerate(values)])
    rows = df.select(keys.alias("__keys"), cells.alias("__cells"))
    rows = rows.select("__cells", F.explode("__keys").alias("g")).select("g.s", "g.k", F.explode("__cells").alias("x")).select("s", "k", "x.o", "x.v")
    return rows.groupBy("s", "k", "o", "v").agg(F.count(F.lit(1)).alias("c"))


def _described(counts: DataFrame) -> DataFrame:
    """(s, k, o, n, rows, mean, std, median, max, min) from value counts. Only distinct values are sorted, across the cluster; no group is held whole."""
    of = ["s", "k", "o"]
    placed = running_counts(counts, [F.col(c) for c in (*of, "v")], {"upto": F.col("c")})
    known = F.when(F.col("v").isNotNull(), F.col("c"))
    first = F.min(F.when(F.col("v").isNotNull(), F.col("upto") - F.col("c")))
    ends = placed.groupBy(*of).agg(
        F.sum("c").alias("rows"), F.coalesce(F.sum(known), F.lit(0)).alias("n"), first.alias("first"), (F.sum(F.col("v") * known) / F.sum(known)).alias("mean"),
        F.max("v").alias("max"), F.min("v").alias("min"), F.count(F.lit(1)).alias("__w"),
    )
    ends = materialize(ends)
    joined = lookup_join(placed.filter("v is not null"), ends, of, weight="__w", stored=True)
    start, gap = F.col("upto") - F.col("c") - F.col("first"), F.col("v") - F.col("mean")
    holds = lambda at: F.max(F.when((start <= at) & (at < start + F.col("c")), F.col("v")))
    low, high = F.floor((F.col("n") - 1) / 2), F.ceil((F.col("n") - 1) / 2)
    spread = joined.groupBy(*of).agg(F.sum(F.col("c") * gap * gap).alias("square"), ((holds(low) + holds(high)) / 2).alias("median"))
    std = F.when(F.col("n") > 1, F.sqrt(F.col("square") / (F.col("n") - 1)))
    return ends.join(spread, of, "left").withColumn("std", std).drop("square", "first", "__w")  # one row per group on both sides


def group_stats(df: DataFrame, observe: Sequence[str], groups: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Count, mean, std, median, max and min of each observed column per group, attached to every row.

    Train and test rows count together; a null group is the group ``nan``; remaining nulls become 0. The rows are read
    once for counts per (group, value), from which everything follows.
    """
    names = [f"__g{i}" for i in range(len(groups))]
    keyed = df.withColumns({n: F.coalesce(q(g).cast("string"), F.lit("nan")) for n, g in zip(names, groups)})
    per_pair = _described(value_counts(keyed, [F.col(n) for n in names], [q(o).cast("double") for o in observe]))
    cells = [F.max(F.when(F.col("o") == i, F.col("rows" if s == "count" else s))).alias(f"{i}@{s}") for i in range(len(observe)) for s in STATS]
    tables = materialize(per_pair.groupBy("s", "k").agg(F.max("rows").alias("__n"), *cells))
    new: list[str] = []
    for j, (n, g) in enumerate(zip(names, groups)):
        made = {f"{o}_{s}_on_{g}": F.coalesce(q(f"{i}@{s}"), F.lit(0)) for i, o in enumerate(observe) if o != g for s in STATS}
        stats = tables.filter(F.col("s") == j).select(F.col("k").alias(n), "__n", *[c.alias(name) for name, c in made.items()])
        keyed = lookup_join(keyed, stats, [n], weight="__n", stored=True).drop("__n")
        new += list(made)
    return keyed.drop(*names), new


def group_stats_ratio(
    df: DataFrame, observe: Sequence[str], groups: Sequence[str], replace: bool = True
) -> tuple[DataFrame, list[str]]:
    """Ratios of a value to its group statistics, then null and infinity handling."""
    new, ratios, ranges, gone = [], {}, {}, []
    for g in groups:
        for o in observe:
            stat = {s: f"{o}_{s}_on_{g}" for s in STATS if s != "count"}
            if any(c not in df.columns for c in stat.values()):
                continue
            x = q(o).cast("double")
            spread = q(stat["max"]) - q(stat["min"])
            ranges[f"{o}_range_on_{g}"] = spread
            made = {
                f"{o}_meanrat_on_{g}": divide(x, q(stat["mean"])),
                f"{o}_stdrat_on_{g}": divide(x - q(stat["mean"]), q(stat["std"])),
                f"{o}_medrat_on_{g}": divide(x - q(stat["median"]), spread),
                f"{o}_minrat_on_{g}": divide(x - q(stat["min"]), spread),
            }
            ratios.update(made)
            new += list(made)
            gone += list(stat.values())
    df = df.withColumns({**ratios, **ranges})
    if replace:
        df = df.drop(*gone)
    df, flags = nan_inf_impute(df, new)
    return df, new + flags


def occurrence_ratio(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Share of all rows that hold the row's value; null is a value."""
    tables = tables_by_column(df, columns, [])
    for c in columns:
        total = tables[c].agg(F.sum("__n")).first()[0] or 1
        shares = tables[c].withColumn(f"{c}_occur_r", F.col("__n") / F.lit(float(total)))
        df = lookup_join(df, shares, [c], weight="__n", stored=True).drop("__n")
    return df, [f"{c}_occur_r" for c in columns]


def null_ratio_feature(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The train null ratio r on null rows, 1-r on the others."""
    train = q(TRAIN) == 1
    row = df.agg(*[F.avg(F.when(train, q(c).isNull().cast("int"))).alias(f"r{i}") for i, c in enumerate(columns)]).first()
    new = {
        f"{c}_nan_r": F.when(q(c).isNull(), F.lit(row[f"r{i}"])).otherwise(F.lit(1.0 - (row[f"r{i}"] or 0.0)))
        for i, c in enumerate(columns)
    }
    return df.withColumns(new), list(new)


def holiday_week_count(
    df: DataFrame, flag: str, year: str = "year", week: str = "week", dow: str = "dow"
) -> tuple[DataFrame, list[str]]:
    """Number of flagged weekdays in the row's week, and in the previous and next week present."""
    days = df.groupBy(year, week, dow).agg(
        F.when(F.coalesce(F.sum(q(flag)), F.lit(0)) != 0, 1).otherwise(0).alias("__hit"), F.count(F.lit(1)).alias("__rows")
    )
    weeks = days.groupBy(year, week).agg(
        F.sum("__hit").alias("holiday_cnt_currweek"), F.sum("__rows").alias("__n")
    )
    weeks = lag_lead(weeks, "holiday_cnt_currweek", [year, week], "holiday_cnt_lastweek", "holiday_cnt_nextweek")
    out = lookup_join(df, weeks, [year, week], weight="__n").drop("__n")
    return out, ["holiday_cnt_currweek", "holiday_cnt_lastweek", "holiday_cnt_nextweek"]


def lag_lead(table: DataFrame, value: str, order: Sequence[str], last: str, following: str) -> DataFrame:
    """Previous and next row's value in an ordered week table (a few thousand rows in a century)."""
    w = Window.orderBy(*order)
    return table.withColumns({last: F.lag(q(value)).over(w), following: F.lead(q(value)).over(w)})


def class_histogram(df: DataFrame, target: str, column: str) -> DataFrame:
    """Per class: share of each value among the class's non-null values."""
    counts = df.filter(q(column).isNotNull()).groupBy(target, column).agg(F.count(F.lit(1)).alias("n"))
    totals = df.groupBy(target).agg(F.count(q(column)).alias("class_n"))
    out = lookup_join(counts, totals, [target], weight="class_n")
    return out.withColumn("share", F.col("n") / F.col("class_n"))


def label_overlap(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Per ordered label pair: share of rows with ``label`` that also have ``other``; (label, null): label alone.

    All shares come from one aggregate.
    """
    on = {l: F.coalesce(q(l) == 1, F.lit(False)) for l in labels}
    aggs = []
    for i, a in enumerate(labels):
        aggs.append(F.count_if(on[a]).alias(f"n{i}"))
        alone = on[a]
        for j, b in enumerate(labels):
            if i != j:
                aggs.append(F.count_if(on[a] & on[b]).alias(f"n{i}_{j}"))
                alone = alone & ~on[b]
        aggs.append(F.count_if(alone).alias(f"only{i}"))
    cells = []
    for i, a in enumerate(labels):
        n = F.nullif(F.col(f"n{i}"), F.lit(0).cast("long"))
        for j, b in enumerate(labels):
            if i != j:
                cells.append(F.struct(F.lit(a).alias("label"), F.lit(b).alias("other"), (F.col(f"n{i}_{j}") / n).alias("ratio")))
        cells.append(F.struct(F.lit(a).alias("label"), F.lit(None).cast("string").alias("other"), (F.col(f"only{i}") / n).alias("ratio")))
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long (a, b, corr), pairwise complete, for all ordered pairs; one aggregate over the upper triangle."""
    pairs = list(combinations(range(len(columns)), 2))
    x = [q(c).cast("double") for c in columns]
    row = df.agg(
        *[F.corr(x[i], x[j]).alias(f"r{i}_{j}") for i, j in pairs],
        *[F.when(F.stddev_pop(c) > 0, F.lit(1.0)).alias(f"r{i}_{i}") for i, c in enumerate(x)],
    )
    cells = [
        F.struct(F.lit(columns[i]).alias("a"), F.lit(columns[j]).alias("b"), q(f"r{min(i, j)}_{max(i, j)}").alias("corr"))
        for i in range(len(columns))
        for j in range(len(columns))
    ]
    return row.select(F.inline(F.array(*cells)))


def rank_by_correlation(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(column, abs_corr) against the target, strongest first."""
    y = q(target).cast("double")
    row = df.agg(*[F.abs(F.corr(q(c).cast("double"), y)).alias(f"r{i}") for i, c in enumerate(columns)])
    cells = [F.struct(F.lit(c).alias("column"), q(f"r{i}").alias("abs_corr")) for i, c in enumerate(columns)]
    return row.select(F.inline(F.array(*cells))).orderBy(F.desc("abs_corr"), "column")


def _bin(x: Column, low: float, high: float, bins: int) -> Column:
    """0-based equal-width bin; the maximum belongs to the last one."""
    if low is None or high is None or high == low:
        return F.when(x.isNotNull(), F.lit(0).cast("long"))
    at = F.floor((x.cast("double") - F.lit(low)) / F.lit(high - low) * F.lit(float(bins)))
    return F.when(x.isNotNull(), F.least(at, F.lit(bins - 1).cast("long")))


def _limits(df: DataFrame, columns: Sequence[str]) -> list[tuple[float, float]]:
    row = df.agg(
        *[F.min(q(c).cast("double")).alias(f"a{i}") for i, c in enumerate(columns)],
        *[F.max(q(c).cast("double")).alias(f"b{i}") for i, c in enumerate(columns)],
    ).first()
    return [(row[f"a{i}"], row[f"b{i}"]) for i in range(len(columns))]


def binned_histogram(df: DataFrame, target: str, column: str, bins: int = 100) -> DataFrame:
    (low, high), = _limits(df, [column])
    present = df.filter(q(column).isNotNull())
    return present.groupBy(target, _bin(q(column), low, high, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def group_density(df: DataFrame, group: str, column: str, bins: int = 100) -> DataFrame:
    """Per group and bin: histogram density (share of the group / bin width); the group's size comes along."""
    (low, high), = _limits(df, [column])
    width = ((high - low) / bins) if low is not None and high > low else 1.0
    present = df.filter(q(column).isNotNull() & q(group).isNotNull())
    counts = present.groupBy(group, _bin(q(column), low, high, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy(group).agg(F.sum("n").alias("group_n"))
    out = lookup_join(counts, sizes, [group], weight="group_n")
    return out.withColumn("density", F.col("n") / F.col("group_n") / F.lit(width))


def pair_scatter_grid(df: DataFrame, target: str, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """2-D binned counts per class for every column pair: rows are expanded over the pairs, then counted once."""
    limits = dict(zip(columns, _limits(df, columns)))
    cells = [
        F.struct(
            F.lit(a).alias("x"),
            F.lit(b).alias("y"),
            _bin(q(a), *limits[a], bins).alias("bx"),
            _bin(q(b), *limits[b], bins).alias("by"),
        )
        for a, b in combinations(columns, 2)
    ]
    long = df.select(q(target), F.inline(F.array(*cells)))
    return long.filter("bx is not null and by is not null").groupBy(target, "x", "y", "bx", "by").agg(F.count(F.lit(1)).alias("n"))
