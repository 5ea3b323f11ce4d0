"""Join shapes: lookups with defaults, per-group statistics, membership and contingency."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feldspar.operators.profile import q
from feldspar.plans.lookup import lookup_join


def left_join_lookup(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str, defaults: Mapping[str, object]
) -> DataFrame:
    """Left equi-join with a one-row-per-key table; missing results take the default. Null keys match nothing."""
    out = lookup_join(rows, table, keys, weight, null_safe=False)
    return out.withColumns({c: F.coalesce(q(c), F.lit(v)) for c, v in defaults.items()})


def group_table(df: DataFrame, groups: Sequence[str], stats: Mapping[str, Column]) -> DataFrame:
    """All statistics of a group in one aggregate (in place of inner joins of one-statistic tables)."""
    return df.groupBy(*groups).agg(*[c.alias(n) for n, c in stats.items()])


def map_lookup(rows: DataFrame, column: str, table: DataFrame, key: str, value: str, new: str) -> DataFrame:
    """Dictionary lookup of one column; a null or unknown key gives null."""
    entries = table.select(q(key).alias("__key"), q(value).alias(new), F.lit(1).alias("__n"))
    return lookup_join(rows, entries, {column: "__key"}, weight="__n", null_safe=False).drop("__n")


def key_join(rows: DataFrame, extra: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach columns computed elsewhere, by row key; same-named old columns are replaced."""
    new = [c for c in extra.columns if c not in keys]
    return rows.drop(*new).join(extra, list(keys), "left")


def membership_share(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: share of b's rows whose key occurs in a. Both sides are reduced to distinct keys before they meet."""
    counted = b.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    known = a.select(key).distinct().withColumn("__in", F.lit(1))
    hits = F.sum(F.col("__n") * F.coalesce(F.col("__in"), F.lit(0)))
    return counted.join(known, key, "left").agg((hits / F.sum("__n")).alias("share"))


def contingency(df: DataFrame, column: str, target: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Per value: number of rows of each class."""
    return df.groupBy(column).agg(*[F.count_if(q(target) == c).alias(f"n{c}") for c in classes])
