"""One aggregate table per category column, from a single scan (grouping sets)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feldspar.plans.storage import materialize

CHUNK = 24


def tables_by_column(df: DataFrame, columns: Sequence[str], aggregates: Sequence[Column]) -> dict[str, DataFrame]:
    """``{column: table}``; each table holds the column, ``__n`` (its row count) and the aggregates.

    Columns are grouped in one pass per chunk; the result is written once and filtered per column.
    """
    out: dict[str, DataFrame] = {}
    for start in range(0, len(columns), CHUNK):
        part = list(columns[start : start + CHUNK])
        keys = {f"__c{i}": F.col(f"`{c}`") for i, c in enumerate(part)}
        keyed = df.withColumns(keys)
        names = list(keys)
        size = F.count(F.lit(1)).alias("__n")
        if len(part) == 1:
            table = materialize(keyed.groupBy(*names).agg(size, *aggregates))
            out[part[0]] = table.withColumnRenamed("__c0", part[0])
            continue
        grouped = keyed.groupingSets([[n] for n in names], *names).agg(
            F.grouping_id().alias("__set"), size, *aggregates
        )
        table = materialize(grouped)
        everything = (1 << len(part)) - 1
        for i, c in enumerate(part):
            which = everything - (1 << (len(part) - 1 - i))
            others = [n for n in names if n != names[i]]
            out[c] = table.filter(F.col("__set") == which).drop("__set", *others).withColumnRenamed(names[i], c)
    return out
