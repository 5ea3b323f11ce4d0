"""Positions in a total order and exact quantiles, without one-task windows.

Rows are range-partitioned on the order (equal keys are spread with a tie column), sorted inside each
partition and numbered; the number of rows per partition gives every partition its offset. The layout is
written to reliable storage, because partition numbers must not change between the two uses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feldspar.plans.lookup import lookup_join
from feldspar.plans.storage import materialize

POSITION = "__pos"
_PART_BITS = 33
IN_MEMORY = 2_000_000  # rows of a group that one aggregation buffer may hold


def _part(c: Column) -> Column:
    return F.shiftright(c, _PART_BITS)


def _local(c: Column) -> Column:
    return c.bitwiseAND(F.lit((1 << _PART_BITS) - 1))


def lay_out(df: DataFrame, order: Sequence[Column], ties: bool = False) -> DataFrame:
    """Range-partition and sort by ``order`` (ascending values, nulls first); adds ``__mid`` (partition number and row number in it)."""
    names = [f"__o{i}" for i in range(len(order))]
    keyed = df.select("*", *[o.alias(n) for o, n in zip(order, names)])
    by = [F.col(n) for n in names]
    if ties:
        keyed = keyed.withColumn("__tie", F.rand(17))
        ranged = keyed.repartitionByRange(*by, F.col("__tie"))
    else:
        ranged = keyed.repartitionByRange(*by)
    numbered = ranged.sortWithinPartitions(*by).withColumn("__mid", F.monotonically_increasing_id())
    return materialize(numbered.drop("__tie", *names))


def partition_offsets(laid: DataFrame) -> DataFrame:
    """(``__part``, ``__offset``): one row per partition, so its size is bounded by the partition count."""
    counts = laid.groupBy(_part(F.col("__mid")).alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))


def with_position(df: DataFrame, order: Sequence[Column], ties: bool = False) -> DataFrame:
    """Add ``__pos``, the 0-based position of each row in the total order."""
    laid = lay_out(df, order, ties)
    offsets = F.broadcast(partition_offsets(laid))
    return (
        laid.withColumn("__part", _part(F.col("__mid")))
        .join(offsets, "__part")
        .withColumn(POSITION, F.col("__offset") + _local(F.col("__mid")))
        .drop("__part", "__offset", "__mid")
    )


def running_counts(
    df: DataFrame, order: Sequence[Column], conditions: dict[str, Column]
) -> DataFrame:
    """For each name: the number of rows up to and including this one for which the condition holds.

    A condition may also be a whole number per row, which is summed. One layout serves all conditions: a running count inside each partition plus the partition's start.
    """
    flags = {f"__f{i}": c.cast("long") for i, c in enumerate(conditions.values())}
    laid = lay_out(df.withColumns(flags), order)
    laid = laid.withColumn("__part", _part(F.col("__mid")))
    per_part = laid.groupBy("__part").agg(*[F.sum(f).alias(f) for f in flags])
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select(
        "__part", *[F.coalesce(F.sum(f).over(before), F.lit(0)).alias(f"{f}_start") for f in flags]
    )
    inside = Window.partitionBy("__part").orderBy("__mid").rowsBetween(Window.unboundedPreceding, 0)
    counted = laid.join(F.broadcast(starts), "__part").withColumns(
        {n: F.col(f"{f}_start") + F.sum(f).over(inside) for n, f in zip(conditions, flags)}
    )
    return counted.drop("__part", "__mid", *flags, *[f"{f}_start" for f in flags])


def grouped_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    values: Sequence[str],
    probs: Sequence[float],
    largest_group: int,
    in_memory: int | None = None,
) -> DataFrame:
    """Exact linear-interpolation quantiles: one row per group, columns ``<value>@<prob>``; groups hold no null.

    ``largest_group`` is the row count of the largest group, which callers already know. Up to
    ``in_memory`` rows a group fits one aggregation buffer and the built-in ``percentile`` is used; beyond,
    values are sorted across the cluster and the wanted positions picked out.
    """
    if largest_group <= (IN_MEMORY if in_memory is None else in_memory):
        return df.groupBy(*groups).agg(
            *[F.percentile(f"`{v}`", F.lit(p)).alias(f"{v}@{p}") for v in values for p in probs]
        )
    table = df.select(*groups).distinct()
    for v in values:
        table = table.join(_sorted_quantiles(df, groups, v, probs), list(groups), "left")
    return table


def _sorted_quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    present = df.filter(F.col(f"`{value}`").isNotNull()).select(*groups, F.col(f"`{value}`").alias("__v"))
    by = [F.col(f"`{g}`") for g in groups]
    placed = with_position(present, [*by, F.col("__v")], ties=True)
    spans = placed.groupBy(*groups).agg(F.min(POSITION).alias("__start"), F.count(F.lit(1)).alias("__n"))
    picks = [
        F.struct(F.lit(i).alias("which"), at.alias("at"), share.alias("share"))
        for i, p in enumerate(probs)
        for at, share in _ends(p)
    ]
    wanted = spans.select(F.explode(F.array(*picks)).alias("w")).select("w.which", "w.at", "w.share")
    hits = placed.join(wanted, placed[POSITION] == wanted["at"])
    return hits.groupBy(*groups).agg(
        *[
            F.sum(F.when(F.col("which") == i, F.col("__v") * F.col("share"))).alias(f"{value}@{p}")
            for i, p in enumerate(probs)
        ]
    )


def _ends(p: float) -> list[tuple[Column, Column]]:
    rank = F.lit(p) * (F.col("__n") - 1)
    low = F.floor(rank)
    part = rank - low
    return [
        (F.col("__start") + low, F.lit(1.0) - part),
        (F.col("__start") + F.least(low + 1, F.col("__n") - 1), part),
    ]


def group_positions(df: DataFrame, groups: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Add ``__pos`` (0-based inside the group) and ``__n`` (rows of the group)."""
    placed = with_position(df, [*[F.col(f"`{g}`") for g in groups], *order])
    spans = placed.groupBy(*groups).agg(F.min(POSITION).alias("__start"), F.count(F.lit(1)).alias("__n"))
    joined = lookup_join(placed, spans, list(groups), weight="__n")
    return joined.withColumn(POSITION, F.col(POSITION) - F.col("__start")).drop("__start")
