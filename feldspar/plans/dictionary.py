"""One dictionary for the values of many columns: one scan counts them, one range sort numbers them.

Every row gives a (column number, value) pair per column; values of one type share a field, so any number of columns
travels in as many fields as there are types. Pairs are counted before they are shuffled. Only figures per column
(its number of values, the position of its first one, its bytes) reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feldspar.plans.lookup import lookup_join
from feldspar.plans.ordering import POSITION, with_position
from feldspar.plans.storage import materialize

WHICH, VALUE, COUNT = "__which", "__value", "__n"


@dataclass(frozen=True)
class Counted:
    """``table``: one row per (column, value) with the number of its rows; ``field``: where a column's values lie."""

    table: DataFrame
    names: tuple[str, ...]
    field: Mapping[str, str]

    def of(self, name: str, *more: Column) -> DataFrame:
        return self.table.where(F.col(WHICH) == self.names.index(name)).select(F.col(self.field[name]).alias(VALUE), COUNT, *more)

    def figures(self, *more: Column) -> dict[str, dict]:
        """Per column: ``values`` (how many), ``octets`` of the values as text, and ``more`` aggregates."""
        octets = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(f).cast("string")), F.lit(0)) for f in sorted(set(self.field.values()))])
        rows = self.table.groupBy(WHICH).agg(F.count(F.lit(1)).alias("values"), F.sum(octets).alias("octets"), *more).collect()  # a row per column
        return {self.names[r[WHICH]]: r.asDict() for r in rows}


def count_values(df: DataFrame, values: Mapping[str, Column], first: Sequence[Column] = ()) -> Counted:
    """The values of all named expressions with their counts, nulls left out; with ``first`` also ``__first``, the least of these orders."""
    types = [f.dataType for f in df.select(*[v.alias(f"c{i}") for i, v in enumerate(values.values())]).schema.fields]
    kinds = list({t.simpleString(): t for t in types}.values())
    fields = {t.simpleString(): f"__v{j}" for j, t in enumerate(kinds)}

    def cell(i: int, value: Column, own: T.DataType) -> Column:
        return F.struct(F.lit(i).alias(WHICH), *[(value if t == own else F.lit(None).cast(t)).alias(fields[t.simpleString()]) for t in kinds])

    cells = F.array(*[cell(i, v, t) for i, (v, t) in enumerate(zip(values.values(), types))])
    order = [F.struct(*first).alias("__order")] if first else []
    pairs = df.select(*order, F.inline(cells)).where(reduce(lambda a, b: a | b, [F.col(f).isNotNull() for f in fields.values()]))
    least = [F.min("__order").alias("__first")] if first else []
    table = pairs.groupBy(WHICH, *fields.values()).agg(F.count(F.lit(1)).alias(COUNT), *least)
    return Counted(materialize(table), tuple(values), {n: fields[t.simpleString()] for n, t in zip(values, types)})


def attach_codes(df: DataFrame, values: Mapping[str, Column], first: Sequence[Column] = ()) -> tuple[DataFrame, dict[str, int]]:
    """Add a column per name: the 0-based rank of its value among the distinct ones (or by first appearance); null stays null.

    Also returns the number of distinct values of each.
    """
    if not values:
        return df, {}
    counted = count_values(df, values, first)
    by = [F.col("__first")] if first else [F.col(f) for f in sorted(set(counted.field.values()))]
    placed = materialize(with_position(counted.table, [F.col(WHICH), *by]).drop("__first"))
    placed = Counted(placed, counted.names, counted.field)
    figures = placed.figures(F.min(POSITION).alias("start"))
    out = df.withColumns({f"__value{i}": v for i, v in enumerate(values.values())}).drop(*values)
    for i, name in enumerate(values):
        own = figures.get(name, {"values": 0, "octets": 0, "start": 0})
        codes = placed.of(name, (F.col(POSITION) - own["start"]).alias(name))
        out = lookup_join(out, codes, {f"__value{i}": VALUE}, weight=COUNT, null_safe=False, stored=True, size=own["values"] * 48 + own["octets"])
    return out.drop(COUNT, *[f"__value{i}" for i in range(len(values))]), {n: figures[n]["values"] if n in figures else 0 for n in values}
