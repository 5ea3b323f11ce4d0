"""Left joins of rows with a table that has one row per key.

The table is written once and measured. Within the byte bound it is broadcast, so the rows are not
shuffled. Beyond the bound the few keys that are hot (each above 1/HOT_KEYS of all rows, so at most
HOT_KEYS of them) are broadcast alone, and all other keys go through a shuffled join in which hot and
null-keyed rows are spread over salts instead of meeting in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feldspar.plans.storage import materialize

MAX_BYTES_CONF = "spark.feldspar.lookup.maxBytes"
MAX_BYTES = 64 << 20
HOT_KEYS = 1000
SALTS = 256


def _octets(c: Column, kind: T.DataType) -> Column | None:
    """Bytes of a value beside the 8 of its cell, or None if it has none. An element of an array takes what a cell takes."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("long")
    if isinstance(kind, T.StructType):
        inner = [x for f in kind.fields if (x := _octets(c.getField(f.name), f.dataType)) is not None]
        return reduce(lambda a, b: a + b, inner, F.lit(8 + 8 * len(kind.fields)).cast("long"))
    if isinstance(kind, T.ArrayType):
        each = F.coalesce(F.size(c), F.lit(0)).cast("long") * 8
        if _octets(F.lit(None), kind.elementType) is not None:
            inner = F.aggregate(c, F.lit(0).cast("long"), lambda total, x: total + _octets(x, kind.elementType))
            each = each + 16 * F.size(c) + F.coalesce(inner, F.lit(0).cast("long"))
        return F.when(c.isNotNull(), each).otherwise(F.lit(0).cast("long"))
    if isinstance(kind, T.MapType):
        return _octets(F.map_entries(c), T.ArrayType(T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])))
    return None


def table_bytes(table: DataFrame) -> int:
    """Measured size of a table: 16 bytes per cell, plus string bytes and 8 bytes per array element, and what nested values hold."""
    parts = [x for f in table.schema.fields if (x := _octets(F.col(f"`{f.name}`"), f.dataType)) is not None]
    octets = reduce(lambda a, b: a + b, parts, F.lit(0))
    row = table.agg(F.count(F.lit(1)).alias("n"), F.sum(octets.cast("long")).alias("b")).first()
    return row["n"] * 16 * max(len(table.columns), 1) + (row["b"] or 0)


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    weight: str,
    null_safe: bool = True,
    stored: bool = False,
    size: int | None = None,
) -> DataFrame:
    """Attach every non-key column of ``table`` to ``rows`` (left join).

    ``table`` holds one row per key; ``weight`` names its column with the number of rows of that key.
    ``keys`` is a list of shared names or a map from row column to table column. ``stored`` says that the
    table is already materialised, ``size`` gives its bytes where they were measured before.
    """
    pairs = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    if not stored:
        table = materialize(table)
    payload = [c for c in table.columns if c not in pairs.values()]
    renamed = table.select(
        *[F.col(f"`{t}`").alias(f"__k{i}") for i, t in enumerate(pairs.values())],
        *[F.col(f"`{c}`").alias(f"__p{i}") for i, c in enumerate(payload)],
    )
    rows = rows.drop(*payload)
    kept = [F.col(f"`{c}`") for c in rows.columns]
    on = _condition(rows, pairs, null_safe)

    limit = int(rows.sparkSession.conf.get(MAX_BYTES_CONF, str(MAX_BYTES)))
    if (table_bytes(table) if size is None else size) <= limit:
        joined = rows.join(F.broadcast(renamed), on, "left")
        return joined.select(*kept, *[F.col(f"__p{i}").alias(c) for i, c in enumerate(payload)])
    return _spread_join(rows, renamed, pairs, on, payload, payload.index(weight), null_safe)


def _condition(rows: DataFrame, pairs: Mapping[str, str], null_safe: bool) -> Column:
    parts = []
    for i, c in enumerate(pairs):
        left, right = F.col(f"`{c}`"), F.col(f"__k{i}")
        parts.append(left.eqNullSafe(right) if null_safe else left == right)
    return reduce(lambda a, b: a & b, parts)


def _spread_join(
    rows: DataFrame,
    table: DataFrame,
    pairs: Mapping[str, str],
    on: Column,
    payload: Sequence[str],
    weight_at: int,
    null_safe: bool,
) -> DataFrame:
    weight = F.col(f"__p{weight_at}")
    total = table.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.coalesce(weight * F.lit(HOT_KEYS) > F.lit(total), F.lit(False))
    names = [c for c in table.columns if c.startswith("__p")]
    hot = table.filter(is_hot).select(
        *[c for c in table.columns if c.startswith("__k")],
        *[F.col(c).alias(f"__hot{c}") for c in names],
        F.lit(True).alias("__is_hot"),
    )
    cold = table.filter(~is_hot).withColumn("__salt_of_table", F.lit(0))
    kept = [F.col(f"`{c}`") for c in rows.columns]
    tagged = rows.join(F.broadcast(hot), on, "left").drop(*[c for c in table.columns if c.startswith("__k")])
    spread = F.col("__is_hot").isNotNull()
    if not null_safe:
        for c in pairs:
            spread = spread | F.col(f"`{c}`").isNull()
    salt = F.when(spread, F.lit(1) + F.pmod(F.xxhash64(*kept), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    tagged = tagged.withColumn("__salt", salt)
    joined = tagged.join(cold.hint("merge"), on & (F.col("__salt") == F.col("__salt_of_table")), "left")
    values = [
        F.when(F.col("__is_hot"), F.col(f"__hot{p}")).otherwise(F.col(p)).alias(c) for p, c in zip(names, payload)
    ]
    return joined.select(*kept, *values)
