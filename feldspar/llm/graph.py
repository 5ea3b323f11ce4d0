"""Connected components of a link table, and gapless numbers within groups, as plain DataFrame jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feldspar.llm.storage import discard, materialize, shuffled_joins

#: Rows that one window partition of ``numbered`` is sized for.
NUMBERED_ROWS = 50_000


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b: long); component is the smallest node reachable.

    Alternating large-star and small-star steps: each replaces links by links to smaller nodes, so that every component
    ends as a star around its smallest node after a number of rounds logarithmic in its size. Links never leave the
    cluster; only a count and a checksum per round reach the driver. Each round is written to the shared folder and
    replaces the one before; its joins are shuffled.
    Null ends and self-links are ignored; an empty table gives an empty result.
    """
    with shuffled_joins(links.sparkSession):
        now = materialize(_ordered(links.select(F.col("a").cast("long"), F.col("b").cast("long"))))
        mark = _mark(now)
        while mark[0]:
            both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
            low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
            large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
            low = large.groupBy("a").agg(F.min("b").alias("m"))
            ends = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            last, now = now, materialize(_ordered(ends))
            discard(last)
            before, mark = mark, _mark(now)
            if mark == before:
                break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _ordered(links: DataFrame) -> DataFrame:
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2 ... within each ``group``, without gaps, the same for the same rows.

    Groups are cut into hash buckets of about NUMBERED_ROWS rows; a bucket's numbers start where the buckets before it
    end, so no task holds a whole group. Equal rows are counted before the shuffle and laid out again at the end, in
    blocks. ``order`` must tell different rows of a bucket apart for the numbers to be repeatable.
    """
    buckets = max(1, -(-rows.count() // NUMBERED_ROWS))
    kept = rows.columns
    counted = rows.groupBy(*kept).agg(F.count(F.lit(1)).alias("__n"))
    counted = counted.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = rows.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = sizes.groupBy(*group, "__bucket").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(g).alias(f"__g_{g}") for g in group], F.col("__bucket").alias("__b"), F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy(*group, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("__before", F.coalesce(F.sum("__n").over(within), F.lit(0)))
    on = F.col("__bucket") == F.col("__b")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    placed = placed.join(starts, on).withColumn("__first", F.col("__start") + F.col("__before"))
    block = 10_000
    placed = placed.withColumn("__at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(block).cast("long"))))
    last = F.least(F.col("__at") + (block - 1), F.col("__n") - 1)
    return placed.withColumn("__k", F.explode(F.sequence(F.col("__at"), last))).select(*kept, (F.col("__first") + F.col("__k")).alias(name))


def identified(docs: DataFrame, key: str) -> DataFrame:
    """(doc: struct of all columns, uid: long), a number that tells rows apart and follows the order of ``key``.

    Whole keys that are all different and not null are the numbers. Otherwise the rows are sorted by key, nulls last,
    and written with row numbers, so that every later pass sees the same ones.
    """
    n, different = docs.agg(F.count(F.lit(1)), F.count_distinct(F.col(key))).first()
    if n == different and dict(docs.dtypes)[key] in ("bigint", "int"):
        return docs.select(F.struct("*").alias("doc"), F.col(key).cast("long").alias("uid"))
    ordered = docs.select(F.struct("*").alias("doc"), F.col(key).alias("key")).sort(F.col("key").asc_nulls_last())
    return materialize(ordered.select("doc", F.monotonically_increasing_id().alias("uid")))
