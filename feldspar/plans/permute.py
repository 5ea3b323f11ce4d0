"""Repeatable shuffles of numbered rows: a bijection of positions instead of a sort by a random key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feldspar.plans.ordering import POSITION

#: Rows of a partition of ``in_blocks``.
BLOCK_ROWS = 100_000
#: Positions that a task of ``dealt`` permutes; each costs some microseconds and few bytes.
MOVED = 25_000


def permuted(position: Column, n: int, *key: Column) -> Column:
    """Where ``key``'s permutation of 0..n-1 takes a position.

    A swap-or-not shuffle: each round pairs the positions x and (k - x) mod n, for a k of its own, and a hash of the larger of
    both decides whether the pair changes places. Every round is its own inverse, so the whole is a bijection for any n.
    """
    size = F.lit(n).cast("long")
    rounds = max(32, 4 * n.bit_length())
    # With a literal key the optimizer folds this array, so that a row does not work out the sums of all pairs.
    sums = F.array(*[F.struct(F.lit(i).alias("i"), F.pmod(F.xxhash64(*key, F.lit(i)), size).alias("k")) for i in range(rounds)])

    def swap_or_not(x: Column, pair: Column) -> Column:
        other = F.pmod(pair["k"] - x, size)
        swap = F.xxhash64(F.greatest(x, other), *key, pair["i"]).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(x)

    return F.aggregate(sums, position.cast("long"), swap_or_not)


def dealt(df: DataFrame, moved: int) -> DataFrame:
    """Rows with ``__pos`` in as many partitions as ``moved`` positions to permute need; adaptive coalescing would count bytes only."""
    return df.repartition(-(-moved // MOVED) or 1, POSITION)


def in_blocks(df: DataFrame, n: int) -> DataFrame:
    """Rows with ``__pos`` in partitions that depend on n and the positions alone, in order.

    Learners draw samples by partition, so the same rows give the same model however they were partitioned before.
    """
    blocks = -(-n // BLOCK_ROWS) or 1
    return df.repartition(blocks, F.floor(F.col(POSITION) / BLOCK_ROWS)).sortWithinPartitions(POSITION)
