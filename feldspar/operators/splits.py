"""Folds and splits. Position-based ones take explicit order columns, which must be unique per row.

They find the few keys at which a block begins and compare every row's key with them: rows are neither sorted nor moved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspar.functions.numeric import hash_fold, hash_share
from feldspar.operators.profile import q
from feldspar.plans.cuts import block_of
from feldspar.plans.ordering import POSITION, group_positions


def stratified_kfold(df: DataFrame, key: str, k: int = 5, target: str | None = None, name: str = "fold") -> DataFrame:
    """Fold from the md5 of the key (row-local); with ``target`` every class is dealt out evenly instead."""
    if target is None:
        return df.withColumn(name, hash_fold(q(key), k))
    dealt = group_positions(df, [target], [F.md5(q(key).cast("string")), q(key)])
    return dealt.withColumn(name, (F.col(POSITION) % k).cast("int")).drop(POSITION, "__n")


def kfold_contiguous(df: DataFrame, order: Sequence[str], k: int = 5, name: str = "fold") -> DataFrame:
    """K contiguous blocks; the first n mod k of them hold one row more."""
    n = df.count()
    base, extra = divmod(n, k)
    return df.withColumn(name, block_of(df, order, [f * base + min(f, extra) for f in range(1, k)], n))


def contiguous_blocks(df: DataFrame, order: Sequence[str], k: int = 5, name: str = "fold") -> DataFrame:
    """K contiguous blocks of n//k rows; the last takes the rest."""
    n = df.count()
    size = max(n // k, 1)
    return df.withColumn(name, block_of(df, order, [f * size for f in range(1, k)], n))


def time_series_split(df: DataFrame, order: Sequence[str], n_splits: int = 5, name: str = "block") -> DataFrame:
    """Blocks 0..n_splits in time order: split i trains on blocks below i and validates on block i (i from 1).

    Blocks hold n // (n_splits + 1) rows; the remainder goes to block 0.
    """
    n = df.count()
    size = max(n // (n_splits + 1), 1)
    first = size + n % (n_splits + 1)
    return df.withColumn(name, block_of(df, order, [first + i * size for i in range(n_splits)], n))


def train_test_split_ordered(df: DataFrame, order: Sequence[str], test_size: float = 0.33, name: str = "is_train") -> DataFrame:
    """The first int(n * (1 - test_size)) rows train, the rest test."""
    n = df.count()
    return df.withColumn(name, F.lit(1) - block_of(df, order, [int(n * (1 - test_size))], n))


def train_test_split_random(
    df: DataFrame, key: str, train: float = 0.7, test: float = 0.3, name: str = "is_train", seed: int = 0
) -> DataFrame:
    """Disjoint random parts by a hash of the key: 1 train, 0 test, rows of neither part are left out."""
    u = hash_share(q(key), seed)
    part = F.when(u < train, 1).when(u < train + test, 0)
    return df.withColumn(name, part).filter(F.col(name).isNotNull())
