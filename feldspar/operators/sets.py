"""Set operations over train/test rows, entities, terms and label sets; sorts and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspar.operators.profile import TRAIN, q


def union_train_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """Stack both tables with an origin flag; a column that one side lacks is null there."""
    return train.withColumn(TRAIN, F.lit(1)).unionByName(test.withColumn(TRAIN, F.lit(0)), allowMissingColumns=True)


def label_intersect_ratio(df: DataFrame, a: str, b: str) -> DataFrame:
    """|A and B| / |A| of two 0/1 labels."""
    return df.filter(q(a) == 1).agg(F.avg(F.coalesce(q(b) == 1, F.lit(False)).cast("int")).alias("ratio"))


def label_only_ratio(df: DataFrame, a: str, others: Sequence[str]) -> DataFrame:
    """|A without every other label| / |A|."""
    alone = F.lit(True)
    for o in others:
        alone = alone & ~F.coalesce(q(o) == 1, F.lit(False))
    return df.filter(q(a) == 1).agg(F.avg(alone.cast("int")).alias("ratio"))


def rows_with_no_label(df: DataFrame, labels: Sequence[str], name: str = "non_toxic") -> DataFrame:
    """Flag the rows that carry none of the labels."""
    none = F.lit(True)
    for l in labels:
        none = none & ~F.coalesce(q(l) == 1, F.lit(False))
    return df.withColumn(name, none.cast("int"))


def distinct_union(frames: Sequence[DataFrame], column: str) -> DataFrame:
    """Distinct values of a column over several tables (entities or vocabulary terms)."""
    out = frames[0].select(column)
    for f in frames[1:]:
        out = out.union(f.select(column))
    return out.distinct()


def order_by_group_size(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), group)


def top_k(table: DataFrame, score: str, name: str, k: int) -> DataFrame:
    return table.orderBy(F.desc(score), name).limit(k)


def order_by_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.orderBy(*key)


def sort_scores(table: DataFrame, score: str, name: str) -> DataFrame:
    return table.orderBy(F.desc(score), name)
