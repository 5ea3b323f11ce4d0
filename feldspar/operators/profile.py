"""Column profiles and column selection (names on the driver, statistics in one aggregate)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN = "is_train"


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def columns_with_suffix(columns: Sequence[str], suffix: str) -> list[str]:
    return [c for c in columns if c.endswith(suffix)]


def select_by_suffix(df: DataFrame, suffix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *[q(c) for c in columns_with_suffix(df.columns, suffix)])


def classify_columns(columns: Sequence[str]) -> dict[str, list[str]]:
    """Group names by their second ``_`` token; names without one are left out."""
    classes: dict[str, list[str]] = {}
    for c in columns:
        tokens = c.split("_")
        if len(tokens) > 1:
            classes.setdefault(tokens[1], []).append(c)
    return classes


def remove_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def missing(c: Column, value: float | None) -> Column:
    return c.isNull() if value is None else F.coalesce(c == F.lit(value), F.lit(False))


def missing_ratios(df: DataFrame, columns: Sequence[str], value: float | None = None) -> DataFrame:
    """Long (column, ratio), from one aggregate over all columns."""
    shares = df.agg(*[F.avg(missing(q(c), value).cast("int")).alias(c) for c in columns])
    return shares.unpivot([], [q(c) for c in columns], "column", "ratio")


def sparse_columns(
    df: DataFrame, columns: Sequence[str], value: float | None = None, limit: float = 0.5
) -> DataFrame:
    return missing_ratios(df, columns, value).withColumn("is_sparse", (F.col("ratio") > limit).cast("int"))


def major_minor_columns(df: DataFrame, columns: Sequence[str], limit: float = 0.6) -> DataFrame:
    kind = F.when(F.col("ratio") < limit, F.lit("major")).otherwise(F.lit("minor"))
    return missing_ratios(df, columns).withColumn("kind", kind)


def cardinalities(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Long (column, cardinality); null counts as one value. ``exact=False`` uses a sketch, without shuffling values."""
    distinct = F.count_distinct if exact else F.approx_count_distinct
    counts = df.agg(
        *[(distinct(q(c)) + F.coalesce(F.max(q(c).isNull().cast("long")), F.lit(0))).alias(c) for c in columns]
    )
    return counts.unpivot([], [q(c) for c in columns], "column", "cardinality")


def split_by_cardinality(df: DataFrame, columns: Sequence[str], limit: int = 200, exact: bool = True) -> DataFrame:
    kind = F.when(F.col("cardinality") > limit, F.lit("high")).otherwise(F.lit("low"))
    return cardinalities(df, columns, exact).withColumn("kind", kind)


def drop_univalue_columns(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Drop the columns that hold exactly one distinct value (null counted) in the train rows."""
    train = df.filter(q(TRAIN) == 1) if TRAIN in df.columns else df
    # One value throughout: the extremes agree and there is no mixture of null and non-null.
    tests = [
        F.when(F.count(q(c)) == 0, F.lit(True))
        .otherwise((F.count(q(c)) == F.count(F.lit(1))) & F.min(q(c)).eqNullSafe(F.max(q(c))))
        .alias(c)
        for c in columns
    ]
    row = train.agg(*tests).first()
    gone = [c for c in columns if row[c]]
    return df.drop(*gone), gone


def outlier_profile(df: DataFrame, columns: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Per column: number of |x-mean|/std above the limit, and the largest one."""
    row = df.agg(
        *[F.avg(q(c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_samp(q(c)).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    z = [F.abs(q(c).cast("double") - F.lit(row[f"m{i}"])) / F.nullif(F.lit(row[f"s{i}"]), F.lit(0.0)) for i, c in enumerate(columns)]
    out = df.agg(*[F.struct(F.sum((d > limit).cast("long")).alias("n"), F.max(d).alias("z")).alias(f"c{i}") for i, d in enumerate(z)])
    entries = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"c{i}.n"), F.lit(0).cast("long")).alias("n_outliers"), F.col(f"c{i}.z").alias("max_z")) for i, c in enumerate(columns)]
    return out.select(F.inline(F.array(*entries)))


def feature_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: least and greatest value over all listed columns."""
    cells = [q(c).cast("double") for c in columns]
    low = F.least(*cells) if len(cells) > 1 else cells[0]
    high = F.greatest(*cells) if len(cells) > 1 else cells[0]
    return df.agg(F.min(low).alias("min_value"), F.max(high).alias("max_value"))


def filter_by_label(df: DataFrame, label: str, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first n rows (in key order) with the label set."""
    return df.filter(q(label) == 1).orderBy(*order).limit(n)


def attach_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Attach generated columns; old ones of the same name are replaced."""
    return df.withColumns(columns)


def null_pattern_count(df: DataFrame, columns: Sequence[str], as_number: bool = False) -> DataFrame:
    """Rows per pattern, a string with a 1 for each column that is present, in column order.

    ``as_number`` gives a bigint instead, where bit i (weight 2**i) stands for column i; that takes 62 columns at most.
    """
    if as_number:
        if len(columns) > 62:
            raise ValueError("as_number takes at most 62 columns")
        bits = [F.when(q(c).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(columns)]
        pattern = reduce(lambda a, b: a + b, bits)
    else:
        pattern = F.concat(*[q(c).isNotNull().cast("int").cast("string") for c in columns])
    return df.groupBy(pattern.alias("pattern")).agg(F.count(F.lit(1)).alias("n_rows"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long (is_train, column, n_null)."""
    counts = df.groupBy(TRAIN).agg(*[F.count_if(q(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([TRAIN], [q(c) for c in columns], "column", "n_null")


def assert_no_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Return the null counts, or raise when any listed column of the train or test rows holds a null."""
    counts = null_counts(df, columns)
    bad = counts.filter("n_null > 0").collect()  # at most two rows per listed column
    if bad:
        where = ", ".join(sorted(f"{r['column']} ({'train' if r[TRAIN] else 'test'}: {r['n_null']})" for r in bad))
        raise ValueError(f"columns contain nulls: {where}")
    return counts
