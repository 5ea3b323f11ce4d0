"""Metrics as one-row aggregates; AUC from global positions of the sorted scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feldspar.operators.profile import q
from feldspar.plans.ordering import running_counts


def _d(name: str) -> Column:
    return q(name).cast("double")


def rmse(y: str, p: str) -> Column:
    return F.sqrt(F.avg((_d(y) - _d(p)) * (_d(y) - _d(p))))


def rmsle(y: str, p: str) -> Column:
    gap = F.log1p(_d(p)) - F.log1p(_d(y))
    return F.sqrt(F.avg(gap * gap))


def rss(y: str, p: str) -> Column:
    return F.sum((_d(y) - _d(p)) * (_d(y) - _d(p)))


def mae(y: str, p: str) -> Column:
    return F.avg(F.abs(_d(y) - _d(p)))


def accuracy(y: str, p: str) -> Column:
    return F.avg((q(y) == q(p)).cast("int"))


def positive_hit_rate(y: str, p: str) -> Column:
    """True positives / predicted positives (precision); 0 where nothing is predicted."""
    hit = F.count_if((q(y) == 1) & (q(p) == 1))
    return F.coalesce(hit / F.nullif(F.count_if(q(p) == 1), F.lit(0).cast("long")), F.lit(0.0))


def false_discovery_rate(y: str, p: str) -> Column:
    """False positives / predicted positives; 0 where nothing is predicted."""
    miss = F.count_if((q(y) == 0) & (q(p) == 1))
    return F.coalesce(miss / F.nullif(F.count_if(q(p) == 1), F.lit(0).cast("long")), F.lit(0.0))


def classification_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """(class, precision, recall, f1, support) per class and the support-weighted average.

    The confusion table has one row per (label, prediction) pair; everything else is computed on it.
    """
    cells = df.groupBy(q(y).cast("string").alias("y"), q(p).cast("string").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("y").alias("class"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("predicted"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hit")),
            )
        )
    )
    sums = sides.groupBy("class").agg(F.sum("actual").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit"))
    zero = F.lit(0).cast("long")
    scored = sums.withColumns(
        {
            "precision": F.coalesce(F.col("hit") / F.nullif(F.col("predicted"), zero), F.lit(0.0)),
            "recall": F.coalesce(F.col("hit") / F.nullif(F.col("support"), zero), F.lit(0.0)),
        }
    )
    both = F.col("precision") + F.col("recall")
    scored = scored.withColumn("f1", F.coalesce(2 * F.col("precision") * F.col("recall") / F.nullif(both, F.lit(0.0)), F.lit(0.0)))
    per_class = scored.select("class", "precision", "recall", "f1", "support")
    weighted = per_class.agg(
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in ("precision", "recall", "f1")],
        F.sum("support").alias("support"),
    ).select(F.lit("avg / total").alias("class"), "precision", "recall", "f1", "support")
    return per_class.unionByName(weighted)


def roc_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """One row (auc): the rank formula, ties count one half. Rows are counted per score first; only distinct scores are sorted."""
    rows = df.select((q(y) == 1).cast("long").alias("y"), _d(score).alias("s")).filter("s is not null and y is not null")
    per_score = rows.groupBy("s").agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n"))
    per_score = running_counts(per_score, [F.col("s")], {"upto": F.col("n")})
    total = per_score.agg(
        F.sum(F.col("pos") * (F.col("upto") - (F.col("n") - 1) / F.lit(2.0))).alias("ranks"),
        F.sum("pos").cast("double").alias("n1"),
        (F.sum("n") - F.sum("pos")).cast("double").alias("n0"),
    )
    pairs = F.nullif(F.col("n1") * F.col("n0"), F.lit(0.0))
    return total.select(((F.col("ranks") - F.col("n1") * (F.col("n1") + 1) / 2) / pairs).alias("auc"))


def roc_auc_by(counted: DataFrame, groups: Sequence[str], score: str, pos: str, n: str) -> DataFrame:
    """(groups, auc) from rows and positive rows per group and distinct score; null where a group has one class only."""
    upto = running_counts(counted, [*[q(g) for g in groups], q(score)], {"__upto": q(n)})
    n1, both = F.sum(pos).cast("double"), F.sum(n).cast("double")
    before = F.min(F.col("__upto") - q(n))
    ranks = F.sum(q(pos) * (F.col("__upto") - (q(n) - 1) / F.lit(2.0))) - before * n1
    return upto.groupBy(*groups).agg(((ranks - n1 * (n1 + 1) / 2) / F.nullif(n1 * (both - n1), F.lit(0.0))).alias("auc"))


def gini_normalized(df: DataFrame, y: str, score: str) -> DataFrame:
    """2 * AUC - 1 for 0/1 labels."""
    return roc_auc(df, y, score).select((2 * F.col("auc") - 1).alias("gini"))
