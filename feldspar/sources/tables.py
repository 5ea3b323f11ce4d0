"""Reading and writing tables, predictions and labelled text."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feldspar.functions import text as tx
from feldspar.operators.profile import q
from feldspar.plans.storage import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared scratch folder of the session."""
    return f"{ensure_checkpoint_dir(spark)}/feldspar-{name}-{uuid.uuid4().hex}"


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Header CSV with quoted multi-line text; the schema is given, so the files are read once."""
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True)
    return reader.option("quote", '"').option("escape", '"').csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)


def fill_text_nulls(df: DataFrame, value: str = " ") -> DataFrame:
    """Every null string becomes a blank."""
    return df.na.fill(value)


def sink_predictions(df: DataFrame, key: str, targets: Sequence[str], path: str) -> None:
    """Key and one probability column per target, as CSV with a header."""
    write_csv(df.select(key, *targets), path)


def gz_path(path: str, prefix: str, suffix: str = ".csv.gz") -> str:
    """Add the prefix and suffix where they are missing."""
    path = path if path.startswith(prefix) else prefix + path
    return path if path.endswith(suffix) else path + suffix


def sink_csv_gz(df: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """``|``-separated, gzip-compressed CSV with a header, in files of at most ``rows_per_file`` rows."""
    writer = df.write.option("header", True).option("sep", "|").option("compression", "gzip")
    writer.option("maxRecordsPerFile", rows_per_file).option("quote", '"').option("escape", '"').csv(path)


def scan_csv_gz(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    reader = spark.read.schema(schema).option("header", True).option("sep", "|").option("multiLine", True)
    return reader.option("quote", '"').option("escape", '"').csv(path)


def labeled_lines(df: DataFrame, text: str, target: str) -> DataFrame:
    """One line per document: normalised text and its label."""
    return df.select(F.concat_ws(" ", tx.normalize(q(text)), tx.label(q(target))).alias("value"))


def sink_labeled_text(df: DataFrame, text: str, targets: Sequence[str], split: str, path: str) -> None:
    """One text file set per target and split, partitioned as ``target=<t>/split=<s>``; unlabelled rows are left out."""
    long = df.select(
        tx.normalize(q(text)).alias("__text"),
        q(split).alias("split"),
        F.inline(F.array(*[F.struct(F.lit(t).alias("target"), q(t).alias("__y")) for t in targets])),
    ).filter(F.col("__y").isNotNull())
    lines = long.select(F.concat_ws(" ", "__text", tx.label(F.col("__y"))).alias("value"), "target", "split")
    lines.write.partitionBy("target", "split").text(path)


def scan_labeled_text(spark: SparkSession, path: str) -> DataFrame:
    """(text, label, ok) per line; empty text is a blank, and ``ok`` is false for a line without a 0/1 label."""
    lines = spark.read.text(path)
    value = F.col("value")
    tail = F.right(value, F.lit(10))
    ok = tail.isin("__label__0", "__label__1")
    body = F.left(value, F.greatest(F.length(value) - 11, F.lit(0)))
    return lines.select(
        *[c for c in lines.columns if c != "value"],
        F.when(body == "", F.lit(" ")).otherwise(body).alias("text"),
        F.when(ok, F.right(value, F.lit(1)).cast("int")).alias("label"),
        ok.alias("ok"),
    )


def bad_lines(lines: DataFrame) -> DataFrame:
    """Number of lines without a valid label."""
    return lines.agg(F.count_if(~F.col("ok")).alias("n_bad"))


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
