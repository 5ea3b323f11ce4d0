"""Intermediate tables, written once to the shared folder as Parquet and read from there."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from feldspar.plans.storage import ensure_checkpoint_dir

#: Rows of an Arrow batch. The default of 10,000 whole texts takes each Python worker, and the JVM beside it, hundreds of MB.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """From now on this session hands Python at most BATCH_ROWS rows at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


@contextmanager
def configured(spark: SparkSession, **names: str) -> Iterator[None]:
    """Holds session settings (dots written as two underscores) and puts back what they were."""
    names = {k.replace("__", "."): v for k, v in names.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffled_joins(spark: SparkSession):
    """Joins send no side to the driver by Spark's own estimate, which goes by compressed files and not by what an explode or join makes of them."""
    return configured(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` beside the checkpoints and read it back: later plans neither recompute it nor need its executors.

    Parquet columns take a fraction of what checkpointed rows take, and a table that is no longer needed can be removed.
    """
    small_batches(df.sparkSession)
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4()}"
    df.write.parquet(folder)
    out = df.sparkSession.read.schema(df.schema).parquet(folder)
    out._written_to = folder
    return out


def discard(df: DataFrame) -> None:
    """Remove the files of a table made by ``materialize`` that nothing reads any more."""
    spark: SparkSession = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._written_to)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
