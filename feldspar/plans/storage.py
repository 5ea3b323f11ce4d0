"""Reliable materialisation of intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the folder the cluster names; make one only for a local session that has none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="feldspar-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to reliable storage and read it from there afterwards.

    Later plans neither recompute it nor depend on the executors that produced it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, schema: StructType) -> DataFrame:
    """Write ``df`` as Parquet beside the checkpoints and read it as ``schema``: columns take less than checkpointed rows, and structs can be read as vectors."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4()}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(schema).parquet(folder)
