"""Partitioning for stages whose work is large for their bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Hash-partition into the session's number of shuffle partitions.

    Adaptive coalescing merges partitions by bytes, which starves stages that expand rows (n-grams) or sweep long
    windows; a partitioning with a fixed number is left as it is.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *columns)


def spread_scan(df: DataFrame) -> DataFrame:
    """Deal the rows of inputs with fewer files than cores out to all cores; inputs of more files stay in place.

    Only files are counted, not bytes: an input of few very large files is shuffled as well, although a scan would cut
    them. The names of the files are listed on the driver.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df
