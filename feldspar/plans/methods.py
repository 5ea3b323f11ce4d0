"""Wide projections in sessions that bring their own settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Bytes of a method beyond which HotSpot only interprets it.
COMPILED_MOST = 8000


def small_methods(spark: SparkSession) -> None:
    """From now on this session does not fuse stages into methods that HotSpot would not compile; wide projections run several times faster."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > COMPILED_MOST:
        spark.conf.set(name, str(COMPILED_MOST))
