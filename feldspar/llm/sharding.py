"""Sharding by jump consistent hashing, in DataFrame expressions only.

The law is ``key``: the key and the number of shards decide. A key walks a chain of pseudo-random jumps seeded by
itself; its shard is the last jump below the number of shards. With one more shard the chain is the same, so a row
stays or moves into the new shard, and the share that moves is 1 / (n + 1). There is no ring table to keep.

Nulls: a null key walks as key 0, a null text has no bytes and checksum 0. Equal rows share a shard and get slots of
their own; an empty table gives an empty result; other columns of the input, whatever their names, are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feldspar.llm.graph import numbered

#: Fixed value: the multiplier of the generator in the published algorithm, 2862933555777941757, in parts.
HIGH, LOW_UPPER, LOW_LOWER = 0x27BB2EE6, 0x87B0, 0xB0FD
#: Bytes that a row counts besides its text.
ROW_BYTES = 8


def _low(c: Column) -> Column:
    return c.bitwiseAND(F.lit(0xFFFFFFFF))


def _step(high: Column, low: Column) -> tuple[Column, Column]:
    """key * multiplier + 1 modulo 2^64 on two 32-bit halves, in parts that never pass 63 bits."""
    upper = low * F.lit(LOW_UPPER)
    t = low * F.lit(LOW_LOWER) + F.shiftleft(upper.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
    carry = F.shiftright(t, 32) + F.shiftright(upper, 16)
    mixed = high * F.lit(LOW_LOWER) + F.shiftleft((high * F.lit(LOW_UPPER)).bitwiseAND(F.lit(0xFFFF)), 16)
    return _low(carry + _low(mixed) + _low(low * F.lit(HIGH))), _low(t)


def jump_shards(key: Column, shards: int) -> Column:
    """struct(shard, grown): the shard of a long key among ``shards``, and among one more, from one chain of jumps."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    long = lambda c: c.cast("long")

    def walk(at: Column, _: Column) -> Column:
        high, low = _step(at["high"], at["low"])
        bits = F.shiftright(high, 1) + F.lit(1)  # the 31 upper bits
        jump = F.floor((at["jump"] + 1).cast("double") * (F.lit(float(1 << 31)) / bits.cast("double")))
        return F.when(
            at["jump"] <= F.lit(shards),
            F.struct(
                long(high).alias("high"),
                long(low).alias("low"),
                long(jump).alias("jump"),
                F.when(at["jump"] < F.lit(shards), at["jump"]).otherwise(at["shard"]).alias("shard"),
                at["jump"].alias("grown"),
            ),
        ).otherwise(at)

    zero = F.lit(0).cast("long")
    start = F.struct(
        long(_low(F.shiftrightunsigned(key, 32))).alias("high"), long(_low(key)).alias("low"), zero.alias("jump"), zero.alias("shard"), zero.alias("grown")
    )
    end = F.aggregate(F.sequence(F.lit(1), F.lit(shards + 2)), start, walk)
    return F.struct(end["shard"].cast("int").alias("shard"), end["grown"].cast("int").alias("grown"))


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) for every row; slots are gapless from 0 in each shard.

    The text is reduced to its size and checksum in the scan; only those few numbers are shuffled.
    """
    octets = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key).alias("__key"),
        (F.octet_length(octets) + ROW_BYTES).cast("long").alias("__size"),
        F.crc32(octets).alias("__crc"),
        jump_shards(F.col(key), shards).alias("__to"),
    ).select("__key", "__size", "__crc", F.col("__to.shard").alias("__shard"), F.col("__to.grown").alias("__grown"))
    out = numbered(rows, ["__shard"], ["__key", "__crc", "__size"], "__slot")
    return out.select(
        F.col("__key").alias(key),
        F.col("__size").alias("size"),
        F.col("__crc").alias("text_crc32"),
        F.lit("key").alias("law"),
        F.col("__shard").alias("shard"),
        F.col("__slot").cast("long").alias("slot"),
        F.col("__grown").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, shards: int, folder: str, key: str = "doc_id") -> None:
    """Write all rows and columns as Parquet, one folder per shard (shard=0, shard=1 ...), without a shuffle."""
    docs.withColumn("shard", jump_shards(F.col(key), shards)["shard"]).write.partitionBy("shard").mode("overwrite").parquet(folder)
