"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

A piece of length n belongs to the reciprocal class k = capacity // n, whose bins hold exactly k pieces. A document is
cut into full sequences and a rest; the rest stays whole if it nearly fills its slot of capacity // k, else a piece of
the next smaller slot's exact width is cut off and what remains is classed in turn. Bins need no search: piece i of
class k lies in bin i // k, and pieces are numbered per class without gaps, so workers fill bins independently. The
incomplete last bin of each class (fewer than capacity classes, each with fewer than k pieces, whatever the input) is
dissolved, and those pieces are packed by best fit.

Null and empty texts hold the end token alone. Equal rows are packed as often as they occur. An empty table gives an
empty result. Only the id and text columns of the input are read, and a row's text never leaves its task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feldspar.llm.bpe import encode_text
from feldspar.llm.graph import numbered
from feldspar.llm.vocab import default_path, vocab
from feldspar.llm.storage import materialize, small_batches

CAPACITY = 2048
END = 1
#: The part of its slot that an uncut rest may leave empty.
SLACK = 1 / 32


def cut(tokens: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int, int]]:
    """(start, length, class) of the pieces of a document."""
    out = [(i * capacity, capacity, 1) for i in range(tokens // capacity)]
    at, rest = tokens // capacity * capacity, tokens % capacity
    while rest:
        k = capacity // rest
        slot = capacity // k
        size = rest if slot - rest <= slack * slot or rest <= capacity * slack * 2 else capacity // (k + 1)
        out.append((at, size, capacity // size))
        at, rest = at + size, rest - size
    return out


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, class): the cut pieces of every row, before packing."""
    path = path or default_path()
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocab(path)
        for batch in batches:
            take, out = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encode_text(v, t), np.uint32(end)).astype("<u4")
                for start, length, k in cut(len(ids), capacity):
                    take.append(i)
                    out.append((start, length, zlib.crc32(ids[start : start + length].tobytes()), len(ids), k))
            columns = [pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(take, pa.int64())), *columns], names)

    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "class"]
    schema = f"key {rows.schema['key'].dataType.simpleString()}, " + ", ".join(f"{c} bigint" for c in names[1:])
    return rows.mapInArrow(run, schema)


def best_fit(rest: pd.DataFrame, capacity: int = CAPACITY) -> pd.DataFrame:
    """Add bin and offset: pieces by falling length, each into the fullest bin that has room."""
    rest = rest.sort_values(["length", "class", "i"], ascending=[False, True, True]).reset_index(drop=True)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free room
    bins, offsets, made = [], [], 0
    for n in rest["length"]:
        room = next((r for r in range(n, capacity) if free[r]), capacity)
        if room == capacity:
            at, made = made, made + 1
        else:
            at = free[room].pop()
        bins.append(at)
        offsets.append(capacity - room)
        free[room - n].append(at)
    return rest.assign(bin=np.array(bins, np.int64), offset=np.array(offsets, np.int64))


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to the rows of ``pieces``."""
    rows = materialize(cut_pieces)
    order = [c for c in rows.columns if c != "class"]
    placed = numbered(rows, ["class"], order, "i")
    classes = rows.groupBy("class").agg(F.count(F.lit(1)).alias("n")).withColumn("full", F.expr("n div class"))
    # At most ``capacity`` rows, one per class.
    starts = classes.select("class", "full", F.coalesce(F.sum("full").over(Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    placed = materialize(placed.join(F.broadcast(starts), "class"))
    whole = placed.where("i < full * class").withColumn("sequence_id", F.expr("first + i div class"))
    before = Window.partitionBy("sequence_id").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    rest = placed.where("i >= full * class").select(*order, "class", "i")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields) + ", bin bigint, offset bigint"
    used = classes.agg(F.sum("full")).first()[0] or 0
    rest = rest.groupBy().applyInPandas(lambda x: best_fit(x, capacity), schema)
    rest = rest.withColumn("sequence_id", F.col("bin") + F.lit(used))
    names = [*order, "sequence_id", "offset"]
    return whole.select(*names).union(rest.select(*names))


def harmonic(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per piece: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""
    out = pack(pieces(docs, key, text, path))
    return out.select(F.col("key").alias(key), "start", "length", "ids_crc32", "doc_tokens", F.col("sequence_id").cast("long").alias("sequence_id"), F.col("offset").cast("long").alias("offset"))
