"""Nearest neighbours by inner product: multiprobe p-stable hashing.

A vector gets one more component, the root of (largest squared norm - its own), a query a zero: then the largest inner
product is the smallest distance. Each table hashes by ``k`` Gaussian projections, cut into steps of ``width``. A query
visits buckets in the order of their estimated success: the chance that a neighbour at the typical distance, whose
projections lie normally around the query's, falls into the bucket. It stops when the visited chances of a table add up
to ``target``. Buckets are laid out in blocks of bounded size, whatever their size; a task compares a block of vectors
with a block of queries by exact inner products and keeps the best of each query and hands them on at its end. The best of all tables are merged.
A query for which fewer than ``top`` were found visits all buckets.

k grows with the logarithm of the number of vectors; the typical distance comes from a bounded sample, which only
overestimates it and so visits more. Vectors that are null, zero, hold null or non-finite components or are not of the
commonest length take no part, nor do null ids. Equal vectors are ranked by their ids; a repeated id is ranked once
with its best score. An empty table gives an empty result. Only the id and vector columns of the input are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feldspar.llm.vectors import matrix, scores, squared_norm, usable
from feldspar.llm.storage import materialize

TABLES, TARGET, WIDTH = 2, 0.78, 2.0
#: Vectors a bucket is meant to hold, and vectors and queries a block holds.
BUCKET_ROWS, BLOCK_ROWS, BLOCK_QUERIES = 1024, 1024, 512
#: Results that a task holds back to merge them before they are shuffled.
HELD_ROWS = 1_000_000
#: Rows of the sample from which the typical distance is taken.
SAMPLE = 2048


class Hashes:
    """Projections of all tables, and the order in which a query visits buckets."""

    def __init__(self, dimension: int, rows: int, norm: float, near: float, tables: int = TABLES, width: float = WIDTH, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.k = max(2, round(math.log(max(2, rows / BUCKET_ROWS)) / math.log(2.8)))
        self.norm, self.width, self.near = norm, width * norm, max(near, 1e-9 * norm)
        self.lines = rng.normal(size=(tables, dimension + 1, self.k))
        self.shifts = rng.uniform(0, self.width, size=(tables, self.k))

    def places(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """(tables, rows, k) positions in units of the width."""
        squares = (vectors * vectors).sum(1)
        if query:
            vectors, last = vectors * (self.norm / np.sqrt(squares))[:, None], np.zeros(len(vectors))
        else:
            last = np.sqrt(np.maximum(0, self.norm**2 - squares))
        longer = np.concatenate([vectors, last[:, None]], 1)
        return (np.einsum("nd,tdk->tnk", longer, self.lines) + self.shifts[:, None, :]) / self.width

    def visits(self, place: np.ndarray, low: np.ndarray, high: np.ndarray, target: float) -> Iterator[tuple[int, ...]]:
        """Buckets within low..high by falling chance, until the chances add up to ``target``."""
        spread = self.near / self.width
        sides = []
        for x, a, b in zip(place, low, high):
            edges = (np.arange(a, b + 2) - x) / spread
            below = np.array([0.5 * math.erfc(-e / math.sqrt(2)) for e in edges])
            below[0], below[-1] = 0.0, 1.0  # nothing lies outside
            chance = np.maximum(np.diff(below), 1e-300)
            order = np.argsort(-chance, kind="stable")
            sides.append((chance[order], order + a))
        first = (0,) * len(sides)
        heap, seen, total = [(-math.prod(c[0] for c, _ in sides), first)], {first}, 0.0
        while heap and total < target:
            chance, at = heapq.heappop(heap)
            total -= chance
            yield tuple(int(names[i]) for i, (_, names) in zip(at, sides))
            for d, (c, _) in enumerate(sides):
                if at[d] + 1 < len(c):
                    step = (*at[:d], at[d] + 1, *at[d + 1 :])
                    if step not in seen:
                        seen.add(step)
                        heapq.heappush(heap, (chance * c[at[d] + 1] / c[at[d]], step))


def _blocks(rows: DataFrame, size: int, names: list[str]) -> DataFrame:
    """(at, ids, vectors) with about ``size`` rows of one bucket each."""
    sizes = rows.groupBy("at").agg(F.ceil(F.count(F.lit(1)) / size).alias("parts"))
    rows = rows.join(sizes, "at").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    return rows.groupBy("at", "part").agg(F.collect_list("id").alias(names[0]), F.flatten(F.collect_list("v")).alias(names[1])).drop("part")


def _search(index: DataFrame, probes: DataFrame, top: int) -> DataFrame:
    """(query_id, vec_id, score): the best of each query in the pairs of blocks of each task."""

    def best_of(found: list[tuple]) -> tuple:
        """The first ``top`` of each query in some (queries, ids, scores)."""
        a, b, s = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((-s, b, a))  # of a repeated id the best score counts, before anything is cut
        a, b, s = a[order], b[order], s[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        a, b, s = a[new], b[new], s[new]
        order = np.lexsort((b, -s, a))
        a, b, s = a[order], b[order], s[order]
        keep = np.arange(len(a)) - np.searchsorted(a, a) < top
        return a[keep], b[keep], s[keep]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0  # the best of the task so far
        for batch in batches:
            for i in range(batch.num_rows):
                ids, queries = (batch.column(c)[i].values.to_numpy() for c in (0, 2))
                x, q = (batch.column(c)[i].values.to_numpy().astype(np.float64).reshape(m, -1) for c, m in ((1, len(ids)), (3, len(queries))))
                found = q @ x.T
                found[queries[:, None] == ids[None, :]] = -np.inf
                by_id = np.argsort(ids, kind="stable")
                first = np.flatnonzero(np.concatenate([[True], np.diff(ids[by_id]) != 0]))
                if len(first) > top:
                    best = found if len(first) == len(ids) else np.maximum.reduceat(found[:, by_id], first, axis=1)
                    cut = np.partition(best, len(first) - top, axis=1)[:, len(first) - top]
                    a, b = np.nonzero((found >= (cut - 1e-9 * (1 + np.abs(cut)))[:, None]) & (found > -np.inf))
                else:
                    a, b = np.nonzero(found > -np.inf)
                if not len(a):
                    continue
                held.append(best_of([(queries[a], ids[b], scores(q[a], x[b]))]))
                n += len(held[-1][0])
                if n > HELD_ROWS:
                    held = [best_of(held)]
                    n = len(held[0][0])
                    if n > HELD_ROWS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], ["query_id", "vec_id", "score"])
                        held, n = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in best_of(held)], ["query_id", "vec_id", "score"])

    pairs = index.join(probes, "at").select("ids", "vectors", "queries", "asked")
    return pairs.mapInArrow(compare, "query_id bigint, vec_id bigint, score double")


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def nearest(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", queries: str = "vec_id % 20 = 0", top: int = 20, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``rows`` that meet ``queries``, against all its other rows."""
    asked = F.expr(queries)
    usable_rows = usable(rows, key, vector).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), F.coalesce(asked, F.lit(False)).alias("asked"))
    facts = usable_rows.agg(F.count(F.lit(1)), F.max(squared_norm(F.col("v"))), F.max(F.size("v"))).first()
    n = facts[0]
    if not n:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    chance = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 30)) / float(1 << 30)
    sample = np.array([list(r["v"]) for r in usable_rows.where(chance < SAMPLE / n).select("v").limit(2 * SAMPLE).collect()], float)
    hashes = Hashes(facts[2], n, math.sqrt(facts[1]), _typical(sample, math.sqrt(facts[1]), top))
    kind = usable_rows.schema["v"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            for t, at in enumerate(np.floor(hashes.places(x, False)).astype(int)):
                yield pa.RecordBatch.from_arrays([pa.array([[t, *p] for p in at.tolist()], pa.list_(pa.int32())), batch.column(0), batch.column(1)], ["at", "id", "v"])

    placed = materialize(usable_rows.select("id", "v").mapInArrow(place, f"at array<int>, id bigint, v {kind}"))
    span = placed.groupBy(F.col("at")[0].alias("t")).agg(*[f(F.col("at")[i + 1]).alias(f"{f.__name__}{i}") for i in range(hashes.k) for f in (F.min, F.max)]).collect()
    low = {r["t"]: np.array([r[f"min{i}"] for i in range(hashes.k)]) for r in span}  # one row a table
    high = {r["t"]: np.array([r[f"max{i}"] for i in range(hashes.k)]) for r in span}

    def probes(some: DataFrame, target: float, tables: int) -> DataFrame:
        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                places = hashes.places(matrix(batch.column(1)), True)
                for t in range(tables):
                    at, who = [], []
                    for i in range(batch.num_rows):
                        for bucket in hashes.visits(places[t, i], low[t], high[t], target):
                            at.append([t, *bucket])
                            who.append(i)
                    who = pa.array(who, pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(at, pa.list_(pa.int32())), batch.column(0).take(who), batch.column(1).take(who)], ["at", "id", "v"])

        visited = some.select("id", "v").mapInArrow(visit, f"at array<int>, id bigint, v {kind}")
        return _blocks(materialize(visited), BLOCK_QUERIES, ["queries", "asked"])

    index = materialize(_blocks(placed, BLOCK_ROWS, ["ids", "vectors"]))
    all_queries = usable_rows.where("asked").dropDuplicates(["id"])
    best = materialize(_best(_search(index, probes(all_queries, target, TABLES), top), top))
    short = all_queries.join(best.where(F.col("rank") == top).select(F.col("query_id").alias("id")), "id", "left_anti")
    short = materialize(short)
    if not short.isEmpty():
        rest = _best(_search(index, probes(short, 2.0, 1), top), top)
        best = best.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").select("query_id", "rank", "vec_id", "score").union(rest.select("query_id", "rank", "vec_id", "score"))
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _typical(sample: np.ndarray, norm: float, top: int) -> float:
    """Median distance from sampled vectors, as queries, to their ``top``-th neighbour in the sample."""
    if len(sample) < 3:
        return norm
    squares = (sample * sample).sum(1)
    asked = sample[:256] * (norm / np.sqrt(squares[:256]))[:, None]
    away = np.sqrt(np.maximum(0, 2 * norm**2 - 2 * asked @ sample.T))
    return float(np.median(np.sort(away, 1)[:, min(top, len(sample) - 1)]))
