"""Embedding near-duplicates: dual traversal of cover trees, exact above a cosine threshold.

On unit vectors a cosine is a distance, so that a pair of tree nodes whose centres lie further apart than the threshold
distance and both covering radii holds no link, and one whose centres and radii together stay below it holds links only.
The upper tree is made of centres from a bounded sample, taken per group with halving distances between them; every
vector goes to its nearest centre, and the covering radii are taken over all vectors. Pairs of these nodes are pruned in
a join of their few centres. A node is laid out in blocks of bounded size. A task gets a pair of blocks, builds the
lower trees (nested levels with halving radii) and traverses both at once; it hands on link counts and at most a
spanning tree of the links, never a list of pairs, so that dense groups cost no more rows than loose ones.

Equal vectors of a group are one node with a number of copies. Vectors link within their group only and with equal
lengths only; null groups, null ids and vectors that are null, zero or hold null or non-finite components link with
nothing and get their own row (component: their own id). A repeated id with equal vectors counts as copies. An empty
table gives an empty result. Only the id, vector and group columns of the input are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspar.llm.graph import components
from feldspar.llm.vectors import is_usable, matrix
from feldspar.llm.storage import materialize

THRESHOLD = 0.93
#: Vectors of a block, rows of the sample that centres are taken from, and vectors of a leaf in the lower trees.
BLOCK_ROWS, SAMPLE, LEAF = 768, 4096, 24
#: Bounds decide only beyond this margin; nearer ones are computed pair by pair.
MARGIN = 1e-7


class Tree:
    """Nested levels over unit vectors: each node's children cover it with half its radius, their centres lie further apart."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.centre, self.radius, self.points, self.children = [], [], [], []
        far = np.sqrt(np.maximum(0, 2 - 2 * (x @ x[0])))
        self._add(np.arange(len(x)), 0, far)

    def _add(self, points: np.ndarray, centre: int, away: np.ndarray) -> int:
        node = len(self.centre)
        radius = float(away.max())
        self.centre.append(centre)
        self.radius.append(radius)
        self.points.append(points)
        self.children.append([])
        if len(points) > LEAF and radius > 1e-6:
            children, left = [], points
            while len(left):
                d = np.sqrt(np.maximum(0, 2 - 2 * (self.x[left] @ self.x[left[0]])))
                inside = d <= radius / 2
                inside[0] = True
                children.append(self._add(left[inside], int(left[0]), d[inside]))
                left = left[~inside]
            self.children[node] = children
        return node


def links(a: Tree, b: Tree, same: bool, weights_a: np.ndarray, weights_b: np.ndarray, threshold: float = THRESHOLD):
    """Link counts of both sides (``same``: of one side, without itself) and a spanning set of links as (i, j)."""
    reach = float(np.sqrt(2 - 2 * threshold))
    count_a, count_b = np.zeros(len(a.x), np.int64), np.zeros(len(b.x), np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    todo = [([0], [0])]
    while todo:
        left, right = todo.pop()
        left, right = np.array(left), np.array(right)
        ca, cb = np.array([a.centre[i] for i in left]), np.array([b.centre[i] for i in right])
        ra, rb = np.array([a.radius[i] for i in left]), np.array([b.radius[i] for i in right])
        d = np.sqrt(np.maximum(0, 2 - 2 * (a.x[ca] @ b.x[cb].T)))
        near = d <= reach + ra[:, None] + rb[None, :] + MARGIN
        inside = d + ra[:, None] + rb[None, :] <= reach - MARGIN
        for i, j in zip(*np.nonzero(near)):
            m, n = int(left[i]), int(right[j])
            p, q = a.points[m], b.points[n]
            if inside[i, j]:
                count_a[p] += weights_b[q].sum()
                count_b[q] += weights_a[p].sum()
                if same:
                    both = np.intersect1d(p, q)
                    count_a[both] -= weights_a[both]
                found.append((p, np.full(len(p), q[0])))
                found.append((np.full(len(q), p[0]), q))
            elif not a.children[m] and not b.children[n]:
                hit = a.x[p] @ b.x[q].T >= threshold
                if same:
                    hit &= p[:, None] != q[None, :]
                if hit.any():
                    count_a[p] += hit @ weights_b[q]
                    count_b[q] += hit.T @ weights_a[p]
                    s, t = np.nonzero(hit)
                    found.append((p[s], q[t]))
            else:
                todo.append((a.children[m] or [m], b.children[n] or [n]))
    return count_a, count_b, found


def _spanning(found: list, size_a: int, size_b: int, same: bool) -> list[tuple[int, int]]:
    """Enough of the links to connect what they connect; indexes of side b come after those of side a."""
    parent = list(range(size_a + (0 if same else size_b)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for p, q in found:
        for i, j in zip(p.tolist(), q.tolist()):
            j += 0 if same else size_a
            x, y = root(i), root(j)
            if x != y:
                parent[x] = y
                out.append((i, j))
    return out


def _centres(sample: dict, sizes: dict) -> dict:
    """Centres of each group: sampled vectors at halving distances, about one per block of rows."""
    out = {}
    for g, x in sample.items():
        wanted, chosen, apart = max(1, -(-sizes[g] // BLOCK_ROWS)), [0], 1.0
        away = np.sqrt(np.maximum(0, 2 - 2 * (x @ x[0])))
        while len(chosen) < min(wanted, len(x)) and apart > 1e-3:
            i = int(np.argmax(away > apart)) if (away > apart).any() else None
            if i is None:
                apart /= 2
                continue
            chosen.append(i)
            away = np.minimum(away, np.sqrt(np.maximum(0, 2 - 2 * (x @ x[i]))))
        out[g] = x[chosen]
    return out


def link(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", group: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """(key, n_links, component_id, kept) for every row: direct links, and the smallest key reachable by links."""
    taking = is_usable(key, vector) & F.col(group).isNotNull()
    rows = rows.select(F.col(key).cast("long").alias("id"), F.col(group).alias("g"), F.col(vector).alias("v"), taking.alias("takes"))
    named = rows.where("takes").select("id", "v", F.struct("g", F.size("v").alias("d")).alias("g"))
    named = named.withColumns({"h1": F.xxhash64("g", "v"), "h2": F.xxhash64(F.lit("second"), "v", "g")})
    kind, kind_of_group = (named.schema[c].dataType.simpleString() for c in ("v", "g"))
    classes = materialize(named.groupBy("h1", "h2").agg(F.min("id").alias("c"), F.count(F.lit(1)).alias("n"), F.min("g").alias("g"), F.min("v").alias("v")))

    sizes = {r["g"]: r["n"] for r in classes.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy(F.desc("n")).limit(SAMPLE).collect()}
    total = sum(sizes.values())
    sample: dict = {}
    if total:
        chance = F.pmod(F.xxhash64(F.lit("sample"), "h1"), F.lit(1 << 30)) / float(1 << 30)
        for r in classes.where(chance < SAMPLE / total).select("g", "v").limit(2 * SAMPLE).collect():
            if r["g"] in sizes:
                sample.setdefault(r["g"], []).append(r["v"])
    unit = lambda x: x / np.sqrt((x * x).sum(-1, keepdims=True))
    centres = _centres({g: unit(np.array(v, float)) for g, v in sample.items()}, sizes)
    names = {(g["g"], g["d"]): x for g, x in centres.items()}

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Nearest centre and the distance to it; groups without centres are one node around nothing."""
        for batch in batches:
            node, away = np.zeros(batch.num_rows, np.int64), np.full(batch.num_rows, 2.0)
            of = [(x["g"], x["d"]) for x in batch.column(0).to_pylist()]
            for g in set(of):
                if g in names:
                    at = np.array([i for i, x in enumerate(of) if x == g])
                    dots = unit(matrix(batch.column(3).take(pa.array(at)))) @ names[g].T
                    node[at] = dots.argmax(1)
                    away[at] = np.sqrt(np.maximum(0, 2 - 2 * dots.max(1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node), pa.array(away)], ["g", "c", "n", "v", "node", "away"])

    routed = classes.select("g", "c", "n", "v").mapInArrow(route, f"g {kind_of_group}, c bigint, n bigint, v {kind}, node bigint, away double")
    routed = materialize(routed)
    nodes = routed.groupBy("g", "node").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("size"))
    nodes = materialize(nodes.withColumn("parts", F.ceil(F.col("size") / BLOCK_ROWS)))
    parted = routed.join(nodes.select("g", "node", "parts"), ["g", "node"]).withColumn("part", F.pmod(F.xxhash64("c"), F.col("parts")))
    blocks = parted.groupBy("g", "node", "part").agg(F.collect_list(F.struct("c", "n", "v")).alias("rows"))
    blocks = materialize(blocks.select("g", "node", "part", *[F.col(f"rows.{c}").alias(c) for c in ("c", "n")], F.flatten("rows.v").alias("v")))

    reach = float(np.sqrt(2 - 2 * threshold))

    def apart(g: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        found = ((names.get((x["g"], x["d"])), i, j) for x, i, j in zip(g.to_pylist(), a.to_pylist(), b.to_pylist()))
        return pa.array([0.0 if x is None else float(np.sqrt(max(0.0, 2 - 2 * float(x[i] @ x[j])))) for x, i, j in found], pa.float64())

    # One row per centre (at most 2 * SAMPLE) and per group without any, where the two sides are the same row.
    left = nodes.select("g", F.col("node").alias("a"), F.col("radius").alias("radius_a"), "size")
    pairs = left.join(nodes.select("g", F.col("node").alias("b"), F.col("radius").alias("radius_b")), "g").where("a < b or (a = b and size > 1)")
    pairs = pairs.withColumn("apart", F.arrow_udf(apart, "double")("g", "a", "b")).where(F.col("apart") <= F.col("radius_a") + F.col("radius_b") + reach + MARGIN).select("g", "a", "b")
    both = pairs.join(blocks.select("g", "node", F.col("part").alias("part_a"), *[F.col(c).alias(f"{c}_a") for c in "cnv"]).withColumnRenamed("node", "a"), ["g", "a"])
    both = both.join(blocks.select("g", F.col("node").alias("b"), F.col("part").alias("part_b"), *[F.col(c).alias(f"{c}_b") for c in "cnv"]), ["g", "b"])
    both = both.where("a < b or part_a <= part_b").select((F.expr("a = b and part_a = part_b")).alias("same"), "c_a", "n_a", "v_a", "c_b", "n_b", "v_b")

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                same = batch.column(0)[k].as_py()
                c, n, x = [], [], []
                for o in (1,) if same else (1, 4):
                    c.append(batch.column(o)[k].values.to_numpy())
                    n.append(batch.column(o + 1)[k].values.to_numpy())
                    x.append(unit(batch.column(o + 2)[k].values.to_numpy().astype(np.float64).reshape(len(c[-1]), -1)))
                trees = [Tree(y) for y in x]
                found = links(trees[0], trees[-1], same, n[0], n[-1], threshold)
                ids = np.concatenate(c)
                counts = found[0] if same else np.concatenate(found[:2])
                edges = _spanning(found[2], len(c[0]), len(c[-1]), same)
                some = np.nonzero(counts)[0]
                ends = np.array(edges, np.int64).reshape(-1, 2)
                a = np.concatenate([ids[some], ids[ends[:, 0]]])
                b = pa.array(np.concatenate([ids[some], ids[ends[:, 1]]]))
                yield pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(np.concatenate([counts[some], np.zeros(len(ends), np.int64)]))], ["a", "b", "n"])

    found = materialize(both.mapInArrow(traverse, "a bigint, b bigint, n bigint"))
    counts = found.where("n > 0").groupBy(F.col("a").alias("c")).agg(F.sum("n").alias("more"))
    parts = components(found.where("n = 0").select("a", "b")).withColumnRenamed("node", "c")
    told = classes.select("h1", "h2", "c", "n").join(counts, "c", "left").join(parts, "c", "left")
    told = told.select("h1", "h2", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("component", "c").alias("component_id"))
    linked = named.select("id", "h1", "h2").join(told, ["h1", "h2"]).select("id", "n_links", "component_id")
    alone = rows.where(~F.col("takes")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.union(alone)
    return out.select(F.col("id").alias(key), F.col("n_links").cast("long").alias("n_links"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))

