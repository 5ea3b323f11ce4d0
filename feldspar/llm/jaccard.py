"""N-gram Jaccard join by sizes: light sets by fixed-size subsets, heavy sets by inverted lists.

A document's set holds its distinct shingles of five words (with fewer words, the whole sequence as one). Documents
with equal sets are one class. For two sets of sizes a and b the threshold asks for an overlap of c(a, b); so light sets
that are similar share a subset of c elements, and all such subsets of a light set are listed. Sets above the boundary
are listed under their first elements in a common order, as many as make two similar sets share one (a prefix). The
order puts elements that many sets list last: a passage that thousands of documents share is then listed only by
documents that consist of such passages. The boundary is where listing subsets gets dearer than scanning lists, from the
sizes of all sets and the mean length of the lists.

Links of a list are found in two steps, so that a group of g near copies costs g comparisons, not g squared. First each
class is compared with two pivots of its list and of its band of sizes. Then only pairs of different components that share a list and whose sizes
permit a link are compared. A pair is first held against signatures (parities of hashed elements), which rule out only
what cannot reach the threshold; what is left is compared by both texts. These are exact. What is linked is complete: components are those
of all pairs that reach the threshold. The number of frequent elements kept for the order is bounded, which costs time
only, never links.

Words, shingles and sets are named by 64-bit hashes. Null, empty and wordless texts have an empty set and link with
nothing; null ids take part but are never a component's id unless all its ids are null. Equal rows are copies of one
class. An empty table gives an empty result. Only the id and text columns of the input are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspar.llm.graph import components, identified
from feldspar.llm.words import mixed, word_hashes
from feldspar.llm.storage import materialize, small_batches

WORDS, PERCENT = 5, 80
#: Elements that this many texts of every SHARE-th text hold come last in the order, up to so many elements (8 bytes each).
FREQUENT, SHARE, FREQUENT_MOST = 3, 16, 400_000
#: Longer lists are compared in blocks of so many sets, within tasks.
LONG_LIST, BLOCK_SETS = 48, 128
#: Sets of more elements are heavy whatever the costs say.
LIGHT_MOST = 14
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
#: Bits of a set's signature.
BITS = 1024


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a whole text."""
    octets = (text or "").encode("utf-8", "surrogatepass")
    h = word_hashes(octets)
    if len(h) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(octets.lower().split()), WORDS)], np.uint64) if len(h) else np.empty(0, np.uint64)
    n = len(h) - WORDS + 1
    total = h[:n] * _FACTORS[0]
    for i in range(1, WORDS):
        total += h[i : i + n] * _FACTORS[i]
    return np.unique(mixed(total))


def signature(elements: np.ndarray) -> np.ndarray:
    """BITS bits, each the parity of the elements that fall on it: two signatures differ in no more bits than the sets in elements."""
    odd = np.bincount((elements >> np.uint64(20)).astype(np.int64) % BITS, minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def set_name(elements: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(elements.tobytes(), len(elements)))))


def overlap(a: int, b: int, percent: int = PERCENT) -> int:
    """Smallest overlap of two sets of these sizes with 100 * overlap >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def prefix(a: int, percent: int = PERCENT) -> int:
    """Elements of a set of size a of which one is shared with any similar set's prefix."""
    return a - -(-percent * a // 100) + 1


def partners(a: int, percent: int = PERCENT) -> range:
    """Sizes of sets that a set of size a can be similar to."""
    return range(max(1, -(-percent * a // 100)), 100 * a // percent + 1)


def subset_sizes(a: int, boundary: int) -> list[int]:
    """Sizes of the subsets that a light set of size a is listed under."""
    return sorted({overlap(a, b) for b in partners(a) if b <= boundary})


def boundary_of(sizes: dict[int, int], list_length: float) -> int:
    """The largest size of a light set: least sum of subsets listed and of lists scanned."""
    subsets = lambda s, x: sum(math.comb(s, c) for c in subset_sizes(s, x))
    scanned = lambda s: prefix(s) * (1 + list_length)
    costs = {}
    for x in range(LIGHT_MOST + 1):
        edge = min(partners(x + 1), default=1)
        costs[x] = sum(n * ((subsets(s, x) if s <= x else 0) + (scanned(s) if s > x or s >= edge else 0)) for s, n in sizes.items() if s <= 2 * LIGHT_MOST)
    return min(costs, key=lambda x: (costs[x], x))


def _listed(elements: np.ndarray, frequent: np.ndarray, boundary: int) -> np.ndarray:
    """Names of the lists that a set belongs to."""
    n, out = len(elements), []
    if n <= boundary:
        for c in subset_sizes(n, boundary):
            out += [xxhash.xxh3_64_intdigest(b"".join(s), c) for s in combinations([e.tobytes() for e in elements], c)]
    if n > boundary or n >= min(partners(boundary + 1)):
        common = np.zeros(n, bool)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, elements), len(frequent) - 1)
            common = frequent[at] == elements
        order = np.concatenate([elements[~common], elements[common]])
        out = np.concatenate([np.array(out, np.uint64), order[: prefix(n)]])
    return np.asarray(out, np.uint64).view(np.int64)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Sets of the different texts of a partition's batches."""
    seen: set[int] = set()
    for batch in batches:
        for t in batch.column(0).to_pylist():
            name = xxhash.xxh3_64_intdigest((t or "").encode("utf-8", "surrogatepass"))
            if name not in seen:
                seen.add(name)
                elements = shingles(t)
                if len(elements):
                    yield elements


def _flush(columns: list[list[np.ndarray]], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names)


def sets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n, k, bits): size, name and signature of every row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                found = [shingles(t) for t in some.column(1).to_pylist()]
                bits = np.concatenate([signature(x) for x in found])
                bits = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * (BITS // 64), pa.int32()), pa.array(bits))
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array([len(x) for x in found], pa.int64()), pa.array([set_name(x) for x in found], pa.int64()), bits], ["id", "n", "k", "bits"])

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "id bigint, n bigint, k bigint, bits array<bigint>")


def _frequent(texts: DataFrame) -> tuple[np.ndarray, float]:
    """The elements that most sets hold, sorted, and the mean number of sets of the others; from a share of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, n = [], 0
        for elements in _texts(batches):
            some.append(elements)
            n += len(elements)
            if n > 1_000_000:
                yield counted(some)
                some, n = [], 0
        if some:
            yield counted(some)

    def counted(some: list[np.ndarray]) -> pa.RecordBatch:
        e, n = np.unique(np.concatenate(some), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(e.view(np.int64)), pa.array(n.astype(np.int32))], ["e", "n"])

    share = texts.where(F.pmod(F.xxhash64("text"), F.lit(SHARE)) == 0)
    counts = share.mapInArrow(run, "e bigint, n int").groupBy("e").agg(F.sum("n").alias("n"))
    mean = F.avg(F.when(F.col("n") < FREQUENT, F.col("n")))
    counts = materialize(counts.where("n > 1"))
    rows = counts.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "e").limit(FREQUENT_MOST).toPandas()["e"].to_numpy(np.int64)
    return np.sort(rows.view(np.uint64)), float(counts.agg(mean).first()[0] or 1.0)


def _lists(texts: DataFrame, frequent: np.ndarray, boundary: int) -> DataFrame:
    """(e, k, n): every set in the lists it belongs to, lists of one set left out."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(frequent)  # at most FREQUENT_MOST numbers

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for elements in _texts(batches):
            e = _listed(elements, shared.value, boundary)
            yield e, set_name(elements), len(elements)

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, n = [], 0
        for e, _, _ in listed(batches):
            some.append(e)
            n += len(e)
            if n > 200_000:
                yield _flush([some], ["e"])
                some, n = [], 0
        if some:
            yield _flush([some], ["e"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, n = ([], [], []), 0
        for e, k, size in listed(batches):
            for c, x in zip(some, (e, np.full(len(e), k, np.int64), np.full(len(e), size, np.int32))):
                c.append(x)
            n += len(e)
            if n > 200_000:
                yield _flush(list(some), ["e", "k", "n"])
                some, n = ([], [], []), 0
        if n:
            yield _flush(list(some), ["e", "k", "n"])

    more = texts.mapInArrow(names, "e bigint").groupBy("e").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("e")
    return materialize(texts.mapInArrow(rows, "e bigint, k bigint, n int").join(more, "e").distinct())


def _possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that sizes and signatures do not rule out: what differs in more bits differs in more elements."""

    def apart(x: pa.Array, y: pa.Array) -> pa.Array:
        x, y = (c.flatten().to_numpy().view(np.uint64).reshape(-1, BITS // 64) for c in (x, y))
        return pa.array(np.bitwise_count(x ^ y).sum(1).astype(np.int64))

    left = classes.select(F.col("k").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    right = classes.select(F.col("k").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    told = pairs.join(left, "a").join(right, "b").where(f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)")
    both = F.expr(f"(n_a + n_b) - 2 * ceil({PERCENT} * (n_a + n_b) / {100 + PERCENT})")
    return told.where(F.arrow_udf(apart, "bigint")("bits_a", "bits_b") <= both).select("a", "b")


def _verified(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                hits, last = [], (None, None)
                for i, (a, x, y) in enumerate(zip(some.column(0).to_pylist(), some.column(2).to_pylist(), some.column(3).to_pylist())):
                    if last[0] != a:
                        last = (a, shingles(x))
                    if similar(last[1], shingles(y)):
                        hits.append(i)
                at = pa.array(hits, pa.int64())
                yield pa.RecordBatch.from_arrays([some.column(0).take(at), some.column(1).take(at)], ["a", "b"])

    left = bodies.select(F.col("k").alias("a"), F.col("text").alias("x"))
    right = bodies.select(F.col("k").alias("b"), F.col("text").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def set_links(docs: DataFrame, classes: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Links (a, b: names of sets) that connect every component; ``classes`` has k, n, bits and one id of each set."""
    texts = docs.select(F.col(text).cast("string").alias("text")).where("text is not null")
    sizes = {r["n"]: r["m"] for r in classes.where(F.col("n") <= 2 * LIGHT_MOST).groupBy("n").agg(F.count(F.lit(1)).alias("m")).collect()}
    frequent, mean = _frequent(texts)
    lists = _lists(texts, frequent, boundary_of(sizes, mean))

    # Sizes of one band permit a link; the first and the last class of a list and band are its pivots.
    lists = lists.withColumn("band", F.floor(F.log("n") / math.log(100 / PERCENT)))
    pivots = lists.groupBy("e", "band").agg(F.min("k").alias("p"), F.max("k").alias("q")).where("p <> q")
    pivoted = lists.join(pivots, ["e", "band"])
    near = pivoted.select(F.explode(F.array(F.struct(F.col("p").alias("a"), F.col("k").alias("b")), F.struct(F.col("k").alias("a"), F.col("q").alias("b")))).alias("x")).select("x.*")
    near = materialize(near.where("a <> b").distinct())
    first = _links(docs, near, classes, key, text)
    parts = components(first)

    # In a long list, each set is first compared with the likeliest one only of each block: in a group of near copies that
    # joins nearly all that the pivots left apart, so that what is left below does not grow with the group's square.
    told = _apart(lists, parts)
    likeliest = materialize(_in_blocks(told.where(F.col("m") > LONG_LIST), classes, True).distinct().join(near, ["a", "b"], "left_anti"))
    if not likeliest.isEmpty():
        first = materialize(first.union(_links(docs, likeliest, classes, key, text)))
        told = _apart(lists, components(first))
        near = near.union(likeliest)

    # What a list still holds in different components is compared pair by pair, within the sizes that permit a link.
    short = told.where(F.col("m") <= LONG_LIST)
    other = short.select("e", F.col("k").alias("b"), F.col("n").alias("n_b"), F.col("g").alias("g_b"))
    rest = short.withColumnRenamed("k", "a").join(other, "e").where(f"a < b and g <> g_b and 100 * least(n, n_b) >= {PERCENT} * greatest(n, n_b)").select("a", "b").distinct()
    rest = rest.union(_in_blocks(told.where(F.col("m") > LONG_LIST), classes, False)).distinct()
    return first.union(_links(docs, rest.join(near, ["a", "b"], "left_anti"), classes, key, text))


def _apart(lists: DataFrame, parts: DataFrame) -> DataFrame:
    """(e, k, n, g: component, m: sets of the list) of the lists that hold several components."""
    told = lists.join(parts.withColumnRenamed("node", "k"), "k", "left").select("e", "k", "n", F.coalesce("component", "k").alias("g"))
    open_lists = told.groupBy("e").agg(F.min("g").alias("x"), F.max("g").alias("y"), F.count(F.lit(1)).alias("m")).where("x <> y").select("e", "m")
    return materialize(told.join(open_lists, "e"))


def _in_blocks(told: DataFrame, classes: DataFrame, likeliest: bool) -> DataFrame:
    """(a, b) of different components in long lists that sizes and signatures do not rule out.

    Blocks of a list are compared within tasks; pairs that are ruled out are never rows. With ``likeliest`` a set of a block
    is given only the nearest signature of another component in the other block.
    """
    rows = told.join(classes.select("k", "bits"), "k").withColumn("part", F.pmod(F.xxhash64("k"), F.ceil(F.col("m") / BLOCK_SETS)))
    blocks = rows.groupBy("e", "part").agg(F.collect_list(F.struct("k", "n", "g", "bits")).alias("x"))
    blocks = materialize(blocks.select("e", "part", F.col("x.k").alias("k"), F.col("x.n").alias("n"), F.col("x.g").alias("g"), F.flatten("x.bits").alias("bits")))
    names = ["k", "n", "g", "bits"]
    left = blocks.select("e", "part", *[F.col(c).alias(f"{c}_a") for c in names])
    right = blocks.select("e", F.col("part").alias("part_b"), *[F.col(c).alias(f"{c}_b") for c in names])
    pairs = left.join(right, "e").where("part <= part_b").select(*[f"{c}_{o}" for o in "ab" for c in names])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                k_a, n_a, g_a, x, k_b, n_b, g_b, y = (c[i].values.to_numpy().astype(np.int64) for c in batch.columns)
                x, y = (z.view(np.uint64).reshape(-1, BITS // 64) for z in (x, y))
                both = n_a[:, None] + n_b[None, :]
                allowed = both - 2 * -(-PERCENT * both // (100 + PERCENT))
                fits = 100 * np.minimum(n_a[:, None], n_b[None, :]) >= PERCENT * np.maximum(n_a[:, None], n_b[None, :])
                apart = np.zeros(both.shape, np.int32)
                for w in range(BITS // 64):
                    apart += np.bitwise_count(x[:, None, w] ^ y[None, :, w])
                p, q = np.nonzero(fits & (apart <= allowed) & (g_a[:, None] != g_b[None, :]))
                if likeliest:
                    order = np.lexsort((apart[p, q], p))
                    p, first = np.unique(p, return_index=True)  # np.nonzero gives p in order
                    q = q[order][first]
                a, b = np.minimum(k_a[p], k_b[q]), np.maximum(k_a[p], k_b[q])
                found = np.unique(np.stack([a, b], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    return pairs.mapInArrow(compare, "a bigint, b bigint")


def _links(docs: DataFrame, pairs: DataFrame, classes: DataFrame, key: str, text: str) -> DataFrame:
    """The (a, b) of ``pairs`` that are similar: first by signatures, then by the texts of what is left."""
    pairs = materialize(_possible(pairs, classes))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct().join(classes.select("k", "id"), "k")
    return materialize(_verified(pairs, _bodies(docs, wanted, key, text)))


def _bodies(docs: DataFrame, wanted: DataFrame, key: str, text: str, most: int = 500_000) -> DataFrame:
    """(k, text) of one document of each wanted set, found by its id; the ids are broadcast if they are few."""
    wanted = materialize(wanted)
    few = wanted.count() <= most
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).where("text is not null")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [set_name(shingles(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), batch.column(0)], ["k", "text"])

    ids = wanted.where("id is not null").select("id").distinct()
    found = rows.join(F.broadcast(ids) if few else ids, "id").select("text").mapInArrow(name, "k bigint, text string")
    if not wanted.where("id is null").isEmpty():
        found = found.union(rows.where("id is null").select("text").mapInArrow(name, "k bigint, text string"))
    return materialize(found.join(wanted.select("k"), "k").groupBy("k").agg(F.first("text").alias("text")))


def link(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of ``docs``; kept: the row's id is its component's."""
    small_batches(docs.sparkSession)
    named = materialize(sets(docs, key, text))
    classes = materialize(named.where("n > 0").groupBy("k").agg(F.min("id").alias("id"), F.max("n").alias("n"), F.min("bits").alias("bits")))
    parts = components(set_links(docs, classes, key, text))
    told = classes.join(parts.select(F.col("node").alias("k"), "component"), "k", "left").select("k", "id", F.coalesce("component", "k").alias("g"))
    low = told.groupBy("g").agg(F.min("id").alias("component_id"))
    told = told.join(low, "g").select("k", "component_id")
    linked = named.where("n > 0").join(told, "k").select("id", "n", "component_id")
    out = linked.union(named.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


#: So many rows that go are broadcast; more are joined by a shuffle.
SENT_MOST = 1_000_000


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that have no similar document with a smaller id; of equal ids one row stays."""
    held = identified(docs, key)
    told = link(held.select("uid", F.col(f"doc.`{text}`").alias("text")), "uid", "text")
    gone = materialize(told.where("NOT kept").select("uid"))
    gone = F.broadcast(gone) if gone.count() <= SENT_MOST else gone
    return held.join(gone, "uid", "left_anti").select("doc.*")
