"""Substring dedup: passages of ``WINDOW`` words that an earlier document holds too are cut out, found by doubling lengths.

Windows are compared at 4, then 7, then 13 words. A stretch of 13 words can only be repeated in another document if each
shorter window in it is, so a level hands on to the next, about twice as long, just the stretches whose window was repeated
there; at 13 words what is left is decided. Below 13 words one window stands for a stretch: the one of the smallest hash,
which equal stretches choose alike and neighbouring ones mostly share, so a level moves a fraction of all windows.
Longer lengths could not change what 13-word windows cover.

Shape of the job, one Spark query: texts are shuffled once into batches (by a hash of id and text, about ``BATCH_BYTES``
each), and that exchange is read again by every level. A batch sends each distinct window once, however often it holds it,
as packed arrays to buckets by hash, and each bucket answers one bit per window: whether another document has it (4 and 7), or whether
a smaller id has it than the smallest in the batch (13). So a passage that a third of all documents share is one entry per
batch, never a group of rows, and no text or position leaves its batch. With more batches than windows per batch and
bucket the arrays get short, and the moved bytes a window grow from about 9 to some 40.

Windows of 4 and 7 words are named by 63 bits (a collision only costs time), those of 13 by 96 bits.

Defined cases: null and empty texts, and texts below 13 words, keep all their words. Ids are whole numbers; a null id counts
as larger than all others. Rows of the same id do not remove each other's words. Repeated rows give a row each. Words
are kept joined by one space. An empty table gives an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feldspar.llm.storage import small_batches
from feldspar.llm.words import mixed, word_hashes

WINDOW = 13
LEVELS = (4, 7, 13)
#: Text that one task of a level holds, and text whose windows meet in one bucket. Long documents may exceed the first.
BATCH_BYTES = 8 << 20
BUCKET_BYTES = 32 << 20
#: Neither holds less than this for the sake of more tasks: their product is the number of arrays.
LEAST_BYTES = 1 << 20
_PARTS = "bucket long, batch long, blob binary"
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _windows(h: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """One hash for every ``length`` consecutive word hashes."""
    n = max(len(h) - length + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(length):
        out = out * base + h[j : j + n]
    return mixed(out)


def _smallest(v: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` consecutive values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        v = np.minimum(v[:-step], v[step:])
        done += step
    return v


class _Batch:
    """The documents of one batch in order of id, and the stretches of WINDOW words in them."""

    def __init__(self, table: pa.Table):
        keys, owners, texts = (table.column(c).to_pylist() for c in ("key", "owner", "text"))
        order = sorted(range(len(keys)), key=lambda i: (owners[i], texts[i]))
        self.keys, self.texts = [keys[i] for i in order], [texts[i] for i in order]
        owners = np.array([owners[i] for i in order], np.int64)
        hashes = [word_hashes(t, exact=True) for t in self.texts]
        self.sizes = np.array([len(h) for h in hashes], np.int64)
        self.h = np.concatenate([*hashes, np.empty(0, np.uint64)])
        n = max(len(self.h) - WINDOW + 1, 0)
        doc = np.repeat(np.arange(len(hashes)), self.sizes)
        self.inside = doc[:n] == doc[WINDOW - 1 :] if n else np.empty(0, bool)
        self.owner = owners[doc[:n]]
        self.doc = doc[:n]

    def entries(self, level: int, candidates: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct windows of the candidate stretches: name, second name, smallest owner, in several documents; and each candidate's window."""
        length, at = LEVELS[level], np.flatnonzero(candidates)
        last = length == WINDOW
        if not len(at):
            return (*(np.empty(0, t) for t in (np.uint64, np.uint32, np.int64, bool)), at)
        # Mixed again, for the smallest of several hashes are not spread evenly over the buckets.
        name = mixed(_smallest(_windows(self.h, length, _BASES[0]), WINDOW - length + 1)[at])
        check = (_windows(mixed(self.h), length, _BASES[1])[at] >> np.uint64(32)).astype(np.uint32) if last else None
        doc, owner = self.doc[at], self.owner[at]
        # Neighbouring stretches of a document mostly have the same smallest window.
        new = np.ones(len(at), bool)
        if not last:
            new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
        which = np.cumsum(new) - 1
        name, doc, owner = name[new], doc[new], owner[new]
        order = np.lexsort((check, name)) if last else np.argsort(name, kind="stable")
        sorted_name = name[order]
        first = np.ones(len(order), bool)
        first[1:] = sorted_name[1:] != sorted_name[:-1]
        if last:
            check = check[order]
            first[1:] |= check[1:] != check[:-1]
        group = np.cumsum(first) - 1
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(order)) - 1
        window = np.empty(len(order), np.int64)
        window[order] = group
        several = doc[order[ends]] != doc[order[starts]]
        check = check[starts] if last else np.zeros(len(starts), np.uint32)
        return sorted_name[starts], check, owner[order[starts]], several, window[which]


def _pack(values: np.ndarray) -> bytes:
    """The bytes of numbers by significance, so that equal high bytes lie together."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unpack(blob: bytes, kind, n: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(blob, np.uint8, n * width).reshape(width, n).T.copy().view(kind).reshape(n)


def _bucket_cuts(name: np.ndarray, buckets: int) -> np.ndarray:
    """Names are sorted, and buckets are equal ranges of their upper 32 bits."""
    edges = (np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(buckets)
    cuts = np.searchsorted(name >> np.uint64(32), edges)
    return cuts


def _send(batch: _Batch, number: int, level: int, candidates: np.ndarray, buckets: int) -> pa.Table:
    """A row per bucket with the batch's windows, and one with the candidates, which comes back unread."""
    name, check, owner, several, _ = batch.entries(level, candidates)
    cuts = _bucket_cuts(name, buckets)
    full = np.flatnonzero(np.diff(cuts))
    blobs = []
    for b in full:
        part = slice(cuts[b], cuts[b + 1])
        if LEVELS[level] == WINDOW:
            blobs.append(_pack(name[part]) + _pack(check[part]) + _pack(owner[part]))
        else:
            blobs.append(((name[part] & ~np.uint64(1)) | several[part]).tobytes())
    return _rows([*full.tolist(), -1 - number], [number] * (len(full) + 1), [*blobs, np.packbits(candidates).tobytes()])


def _rows(buckets: list[int], batches: list[int], blobs: list[bytes]) -> pa.Table:
    return pa.table({"bucket": pa.array(buckets, pa.int64()), "batch": pa.array(batches, pa.int64()), "blob": pa.array(blobs, pa.binary())})


def _answer(table: pa.Table, last: bool) -> pa.Table:
    """One bit for each window of each batch in a bucket."""
    buckets, batches, blobs = (table.column(c).to_pylist() for c in ("bucket", "batch", "blob"))
    if buckets[0] < 0:
        return table
    width = 20 if last else 8
    sizes = [len(b) // width for b in blobs]
    if last:
        names = np.concatenate([_unpack(b, np.uint64, n) for b, n in zip(blobs, sizes)])
        checks = np.concatenate([_unpack(b[8 * n :], np.uint32, n) for b, n in zip(blobs, sizes)])
        owners = np.concatenate([_unpack(b[12 * n :], np.int64, n) for b, n in zip(blobs, sizes)])
        order = np.lexsort((owners, checks, names))
        names, checks, owners = names[order], checks[order], owners[order]
        first = np.ones(len(order), bool)
        first[1:] = (names[1:] != names[:-1]) | (checks[1:] != checks[:-1])
        hit = owners > owners[first][np.cumsum(first) - 1]
    else:
        values = np.concatenate([np.frombuffer(b, np.uint64) for b in blobs])
        order = np.argsort(values, kind="stable")
        names = values[order] >> np.uint64(1)
        hit = (values[order] & np.uint64(1)).astype(bool)
        same = names[1:] == names[:-1]
        hit[1:] |= same
        hit[:-1] |= same
    bits = np.empty(len(order), bool)
    bits[order] = hit
    ends = np.cumsum(sizes)
    return _rows(buckets, batches, [np.packbits(bits[e - n : e]).tobytes() for e, n in zip(ends, sizes)])


def _survivors(batch: _Batch, level: int, answers: pa.Table, buckets: int):
    """Candidates the level began with, its windows of them, and the answer to each window."""
    got = dict(zip(answers.column("bucket").to_pylist(), answers.column("blob").to_pylist()))
    state = next(b for k, b in got.items() if k < 0)
    candidates = np.unpackbits(np.frombuffer(state, np.uint8), count=len(batch.inside)).astype(bool)
    name, _, owner, _, window = batch.entries(level, candidates)
    cuts = _bucket_cuts(name, buckets)
    hit = [np.unpackbits(np.frombuffer(got[b], np.uint8), count=cuts[b + 1] - cuts[b]) for b in np.flatnonzero(np.diff(cuts)).tolist()]
    return candidates, owner, window, np.concatenate([*hit, np.empty(0, np.uint8)]).astype(bool)


def _kept(batch: _Batch, answers: pa.Table, buckets: int, names: list[str], types: list[pa.DataType]) -> pa.Table:
    """The words of each document that no repeated window covers."""
    candidates, smallest, window, elsewhere = _survivors(batch, len(LEVELS) - 1, answers, buckets)
    at = np.flatnonzero(candidates)
    at = at[elsewhere[window] | (smallest[window] < batch.owner[at])]
    edges = np.zeros(len(batch.h) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + WINDOW, -1)
    gone = np.cumsum(edges[:-1]) > 0
    texts, removed, begin = [], [], 0
    for text, n in zip(batch.texts, batch.sizes.tolist()):
        words, mine = text.split(), gone[begin : begin + n]
        removed.append(int(mine.sum()))
        texts.append(b" ".join([words[i] for i in np.flatnonzero(~mine).tolist()] if removed[-1] else words).decode())
        begin += n
    columns = [batch.keys, batch.sizes.tolist(), removed, texts]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, kept): every word covered by 13 words that also start in a document of a smaller id is gone."""
    spark = docs.sparkSession
    small_batches(spark)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    batches, buckets = (max(size // most, min(2 * parts, size // LEAST_BYTES), 1) for most in (BATCH_BYTES, BUCKET_BYTES))
    whole = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(key).cast("long"), F.lit(2**63 - 1)).alias("owner"), whole.alias("text"))
    rows = rows.withColumn("batch", F.pmod(F.xxhash64("key", "text"), F.lit(batches))).repartition(parts, "batch")

    out = T.StructType([T.StructField("key", docs.schema[key].dataType), *T._parse_datatype_string("n_words long, n_removed long, kept string").fields])
    types = [pa.int64() if isinstance(out[0].dataType, T.LongType) else pa.int32(), pa.int64(), pa.int64(), pa.string()]

    def begin(number, table):
        batch = _Batch(table)
        return _send(batch, number[0].as_py(), 0, batch.inside, buckets)

    def further(level):
        def send(number, table, answers):
            batch = _Batch(table)
            candidates, _, window, hit = _survivors(batch, level - 1, answers, buckets)
            candidates[np.flatnonzero(candidates)[~hit[window]]] = False
            return _send(batch, number[0].as_py(), level, candidates, buckets)

        return send

    def finish(number, table, answers):
        return _kept(_Batch(table), answers, buckets, out.names, types)

    def answered(sent, level):
        last = LEVELS[level] == WINDOW
        return sent.groupBy("bucket").applyInArrow(lambda table: _answer(table, last), _PARTS)

    sent = rows.groupBy("batch").applyInArrow(begin, _PARTS)
    for level in range(1, len(LEVELS)):
        sent = rows.groupBy("batch").cogroup(answered(sent, level - 1).groupBy("batch")).applyInArrow(further(level), _PARTS)
    answers = answered(sent, len(LEVELS) - 1)
    return rows.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(finish, out).withColumnRenamed("key", key)
