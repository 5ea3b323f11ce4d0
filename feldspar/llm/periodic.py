"""Periodic runs of words: stretches that repeat one block of words at least twice, found at every scale of period.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and at least max(12, 2 q)
words that cannot be extended by a neighbouring word. Several documents are laid end to end with a number of its own
between any two, so all passes below are over arrays and no run crosses documents.

* Periods below 16 are too short for windows: each lag is compared directly over the whole array.
* Scale Q finds the periods from Q to 2 Q - 1. Every position carries the hash of its Q/2 words (a gram); of Q/2 neighbouring
  positions the smallest hashes, the minimizers, are kept. In a run two windows one period apart read the same words,
  so their minimizers are one period apart too: pairs of equal minimizers at distances of the scale are seeds, and comparing
  words to both sides of a seed gives its stretch.
* A gram that is periodic itself (at most half its length) would tie with its neighbours, so it is no minimizer. What it is
  follows from its words alone, hence is the same one period on. Were all grams of a run's first period like that,
  that period would lie in one run P of a shorter period p, and the next one in another such run that begins before
  P ends or where it ends. Those pairs of runs are seeds of their own: all periods q that bring them in step (one modulo p).

So nothing is missed. Seeds only propose: every run is read off the words themselves. A stretch found under several
multiples of its period is kept with the smallest. Equal grams that are no minimizer ties are at least a quarter of Q apart,
so the work is near n log n for n words; documents shorter than 2 Q leave before scale Q.

Documents are independent, so there is no shuffle and no hot key. A task holds about ``CHUNK_WORDS`` words at once, or one
document if that is longer (some 100 bytes a word).

Defined cases: null and empty texts and texts without words have no run and collapse to ''. Repeated rows and null ids
give a row each. An empty table gives an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feldspar.llm.storage import small_batches
from feldspar.llm.words import mixed

LEAST = 12
FIRST_SCALE = 16
CHUNK_WORDS = 1_000_000
_MOST = np.uint64(2**64 - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
RUNS = "array<struct<start:long,length:long,period:long>>"


def runs_of(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows (start, length, period), sorted, of all runs of ``x``: documents of ``sizes`` words, each followed by a number that occurs nowhere else."""
    found = [_lagged(x, lag) for lag in range(1, min(FIRST_SCALE, len(x)))]
    known = _smallest(np.concatenate(found)) if found else np.empty((0, 3), np.int64)
    scale, at = FIRST_SCALE, np.arange(len(x))
    gram, width = mixed(x.astype(np.uint64)), 1
    while len(sizes) and sizes.max() >= 2 * scale:
        if sizes.min() < 2 * scale:
            stay = np.repeat(sizes >= 2 * scale, sizes + 1)
            stay_grams = stay[: len(gram)]
            at, gram, sizes = at[stay], gram[stay_grams], sizes[sizes >= 2 * scale]
        while width < scale // 2:
            gram = mixed(gram[:-width] * _ODD + gram[width:])
            width *= 2
        seeds = np.concatenate([_minimizer_seeds(gram, at, known, scale), _neighbour_seeds(x, known, scale)])
        known = _smallest(np.concatenate([known, _extended(x, seeds)]))
        scale *= 2
    return known[known[:, 1] >= LEAST]


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First positions and lengths of the stretches of consecutive numbers in ``same``."""
    if not len(same):
        return same, same
    first = np.flatnonzero(np.concatenate([[True], np.diff(same) != 1]))
    return same[first], np.diff(np.append(first, len(same)))


def _lagged(x: np.ndarray, lag: int) -> np.ndarray:
    """Stretches of period ``lag`` with two periods and 8 words at least: what a gram of the first scale can lie in."""
    start, equal = _stretches(np.flatnonzero(x[lag:] == x[:-lag]))
    enough = equal + lag >= max(FIRST_SCALE // 2, 2 * lag)
    return np.stack([start[enough], equal[enough] + lag, np.full(enough.sum(), lag)], 1)


def _smallest(runs: np.ndarray) -> np.ndarray:
    """One row per stretch, with its smallest period, by start."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    return runs[new]


def _slide(v: np.ndarray, width: int, best) -> np.ndarray:
    step = 1
    while step < width:
        v = best(v[:-step], v[step:])
        step *= 2
    return v


def _minimizer_seeds(gram: np.ndarray, at: np.ndarray, known: np.ndarray, scale: int) -> np.ndarray:
    """(position, distance) of equal minimizers that are ``scale`` to 2 ``scale`` - 1 apart."""
    width = scale // 2
    inner = known[(known[:, 2] <= width // 2) & (known[:, 1] >= width)]
    first = np.searchsorted(at, inner[:, 0])
    here = first < len(at)
    here[here] = at[first[here]] == inner[here, 0]
    first, last = first[here], first[here] + inner[here, 1] - width + 1
    edges = np.zeros(len(gram) + 1, np.int64)
    np.add.at(edges, first, 1)
    np.add.at(edges, last, -1)
    value = np.where(np.cumsum(edges[:-1]) > 0, _MOST, gram)
    if len(value) < width:
        return np.empty((0, 2), np.int64)
    lowest = np.pad(_slide(value, width, np.minimum), width - 1)
    chosen = np.flatnonzero((_slide(lowest, width, np.maximum) == value) & (value != _MOST))
    kept, seeds, ahead = value[chosen], [np.empty((0, 2), np.int64)], 1
    left = np.arange(len(chosen) - 1)
    while len(left):
        apart = chosen[left + ahead] - chosen[left]
        near = apart < 2 * scale
        left, apart = left[near], apart[near]
        hit = (apart >= scale) & (kept[left] == kept[left + ahead])
        seeds.append(np.stack([at[chosen[left[hit]]], apart[hit]], 1))
        ahead += 1
        left = left[left + ahead < len(chosen)]
    return np.concatenate(seeds)


def _neighbour_seeds(x: np.ndarray, known: np.ndarray, scale: int) -> np.ndarray:
    """(position, distance) that bring two overlapping or touching runs of the same, much shorter period in step."""
    inner = known[(known[:, 2] <= scale // 4) & (known[:, 1] >= scale)]
    inner = inner[np.lexsort((inner[:, 0], inner[:, 2]))]
    seeds = []
    touch = (inner[1:, 2] == inner[:-1, 2]) & (inner[1:, 0] <= inner[:-1, 0] + inner[:-1, 1])
    for i in np.flatnonzero(touch):
        (a, n, p), (b, m, _) = inner[i].tolist(), inner[i + 1].tolist()
        turn = _turn(x[a : a + p], x[b : b + p])
        if turn is None:
            continue
        most = min(n, m, (b + m - a) // 2, 2 * scale - 1)
        first = scale + (b - a - turn - scale) % p
        seeds += [(max(a, b - q), q) for q in range(first, most + 1, p)]
    return np.array(seeds, np.int64).reshape(-1, 2)


def _turn(u: np.ndarray, v: np.ndarray) -> int | None:
    """k so that v is u from place k on, followed by its first k."""
    twice, part = np.concatenate([u, u]).tobytes(), v.tobytes()
    k = twice.find(part)
    while k >= 0 and k % u.itemsize:
        k = twice.find(part, k + 1)
    return k // u.itemsize if k >= 0 else None


def _extended(x: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The stretches of two periods and LEAST words at least around seeds (position, distance)."""
    out, period, end = [], 0, 0
    for at, apart in seeds[np.lexsort((seeds[:, 0], seeds[:, 1]))].tolist():
        if apart == period and at < end:
            continue
        start = at - _equal(x[:at][::-1], x[: at + apart][::-1])
        period, end = apart, at + _equal(x[at:], x[at + apart :])
        if end - start >= max(period, LEAST - period):
            out.append((start, end - start + period, period))
    return np.array(out, np.int64).reshape(-1, 3)


def _equal(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading values are equal."""
    n, step, most = 0, 64, min(len(a), len(b))
    while n < most:
        different = a[n : min(n + step, most)] != b[n : min(n + step, most)]
        if different.any():
            return n + int(different.argmax())
        n, step = n + step, step * 4
    return most


def _found(texts: list[bytes | None]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words and runs (start within the document, length, period) of each text."""
    at = 0
    while at < len(texts):
        number, x, words = {}, [], []
        while at < len(texts) and len(x) < CHUNK_WORDS:
            words.append((texts[at] or b"").split())
            x += [number.setdefault(w, len(number)) for w in words[-1]]
            x.append(-len(words))
            at += 1
        sizes = np.array([len(w) for w in words])
        runs = runs_of(np.array(x, np.int64), sizes)
        begins = np.cumsum(sizes + 1) - sizes - 1
        cuts = np.searchsorted(runs[:, 0], np.append(begins, len(x)))
        for i, w in enumerate(words):
            mine = runs[cuts[i] : cuts[i + 1]] - [begins[i], 0, 0]
            yield w, mine[np.lexsort((mine[:, 2], mine[:, 0]))]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    if not len(runs):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()])


def collapse(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, runs by start and period, collapsed): ``collapsed`` keeps of every run only its first period."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key), F.col(text).cast("binary").alias("__text"))
    out = T._parse_datatype_string(f"n_words long, runs {RUNS}, collapsed string")
    out = T.StructType([rows.schema[0], *out.fields])

    def batches(parts):
        struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for part in parts:
            n_words, lists, texts, sizes = [], [np.empty((0, 3), np.int64)], [], [0]
            for words, runs in _found(part.column(1).to_pylist()):
                n_words.append(len(words))
                lists.append(runs)
                sizes.append(len(runs))
                texts.append(_collapsed(words, runs).decode())
            flat = np.concatenate(lists)
            values = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3)], fields=list(struct))
            runs = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), values)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_words, pa.int64()), runs, pa.array(texts, pa.string())], names=out.names)

    return rows.mapInArrow(batches, out)


def longest(runs: str = "runs") -> Column:
    """The run of greatest length; ties go to the smallest start, then period. Null without runs."""
    order = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = F.array_max(order)
    return F.when(best.isNotNull(), F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))


def echoed(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which about every tenth document, by the crc32 of its id, repeats one of its blocks of words to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    picked = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n = F.size("w")
    picked = picked.withColumn("a", F.when(n > 0, F.col("g") % n))
    picked = picked.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    again = F.transform("w", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return picked.select("doc_id", F.when(n > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))
