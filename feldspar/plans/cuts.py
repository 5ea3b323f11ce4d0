"""The keys at a few ranks of a total order, found by counting instead of sorting or laying out the rows.

Each rank has a bracket of keys that must hold it, at first all of them. A round takes a sample of every bracket by a hash of the
keys, puts two pivots closely around the rank's place in the sample and counts the keys below them, which leaves a
few hundredths of the bracket whatever the pivots were. Small brackets are sorted. A round is two scans of the order
columns with nothing to shuffle but the sample; their number grows with the logarithm of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, floor, sqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys of a bracket that are sorted at the end, and keys that a sample is expected to have.
SORTED = 20_000
SAMPLE = 16_384


@dataclass
class _Bracket:
    """Keys from ``low`` (or above it, if ``strict``) to below ``high``: the rank's key is one of ``size``, after ``below`` smaller ones."""

    rank: int
    size: int
    below: int = 0
    low: tuple | None = None
    strict: bool = False
    high: tuple | None = None
    key: tuple | None = None

    def part(self) -> tuple:
        return self.low, self.strict, self.high


class _Sorted:
    """Keys in order, as they came from Spark; only those that are looked at become tuples."""

    def __init__(self, keys: pa.Array):
        self.keys = keys

    def __len__(self) -> int:
        return len(self.keys)

    def __getitem__(self, i: int) -> tuple:
        return tuple(self.keys[i].as_py().values())


def before(order: Sequence[str], key: tuple, kind: T.StructType, or_equal: bool = False) -> Column:
    """Whether a row's key is smaller than ``key``: column by column, nulls first, so that most rows need the first one only."""
    out = F.lit(or_equal)
    for o, v, f in reversed(list(zip(order, key, kind))):
        c, value = F.col(f"`{o}`"), F.lit(v).cast(f.dataType)
        out = (c.eqNullSafe(value) & out) if v is None else c.isNull() | (c < value) | ((c == value) & out)
    return out


def _kind(df: DataFrame, order: Sequence[str]) -> T.StructType:
    return T.StructType([df.schema[o] for o in order])


def keys_at(df: DataFrame, order: Sequence[str], ranks: Sequence[int], n: int, in_driver: int | None = None) -> list[tuple]:
    """The key (a tuple of the order columns, nulls first) at each rank, 0 to n - 1, of the ``n`` rows.

    Rows with equal keys share their ranks, so a rank among them gives their key.
    """
    limit = SORTED if in_driver is None else in_driver
    keys, kind = df.select(*[F.col(f"`{o}`") for o in order]), _kind(df, order)
    whole = F.struct(*[F.col(f"`{o}`").alias(f"o{i}") for i, o in enumerate(order)])
    brackets = [_Bracket(r, n) for r in ranks]

    def inside(b: _Bracket) -> Column:
        out = F.lit(True) if b.low is None else ~before(order, b.low, kind, b.strict)
        return out if b.high is None else out & before(order, b.high, kind)

    def gathered(wanted: dict[int, Column]) -> dict[int, _Sorted]:
        """The keys for which each condition holds, in order; few, so one scan collects them without a sort across the cluster.

        As an aggregate, not a filter: conditions of a filter would work out the order columns anew for each comparison.
        """
        lists = keys.agg(*[F.sort_array(F.collect_list(F.when(c, whole))).alias(f"k{i}") for i, c in wanted.items()]).toArrow()
        return {i: _Sorted(lists.column(f"k{i}")[0].values) for i in wanted}

    turn = 0
    while wide := [i for i, b in enumerate(brackets) if b.key is None and b.size > limit]:
        turn += 1
        share = F.pmod(F.xxhash64(*[F.col(f"`{o}`") for o in order], F.lit(turn)), F.lit(1 << 40)) / F.lit(float(1 << 40))
        same = {i: next(j for j in wide if brackets[j].part() == brackets[i].part()) for i in wide}
        samples = gathered({i: inside(brackets[i]) & (share < SAMPLE / brackets[i].size) for i in set(same.values())})
        pivots = {i: _pivots(brackets[i], samples[same[i]]) for i in wide if len(samples[same[i]])}
        counts = []
        for i, (low, high) in pivots.items():
            for side, pivot in (("l", low), ("h", high)):
                if pivot is None:
                    under = F.lit(False)
                else:
                    under = before(order, pivot, kind, side == "h" and low == high)
                counts.append(F.count_if(inside(brackets[i]) & under).alias(f"{side}{i}"))
        if counts:
            found = keys.agg(*counts).first()
            for i, (low, high) in pivots.items():
                brackets[i] = _narrowed(brackets[i], low, high, found[f"l{i}"], found[f"h{i}"])
    small = {i: inside(b) for i, b in enumerate(brackets) if b.key is None}
    if small:
        for i, of in gathered(small).items():
            brackets[i].key = of[brackets[i].rank - brackets[i].below]
    return [b.key for b in brackets]


def _pivots(b: _Bracket, sample: _Sorted) -> tuple[tuple | None, tuple | None]:
    """Sampled keys some deviations before and after the rank's place; none at an end of the bracket.

    The same key twice stands for itself. Whichever part is kept, it lacks one of the sampled keys, so brackets always shrink.
    """
    m, share = len(sample), (b.rank - b.below) / b.size
    reach = min(5 * sqrt(m * share * (1 - share)) + 5, m / 4)
    first, last = floor(m * share - reach), ceil(m * share + reach)
    low, high = sample[first] if first >= 0 else None, sample[last] if last < m else None
    if (low is None and high == sample[0]) or (high is None and low == sample[0]):
        return sample[0], sample[0]
    return low, high


def _narrowed(b: _Bracket, low: tuple | None, high: tuple | None, under_low: int, under_high: int) -> _Bracket:
    """The part of the bracket that holds the rank. ``under_*`` count its keys below the pivots, up to the pivot if both are one key."""
    place = b.rank - b.below
    if low is not None and place < under_low:
        return _Bracket(b.rank, under_low, b.below, b.low, b.strict, low)
    if high is not None and place < under_high:
        if low == high:
            return _Bracket(b.rank, under_high - under_low, b.below + under_low, key=low)
        start = (b.low, b.strict) if low is None else (low, False)
        return _Bracket(b.rank, under_high - under_low, b.below + under_low, *start, high)
    if high is not None:
        return _Bracket(b.rank, b.size - under_high, b.below + under_high, high, low == high, b.high)
    start = (b.low, b.strict) if low is None else (low, False)
    return _Bracket(b.rank, b.size - under_low, b.below + under_low, *start, b.high)


def block_of(df: DataFrame, order: Sequence[str], starts: Sequence[int], n: int) -> Column:
    """How many of the ``starts`` (positions in the order) a row's position has reached; a comparison of keys, no layout."""
    reached = [s for s in starts if s < n]
    kind, block = _kind(df, order), F.lit(0)
    for key in keys_at(df, order, reached, n):
        block = block + (~before(order, key, kind)).cast("int")
    return block
