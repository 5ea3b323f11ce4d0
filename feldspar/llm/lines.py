"""Fuzzy line dedup: SimHash of normalised lines, blocks of shared n-grams, edit similarity, one occurrence per group.

A line is normalised by lower-casing and by writing every run of white space as one space; blank lines are left alone.
Equal normalised lines are one class with a count. A class has a SimHash of 64 bits over its 4-grams of characters, each
as often as it occurs; below VOTE_CHARS characters its pairs of characters vote more and more. Two classes link when their
SimHashes differ in at most ``BITS`` bits and their edit similarity (1 - distance / longer length) is at least ``SIMILAR``.

So many bits leave no block of a SimHash that similar lines must share, so candidates come from n-grams: lines are joined
that share a key and pass the bits and the lengths. Where the longer line is below 40 characters every n-gram is a key
and the links are complete: 0.8 of similarity leaves at least one in common. Longer lines have one key in each of BINS bins,
the smallest hash of the bin's n-grams (longer ones in longer lines), which must also lie in places that the distance
allows. Links are then found with the recall that the README gives, lowest close to 0.8.

Keys travel packed: a batch of lines sends each bucket of keys one row, in which a line is named once. Where there are many
buckets, a line is named by its hash alone, and only the keys that several lines share, a small part, get SimHashes and lengths.
Large texts take several turns, each with the keys of some bins: links of one turn connect lines before the next, and what a
turn wrote goes. Buckets give the pairs that pass. Long lists give the pairs with one line of the list, and their rows. Every line is first verified with the smallest
hash near it; then only pairs in different components are compared with each other. Of every connected group
the first occurrence in the order of (id, line number) is kept, all others are dropped.

Null and empty texts have no line. Ids that repeat or are null are replaced by row numbers of a written copy of the
table, in whose order the first occurrence is then the one of the smallest id, nulls last. An empty table gives an empty
result. All columns of the input are kept as they are but the text; a document of which no line is left is told apart
by its counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feldspar.llm.graph import components, identified
from feldspar.llm.passages import _pack, _unpack
from feldspar.llm.words import mixed
from feldspar.plans.lookup import table_bytes
from feldspar.llm.storage import configured, discard, materialize, shuffled_joins, small_batches

BITS, SIMILAR = 25, 0.8
#: Lines from this length on vote by 4-grams only.
VOTE_CHARS = 64
#: Characters that are hashed at once.
CHARS_AT_ONCE = 40_000
#: Least length of the longer line, characters of its n-grams, whether every n-gram is a key.
GRAMS = ((0, 2, True), (8, 3, True), (20, 4, True), (40, 10, False), (100, 12, False), (200, 14, False))
#: Keys that a line has at most where not every n-gram is one.
BINS = 32
#: Lines that a task remembers, so that copies of them get no keys again, and characters of lines whose keys it sends at once.
KNOWN_LINES, SENT_CHARS = 100_000, 1_000_000
#: Text whose keys meet in one bucket, unless there are fewer buckets than tasks; but no bucket is made for less than the second.
BUCKET_BYTES, LEAST_BYTES = 20 << 20, 1 << 20
#: Text from which on there are turns, and buckets up to which SimHashes go along with the keys.
TURN_BYTES, TOLD_BUCKETS = 2 << 30, 16
#: Rows of shared keys that are compared in one group, and least of those that get SimHashes in one go; for more text, one row for each so many bytes.
SHARED_ROWS, SHARED_GO, SHARED_SHARE = 250_000, 4_000_000, 120
#: Lines that share a key and are all compared with each other at once, and pairs that are compared at once.
LIST, PAIRS_AT_ONCE = 16, 200_000
#: Parts in which a bucket's keys are sorted.
PARTS = 32
#: Lengths of the n-grams by whose counts lines are told apart, and number of counts of each.
COUNTS = ((1, 128), (3, 512))
#: Characters of pairs whose distances are found together, most and least of such pairs, bytes for their letters, columns after which pairs are looked through.
MATRIX_CHARS, MATRIX_PAIRS, MATRIX_LEAST, MATRIX_BYTES, CHECKED = 4096, 1024, 64, 16 << 20, 32
#: Text of the pairs that are verified in one cell, if no line were in two of them; lines of a list whose pairs stay together; characters of lines sent at once.
CELL_BYTES, LIST_CELL, TOLD_CHARS = 16 << 20, 512, 4_000_000
#: Text of the pairs that are verified in one go, if no line were in two of them, as a multiple of all text, and at least so much.
GO_SHARE, GO_LEAST = 3, 1 << 30
#: Bytes of an Arrow batch of keys or texts.
BATCH_BYTES = 4 << 20
#: So many bytes of line numbers are broadcast; more are joined by a shuffle. The driver holds a few times that.
SENT_BYTES = 8 << 20


def normal(line: str) -> str:
    return " ".join(line.lower().split())


def line_hash(normalised: str) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(normalised.encode("utf-8", "surrogatepass")))))


def _together(lines: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Lines in runs of about CHARS_AT_ONCE characters, each with the number of its first line."""
    at, n = 0, 0
    for i, line in enumerate(lines):
        n += len(line)
        if n > CHARS_AT_ONCE or i == len(lines) - 1:
            yield at, lines[at : i + 1]
            at, n = i + 1, 0


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q characters from each place on: a polynomial, put together from those of 1, 2, 4 ... characters."""
    n, width, power, done = max(0, len(codes) - q + 1), 1, 0x9E3779B97F4A7C15, 0
    piece, out = codes + np.uint64(1), np.zeros(n, np.uint64)
    while True:
        if q & width:
            out = out * np.uint64(power) + piece[done : done + n]
            done += width
        if 2 * width > q:
            return mixed(out)
        piece = piece[:-width] * np.uint64(power) + piece[width:]
        width, power = 2 * width, power * power % 2**64


def _within(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[i] ... starts[i] + sizes[i] - 1 of all i."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _votes(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Votes of each bit, from sizes[i] hashes a line: bits are bytes, eight of which are added at once, at most 255 times."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).view(np.uint64).reshape(-1, 8)
    parts = -(-sizes // 255)
    starts = np.repeat(np.cumsum(sizes) - sizes, parts) + 255 * _within(np.zeros(len(sizes), np.int64), parts)
    sums = np.add.reduceat(bits, starts, axis=0).view(np.uint8).reshape(-1, 64)
    return 2 * np.add.reduceat(sums, np.cumsum(parts) - parts, axis=0, dtype=np.int64) - sizes[:, None]


def simhashes(lines: list[str]) -> np.ndarray:
    """Signed 64-bit SimHashes of normalised lines that are not empty: each n-gram votes on every bit, ties are 1."""
    out = []
    for _, held in _together(lines):
        codes = np.frombuffer(("\n\n" + "\n\n".join(held) + "\n\n").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        lengths = np.array([len(x) for x in held])
        starts = np.cumsum(lengths + 2) - lengths - 2
        weight = np.minimum(lengths, VOTE_CHARS)
        votes = weight[:, None] * _votes(_grams(codes, 4)[_within(starts, lengths + 1)], lengths + 1)
        short = np.flatnonzero(lengths < VOTE_CHARS)
        if len(short):
            pairs = _votes(_grams(codes, 2)[_within(starts[short] + 1, lengths[short] + 1)], lengths[short] + 1)
            votes[short] += (VOTE_CHARS - weight[short])[:, None] * pairs
        out.append(np.packbits(votes >= 0, axis=1).view(">u8").ravel().astype(np.uint64))
    return (np.concatenate(out) if out else np.empty(0, np.uint64)).view(np.int64)


def gram_keys(lines: list[str], turn: int = 0, turns: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the line, key, place) of the keys of all lines, or of those in the bins of one turn.

    A pair has the n-grams of its longer line's length; a line has the keys of every length that its partner may have.
    """
    of, keys, places = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for at, held in _together(lines):
        codes = np.frombuffer("\n".join(held).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        lengths = np.array([len(x) for x in held])
        starts = np.cumsum(lengths + 1) - lengths - 1
        for k, (least, q, every) in enumerate(GRAMS):
            below = GRAMS[k + 1][0] if k + 1 < len(GRAMS) else np.inf
            some = np.flatnonzero((lengths < below) & (lengths / SIMILAR + 1e-9 >= least) & (lengths >= q))
            if not len(some):
                continue
            sizes = lengths[some] - q + 1
            line, place = np.repeat(some, sizes), _within(np.zeros(len(some), np.int64), sizes)
            h = _grams(codes, q)[np.repeat(starts[some], sizes) + place]
            if turns > 1:
                now = h % np.uint64(BINS) % np.uint64(turns) == turn
                line, place, h = line[now], place[now], h[now]
            if not len(h):
                continue
            if every:
                order = np.lexsort((h, line))
                new = np.concatenate([[True], (line[order][1:] != line[order][:-1]) | (h[order][1:] != h[order][:-1])])
                chosen = order[new]
            else:
                cell = line * BINS + (h % np.uint64(BINS)).astype(np.int64)
                least_of = np.full(len(held) * BINS, 2**64 - 1, np.uint64)
                np.minimum.at(least_of, cell, h)
                smallest = np.flatnonzero(h == least_of[cell])
                chosen = smallest[np.unique(cell[smallest], return_index=True)[1]]
            of.append(line[chosen] + at)
            keys.append(mixed(h[chosen] + np.uint64(k + 1)).view(np.int64))
            places.append(place[chosen])
    return np.concatenate(of), np.concatenate(keys), np.concatenate(places)


def _occurrences(rows: DataFrame) -> DataFrame:
    """(uid, pos, h) of every line that is not blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["uid", "pos", "h"]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                uid, pos, text = [], [], []
                for u, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for i, line in enumerate((t or "").split("\n")):
                        line = normal(line)
                        if line:
                            uid.append(u)
                            pos.append(i)
                            text.append(line)
                if text:
                    yield pa.RecordBatch.from_arrays([pa.array(uid, pa.int64()), pa.array(pos, pa.int32()), pa.array([line_hash(x) for x in text], pa.int64())], names)

    return rows.select("uid", "text").mapInArrow(run, "uid bigint, pos int, h bigint")


def _sent(lines: dict[int, str], buckets: int, told: bool = True, turn: int = 0, turns: int = 1) -> pa.RecordBatch:
    """A row per bucket with the lines that have keys there: hash, SimHash and length (if ``told``) and number of keys of each, then keys and places."""
    texts = list(lines.values())
    of, keys, places = gram_keys(texts, turn, turns)
    h, s, n = np.array(list(lines), np.int64), simhashes(texts) if told else None, np.array([len(x) for x in texts], np.uint32)
    keys = keys.view(np.uint64)
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket * len(texts) + of, kind="stable")
    of, low, places = of[order], keys[order].astype(np.uint32), places[order].astype(np.uint32)
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    full, blobs = np.flatnonzero(np.diff(cuts)), []
    for i in full.tolist():
        part = slice(cuts[i], cuts[i + 1])
        line, count = np.unique(of[part], return_counts=True)
        sizes = np.array([len(line), cuts[i + 1] - cuts[i]], np.int64).tobytes()
        about = s[line].tobytes() + _pack(n[line]) if told else b""
        blobs.append(sizes + h[line].tobytes() + about + _pack(count.astype(np.uint32)) + low[part].tobytes() + _pack(places[part]))
    return pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(blobs, pa.binary())], ["bucket", "blob"])


def _received(blob: bytes, told: bool = True) -> tuple[np.ndarray, ...]:
    lines, keys = np.frombuffer(blob, np.int64, 2).tolist()
    at, out = 16, []
    about = ((np.int64, lines, True), (np.uint32, lines, False)) if told else ()
    for kind, n, plain in ((np.int64, lines, True), *about, (np.uint32, lines, False), (np.uint32, keys, True), (np.uint32, keys, False)):
        size = n * np.dtype(kind).itemsize
        out.append(np.frombuffer(blob, kind, n, at) if plain else _unpack(blob[at : at + size], kind, n))
        at += size
    return tuple(out)


def _by_lines(rows: DataFrame, make: Callable[[dict[int, str]], pa.RecordBatch], schema: str) -> DataFrame:
    """What ``make`` makes of the lines of all rows, some at a time by their hash; copies may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        held: dict[int, str] = {}
        chars = 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for x in (t or "").split("\n"):
                    if (y := normal(x)) and (h := line_hash(y)) not in known:
                        known.add(h)
                        held[h] = y
                        chars += len(y)
                if chars > SENT_CHARS:
                    yield make(held)
                    held, chars = {}, 0
                    if len(known) > KNOWN_LINES:
                        known.clear()
        if held:
            yield make(held)

    return rows.select("text").mapInArrow(run, schema)


def _keyed(rows: DataFrame, buckets: int, told: bool = True, turn: int = 0, turns: int = 1) -> DataFrame:
    """(bucket, blob): the lines of all rows and their keys, packed for the bucket of the key."""
    return _by_lines(rows, lambda lines: _sent(lines, buckets, told, turn, turns), "bucket bigint, blob binary")


def _told(rows: DataFrame) -> DataFrame:
    """(h, s, l): hash, SimHash and length of the lines of all rows."""

    def make(lines: dict[int, str]) -> pa.RecordBatch:
        texts = list(lines.values())
        columns = [pa.array(list(lines), pa.int64()), pa.array(simhashes(texts)), pa.array([len(x) for x in texts], pa.int32())]
        return pa.RecordBatch.from_arrays(columns, ["h", "s", "l"])

    return _by_lines(rows, make, "h bigint, s bigint, l int")


#: Whether lines that share a key may be similar: by their SimHashes, and by the characters before and after the n-gram.
NEAR = f"bit_count(s ^ s_b) <= {BITS} AND (CASE WHEN greatest(l, l_b) < 40 THEN abs(l - l_b) ELSE abs(p - p_b) + abs(l - p - l_b + p_b) END) <= floor(greatest(l, l_b) * {1 - SIMILAR:.6f} + 1e-6)"


def _near(s: np.ndarray, l: np.ndarray, p: np.ndarray, s_b: np.ndarray, l_b: np.ndarray, p_b: np.ndarray) -> np.ndarray:
    """NEAR of arrays."""
    longer = np.maximum(l, l_b)
    apart = np.where(longer < 40, np.abs(l - l_b), np.abs(p - p_b) + np.abs(l - p - l_b + p_b))
    return (np.bitwise_count((s ^ s_b).view(np.uint64)) <= BITS) & (apart <= np.floor(longer * round(1 - SIMILAR, 6) + 1e-6))


def _met(batches: Iterator[pa.RecordBatch]) -> pa.Table:
    """What the keys of a bucket tell: near pairs (a < b: line hashes; e is null), and lists of lines (e, a: hash, b: SimHash, l, p, n).

    A key that at most LIST lines share gives all their near pairs. More lines, n, give those with the line among them that was
    sent most often, and a row each.
    """
    bucket, (h, s, l, count, all_keys, all_places) = _taken(batches, _received)
    # As np.unique does, in less memory.
    order = np.argsort(h, kind="stable")
    h = h[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    number = np.empty(len(h), np.uint32)
    number[order] = np.cumsum(new, dtype=np.uint32) - np.uint32(1)
    all_lines = np.repeat(number, count)
    del number, count
    names, where = h[new], order[new]
    del order
    s, l = s[where], l[where].astype(np.int32)
    del where
    copies = np.diff(np.append(np.flatnonzero(new), len(h))).astype(np.int32)
    del h, new
    return _compared(all_keys, all_lines, all_places, names, s, l, copies, lambda key: bucket << 32 | key)


def _taken(batches: Iterator[pa.RecordBatch] | pa.Table, received: Callable[[pa.Buffer], tuple[np.ndarray, ...]]) -> tuple[int, list[np.ndarray]]:
    """The number of a bucket and all that was sent to it."""
    parts, bucket = [], 0
    for batch in batches.to_batches() if isinstance(batches, pa.Table) else batches:
        bucket = batch.column("bucket")[0].as_py() if batch.num_rows else bucket
        for blob in batch.column("blob"):
            parts.append([x.copy() for x in received(blob.as_buffer())])  # so that what was sent can go
    out = []
    for i in range(len(parts[0])):
        out.append(np.concatenate([part[i] for part in parts]))
        for part in parts:
            part[i] = None
    return bucket, out


def _several(x: np.ndarray) -> np.ndarray:
    """Which of sorted values come more than once."""
    again = x[1:] == x[:-1]
    return np.concatenate([[False], again])[: len(x)] | np.concatenate([again, [False]])[: len(x)]


def _shared(batches: Iterator[pa.RecordBatch] | pa.Table) -> pa.Table:
    """(e, h, p): the keys of a bucket that different lines share, with each of these lines and its place."""

    def received(blob: pa.Buffer) -> tuple[np.ndarray, ...]:
        h, count, keys, places = _received(blob, False)
        return np.repeat(h, count), keys, places

    bucket, (h, key, place) = _taken(batches, received)
    order = np.argsort(key, kind="stable")
    order = order[_several(key[order])]  # most keys go here
    h, key, place = h[order], key[order], place[order]
    order = np.lexsort((h, key))
    h, key, place = h[order], key[order], place[order]
    once = np.concatenate([[True], (key[1:] != key[:-1]) | (h[1:] != h[:-1])])[: len(key)]
    h, key, place = h[once], key[once], place[once]
    held = _several(key)
    return pa.table({"e": pa.array(bucket << 32 | key[held].astype(np.int64)), "h": pa.array(h[held]), "p": pa.array(place[held].astype(np.int32))})


def _met_told(rows: pa.Table) -> pa.Table:
    """The same as ``_met`` of rows (e, h, p, s, l, n) of shared keys; n counts a line's copies."""
    e, h, p, s, l, n = (rows.column(c).to_numpy() for c in ("e", "h", "p", "s", "l", "n"))
    of_keys, key = np.unique(e, return_inverse=True)
    names, where, line = np.unique(h, return_index=True, return_inverse=True)
    return _compared(key.astype(np.uint32), line.astype(np.uint32), p.astype(np.uint32), names, s[where], l[where], n[where], lambda k: of_keys[k])


def _compared(
    all_keys: np.ndarray, all_lines: np.ndarray, all_places: np.ndarray, names: np.ndarray, s: np.ndarray, l: np.ndarray, copies: np.ndarray, name: Callable[[np.ndarray], np.ndarray]
) -> pa.Table:
    """What ``_met`` gives, from keys with the numbers of their lines; hashes, SimHashes, lengths and copies by these numbers."""
    pairs, lists = [], [np.empty((5, 0), np.int64)]
    # Part by part, for these arrays take several times what was sent.
    for k in range(PARTS):
        mine = np.flatnonzero(all_keys % np.uint32(PARTS) == k)
        both = all_keys[mine].astype(np.uint64) << np.uint64(32) | all_lines[mine]
        order = np.argsort(both)
        both = both[order]
        once = np.concatenate([[True], both[1:] != both[:-1]])[: len(both)]
        key, line, p = (both[once] >> np.uint64(32)).astype(np.int64), (both[once] & np.uint64(0xFFFFFFFF)).astype(np.int64), all_places[mine[order[once]]].astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
        sizes = np.diff(np.append(starts, len(key)))

        def compare(i: np.ndarray, j: np.ndarray) -> None:
            x, y = line[i], line[j]
            good = (x != y) & _near(s[x], l[x], p[i], s[y], l[y], p[j])
            x, y = x[good], y[good]
            pairs.append(np.unique(np.minimum(x, y) * len(names) + np.maximum(x, y)))

        for size in np.unique(sizes[(sizes > 1) & (sizes <= LIST)]).tolist():
            begin, (i, j) = starts[sizes == size], np.triu_indices(size, 1)
            step = max(1, PAIRS_AT_ONCE // len(i))
            for at in range(0, len(begin), step):
                some = begin[at : at + step, None]
                compare((some + i).ravel(), (some + j).ravel())
        long = sizes > LIST
        if long.any():
            rows, of = _within(starts[long], sizes[long]), np.repeat(np.arange(long.sum()), sizes[long])
            top = rows[np.lexsort((line[rows], copies[line[rows]], of))[np.cumsum(sizes[long]) - 1]]
            for at in range(0, len(rows), PAIRS_AT_ONCE):
                part = slice(at, at + PAIRS_AT_ONCE)
                compare(top[of[part]], rows[part])
            lists.append(np.stack([key[rows], line[rows], l[line[rows]], p[rows], np.repeat(sizes[long], sizes[long])]))
    x, y = np.divmod(np.unique(np.concatenate([*pairs, np.empty(0, np.int64)])), len(names))
    key, held, length, p, size = np.concatenate(lists, axis=1)
    columns = [
        pa.concat_arrays([pa.nulls(len(x), pa.int64()), pa.array(name(key), pa.int64())]),
        pa.array(np.concatenate([names[x], names[held]])),
        pa.array(np.concatenate([names[y], s[held]])),
        *[pa.concat_arrays([pa.nulls(len(x), pa.int32()), pa.array(z.astype(np.int32))]) for z in (length, p, size)],
    ]
    return pa.table(columns, names=["e", "a", "b", "l", "p", "n"])


def differing(x: str, y: str) -> tuple[str, str]:
    """Two strings without their common beginning and end, which leaves the edit distance as it is."""
    if len(x) > len(y):
        return differing(y, x)[::-1]
    a, b = (np.frombuffer(z.encode("utf-32-le", "surrogatepass"), np.uint32) for z in (x, y))
    n = len(a)
    unlike = np.flatnonzero(a != b[:n])
    i = int(unlike[0]) if len(unlike) else n
    unlike = np.flatnonzero(a[i:][::-1] != b[::-1][: n - i])
    j = int(unlike[0]) if len(unlike) else n - i
    return x[i : n - j], y[i : len(y) - j]


def _coded(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All characters in one array, where each line begins, its length."""
    sizes = np.array([len(x) for x in lines], np.int64)
    return np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32), np.cumsum(sizes) - sizes, sizes


def _counts(lines: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The lengths of lines, and for each of COUNTS their n-grams by hash, up to 255 of one."""
    tables, lengths = [np.zeros((len(lines), width), np.uint8) for _, width in COUNTS], [np.empty(0, np.int64)]
    for at, held in _together(lines):
        codes, starts, sizes = _coded(held)
        lengths.append(sizes)
        for (q, width), table in zip(COUNTS, tables):
            grams = np.maximum(sizes - q + 1, 0)
            cell = (_grams(codes.astype(np.uint64), q)[_within(starts, grams)] % np.uint64(width)).astype(np.int64)
            cell += np.repeat(np.arange(len(held)) * width, grams)
            table[at : at + len(held)] = np.minimum(np.bincount(cell, minlength=len(held) * width), 255).reshape(-1, width)
    return np.concatenate(lengths), tables


def _apart(lengths: np.ndarray, tables: list[np.ndarray], i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Whether lines i and j are surely more than ``most`` edits apart: an edit changes at most q of the n-grams of q characters."""
    out = np.zeros(len(i), bool)
    for (q, _), table in zip(COUNTS, tables):
        for at in range(0, len(i), 4096):
            part = slice(at, at + 4096)
            x, y, k = i[part], j[part], q - 1
            sizes = np.abs(np.maximum(lengths[x] - k, 0) - np.maximum(lengths[y] - k, 0))
            u, v = table[x], table[y]
            # Twice the larger of the n-grams that only one has and those that only the other has.
            out[part] |= (np.maximum(u, v) - np.minimum(u, v)).sum(1, dtype=np.int64) + sizes > 2 * q * most[part]
    return out


def _numbered(x: list[str], y: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    number = {s: i for i, s in enumerate(dict.fromkeys([*x, *y]))}
    return list(number), *(np.array([number[s] for s in side], np.int64) for side in (x, y))


def unlike(x: list[str], y: list[str], most: np.ndarray) -> np.ndarray:
    """Whether x[i] and y[i] are surely more than most[i] edits apart."""
    lines, i, j = _numbered(x, y)
    return _apart(*_counts(lines), i, j, most)


def distances(x: list[str], y: list[str], most: np.ndarray) -> np.ndarray:
    """Edit distances of all x[i] and y[i], none of them empty, by Myers' bit vectors: 64 rows of the matrix of each pair at once.

    Right up to most[i], which is no less than the difference of the lengths; above, any number above. Words of rows that
    are further than the largest ``most`` from the diagonal are left out: their cells count as larger than they are.
    """
    (a, begin_a, m), (b, begin_b, n), band = _coded(x), _coded(y), int(most.max())
    number = np.zeros(max(int(a.max()), int(b.max())) + 1, np.int64)
    number[a] = 1
    letters, pairs, words = np.flatnonzero(number), np.arange(len(x)), -(-int(m.max()) // 64)
    if 8 * words * len(letters) * len(x) > MATRIX_BYTES:
        if len(x) < MATRIX_LEAST:
            return np.array([distance(*z) for z in zip(x, y, most.tolist())])
        half = len(x) // 2
        return np.concatenate([distances(x[:half], y[:half], most[:half]), distances(x[half:], y[half:], most[half:])])
    same = np.zeros((words, len(letters) + 1, len(x)), np.uint64)
    number[:] = len(letters)
    number[letters] = np.arange(len(letters))
    letter = number[a]
    for i in range(int(m.max())):
        has = pairs[m > i]
        same[i // 64, letter[begin_a[has] + i], has] |= np.uint64(1 << i % 64)
    same = same.reshape(words, -1)
    letter = number[b]
    up, down = np.full((words, len(x)), 2**64 - 1, np.uint64), np.zeros((words, len(x)), np.uint64)
    out, bottom, reached, one, top = most + 1, np.zeros(len(x), np.int64), 0, np.uint64(1), np.uint64(63)
    for j in range(int(n.max())):
        while reached < min(words, (j + band) // 64 + 1):
            bottom += 64
            reached += 1
        width, lowest = len(bottom), min(max(0, (j - band) // 64), reached - 1)
        seen = letter[begin_b + np.minimum(j, n - 1)] * width + np.arange(width)
        plus, minus = np.ones(width, np.uint64), np.zeros(width, np.uint64)
        for w in range(lowest, reached):
            equal, vp, vn = same[w].take(seen), up[w], down[w]
            vertical = equal | vn
            equal |= minus
            across = equal & vp
            across += vp
            across ^= vp
            across |= equal
            hn = vp & across
            across |= vp
            hp = np.invert(across, out=across)
            hp |= vn
            over = hp >> top
            hp <<= one
            hp |= plus
            plus, over = over, hn >> top
            hn <<= one
            hn |= minus
            minus = over
            np.bitwise_and(hp, vertical, out=vn)
            vertical |= hp
            np.invert(vertical, out=vp)
            vp |= hn
        bottom += plus.view(np.int64)
        bottom -= minus.view(np.int64)
        # Of pairs that end here, the cell of the last row, from the lowest one and the steps of the column between them.
        if len(end := np.flatnonzero(n == j + 1)):
            last = bottom[end]
            for w in range(reached):
                below = np.clip(64 * (w + 1) - m[end], 0, 64).astype(np.uint64)
                rows = np.where(below == 64, np.uint64(2**64 - 1), ~(np.uint64(2**64 - 1) >> np.minimum(below, top)))
                last -= np.bitwise_count(up[w, end] & rows).astype(np.int64) - np.bitwise_count(down[w, end] & rows).astype(np.int64)
            out[pairs[end]] = last
        if j % CHECKED == CHECKED - 1:
            left = np.flatnonzero((n > j + 1) & (_at_least(up[lowest:reached], down[lowest:reached], bottom, lowest, m - n + j + 1, j + 1) <= most))
            if not len(left):
                break
            if len(left) < 0.75 * width:
                same = same.reshape(words, -1, width)[:, :, left].reshape(words, -1)
                up, down = up[:, left], down[:, left]
                pairs, begin_b, n, m, most, bottom = (z[left] for z in (pairs, begin_b, n, m, most, bottom))
    return out


def _at_least(up: np.ndarray, down: np.ndarray, bottom: np.ndarray, lowest: int, row: np.ndarray, column: int) -> np.ndarray:
    """What every way through a column of the matrix costs at least: its cell, and the steps from there to the diagonal that ends right (now at ``row``).

    The words' cells are taken 16 at once: the lowest of them is no more below the last one than there are steps up.
    """
    ups, downs = (np.bitwise_count(np.ascontiguousarray(z).view(np.uint16).reshape(*z.shape, 4)).transpose(0, 2, 1).reshape(-1, len(bottom)).astype(np.int64) for z in (up, down))
    steps = ups - downs
    ends = bottom - (np.cumsum(steps[::-1], 0)[::-1] - steps)
    first = 64 * lowest + 16 * np.arange(len(steps))[:, None] + 1
    least = (ends - ups + np.maximum(0, np.maximum(first - row, row - first - 15))).min(0)
    return least if lowest else np.minimum(least, column + np.abs(row))


def distance(x: str, y: str, most: int) -> int:
    """The edit distance of two strings that are not empty, or any larger number than ``most``: the same with one whole number for all rows."""
    same: dict[str, int] = {}
    for i, c in enumerate(x):
        same[c] = same.get(c, 0) | 1 << i
    m, out, full = len(x), len(x), (1 << len(x)) - 1
    up, down = full, 0
    for j, c in enumerate(y):
        equal = same.get(c, 0)
        vertical = equal | down
        across = (((equal & up) + up) ^ up) | equal
        plus, minus = down | full & ~(across | up), up & across
        out += (plus >> m - 1) - (minus >> m - 1 & 1)
        if out - (len(y) - 1 - j) > most:
            return most + 1
        plus, minus = (plus << 1 | 1) & full, minus << 1 & full
        up, down = minus | full & ~(vertical | plus), plus & vertical
    return out


def similar(x: list[str], y: list[str]) -> np.ndarray:
    """Whether the edit similarity of the lines x[i] and y[i] is at least SIMILAR."""
    return _alike(*_numbered(x, y))


def _alike(lines: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the edit similarity of lines i and j is at least SIMILAR."""
    lengths, tables = _counts(lines)
    most = (np.maximum(lengths[i], lengths[j]) * (1 - SIMILAR) + 1e-9).astype(np.int64)
    like = ~_apart(lengths, tables, i, j, most)
    candidates = np.flatnonzero(like)
    # Pairs of about one size go together.
    candidates = candidates[np.argsort(np.maximum(lengths[i], lengths[j])[candidates], kind="stable")]
    for at in range(0, len(candidates), 8 * MATRIX_PAIRS):
        pairs = {k: differing(lines[i[k]], lines[j[k]]) for k in candidates[at : at + 8 * MATRIX_PAIRS].tolist()}
        size = {k: max(map(len, z)) for k, z in pairs.items()}
        # A part is empty only where the other is short enough, for the lengths are not further apart.
        left = sorted((k for k in pairs if size[k] > most[k]), key=size.get)
        small = [k for k in left if size[k] <= MATRIX_CHARS]
        for first in range(0, len(small), MATRIX_PAIRS):
            some = small[first : first + MATRIX_PAIRS]
            if len(some) >= MATRIX_LEAST:
                like[some] = distances(*zip(*(pairs[k] for k in some)), most[some]) <= most[some]
            else:
                like[some] = [distance(*pairs[k], int(most[k])) <= most[k] for k in some]
        some = left[len(small) :]
        like[some] = [distance(*pairs[k], int(most[k])) <= most[k] for k in some]
    return like


def _decided(pairs: pa.Table, texts: pa.Table) -> pa.Table:
    """The (a, b) of a cell's pairs whose lines are similar."""
    names, lines = [np.empty(0, np.int64)], []
    for h, sizes, blob, size in zip(*(texts.column(c) for c in ("h", "sizes", "blob", "size"))):
        names.append(np.frombuffer(h.as_buffer(), np.int64))
        text = pa.decompress(blob.as_buffer(), size.as_py(), "zstd").to_pybytes().decode("utf-8", "surrogatepass")
        ends = np.cumsum(np.frombuffer(sizes.as_buffer(), np.uint32).astype(np.int64)).tolist()
        lines += [text[x:y] for x, y in zip([0, *ends], ends)]
    names = np.concatenate(names)
    order = np.argsort(names)
    a, b = (pairs.column(c).to_numpy() for c in "ab")
    i, j = (order[np.searchsorted(names, z, sorter=order)] for z in (a, b))
    like = _alike(lines, i, j)
    return pa.table({"a": a[like], "b": b[like]})


def _verified(pairs: DataFrame, rows: DataFrame, classes: DataFrame, cells: int) -> DataFrame:
    """The (a, b) of ``pairs`` (a, b, c) whose lines are similar. Pairs of one c meet in one cell, to which each line's text goes once.

    Texts are taken from the lines' first occurrence; the places are broadcast if they are few.
    """
    pairs = pairs.select("a", "b", F.pmod(F.xxhash64("c"), F.lit(cells)).alias("cell"))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("h"), "cell").groupBy("h").agg(F.collect_set("cell").alias("cells"))
    places = wanted.join(classes.select("h", "first.uid", "first.pos"), "h").groupBy("uid").agg(F.collect_list(F.struct("pos", "h", "cells")).alias("at"))
    places = _written(places)

    def sent(held: dict[int, tuple[list, list]]) -> pa.RecordBatch:
        h = [np.array(x, np.int64).tobytes() for x, _ in held.values()]
        sizes = [np.array([len(x) for x in lines], np.uint32).tobytes() for _, lines in held.values()]
        texts = ["".join(lines).encode("utf-8", "surrogatepass") for _, lines in held.values()]
        columns = [pa.array(list(held), pa.int64()), *(pa.array(z, pa.binary()) for z in (h, sizes, [pa.compress(x, "zstd", asbytes=True) for x in texts]))]
        return pa.RecordBatch.from_arrays([*columns, pa.array([len(x) for x in texts], pa.int64())], ["cell", "h", "sizes", "blob", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars = {}, 0
        for batch in batches:
            for some in (batch.slice(i, 32) for i in range(0, batch.num_rows, 32)):
                for t, at in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    lines = t.split("\n")
                    for x in at:
                        line = normal(lines[x["pos"]])
                        for cell in x["cells"]:
                            h, texts = held.setdefault(cell, ([], []))
                            h.append(x["h"])
                            texts.append(line)
                        chars += len(line) * len(x["cells"])
                if chars > TOLD_CHARS:
                    yield sent(held)
                    held, chars = {}, 0
        if held:
            yield sent(held)

    told = rows.select("uid", "text").join(_few_or_merged(places), "uid")
    told = told.select("text", "at").mapInArrow(run, "cell bigint, h binary, sizes binary, blob binary, size bigint")
    out = _written(pairs.groupBy("cell").cogroup(told.groupBy("cell")).applyInArrow(_decided, "a bigint, b bigint"))
    discard(places)
    return out


def _written(df: DataFrame) -> DataFrame:
    """``materialize`` with batches of BATCH_BYTES at most and shuffled joins; the shuffle files that it took go at once."""
    spark = df.sparkSession
    with shuffled_joins(spark), configured(spark, spark__sql__execution__arrow__maxBytesPerBatch=str(BATCH_BYTES), spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        return materialize(df)


def _few_or_merged(df: DataFrame) -> DataFrame:
    """A written table for a join: broadcast if its measured size allows, else never."""
    return F.broadcast(df) if table_bytes(df) <= SENT_BYTES else df.hint("merge")


def line_links(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b: line hashes) that connect every group; ``classes`` has h and the first occurrence."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    turns = min(BINS, max(1, -(-size // TURN_BYTES)))
    # In fewer buckets a line has more keys in each, for which it is named once.
    buckets = max(size // turns // BUCKET_BYTES, min(rows.sparkSession.sparkContext.defaultParallelism, size // LEAST_BYTES), 1)
    mean = size // max(1, classes.count()) + 1
    info = None
    if buckets > TOLD_BUCKETS:
        info = _written(_told(rows).groupBy("h").agg(F.min("s").alias("s"), F.min("l").alias("l")).join(classes.select("h", F.col("n").cast("int")), "h"))

    def verified(tried: DataFrame) -> list[DataFrame]:
        text = tried.count() * 2 * mean
        goes = max(1, -(-text // max(GO_SHARE * size, GO_LEAST)))
        parts = [tried if goes == 1 else tried.where(F.pmod(F.hash("c"), F.lit(goes)) == i) for i in range(goes)]
        return [_verified(part, rows, classes, max(1, text // goes // CELL_BYTES)) for part in parts]

    done: list[DataFrame] = []
    for turn in range(turns):
        met = _meetings(rows, info, buckets, turn, turns, max(SHARED_GO, size // SHARED_SHARE))
        done += _found(reduce(DataFrame.union, met), done, verified)
        for table in met:
            discard(table)
    if info is not None:
        discard(info)
    return reduce(DataFrame.union, done)


def _meetings(rows: DataFrame, info: DataFrame | None, buckets: int, turn: int, turns: int, most: int) -> list[DataFrame]:
    """What the buckets of one turn give, as ``_met`` says, pairs perhaps repeated; ``info`` (h, s, l, n) is None if SimHashes go along with the keys.

    About ``most`` rows of shared keys get SimHashes in one go, for the rows are several times wider then.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _met(batches).to_batches(max_chunksize=50_000)

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _shared(batches).to_batches(max_chunksize=50_000)

    schema = "e bigint, a bigint, b bigint, l int, p int, n int"
    if info is None:
        return [_written(_keyed(rows, buckets, True, turn, turns).groupBy("bucket").applyInArrow(meet, schema).distinct())]
    shared = _written(_keyed(rows, buckets, False, turn, turns).groupBy("bucket").applyInArrow(share, "e bigint, h bigint, p int"))
    n = shared.count()
    goes = max(1, -(-n // most))
    groups, met = max(1, -(-n // goes // SHARED_ROWS)), []
    for i in range(goes):
        full = shared.where(F.pmod(F.hash("e"), F.lit(goes)) == i).join(info, "h").select("e", "h", "p", "s", "l", "n")
        met.append(_written(full.groupBy(F.pmod(F.xxhash64("e"), F.lit(groups))).applyInArrow(_met_told, schema).distinct()))
    discard(shared)
    return met


def _found(met: DataFrame, before: list[DataFrame], verified: Callable[[DataFrame], list[DataFrame]]) -> list[DataFrame]:
    """Links among the lines that met, which with those found before connect every group."""
    of = lambda group, x: group.select(F.col("node").alias(x), F.col("component").alias(f"g_{x}"))

    def apart(pairs: DataFrame, links: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
        group = _written(components(reduce(DataFrame.union, links)))
        both = pairs.join(of(group, "a"), "a", "left").join(of(group, "b"), "b", "left")
        return group, both.where(F.coalesce("g_a", "a") != F.coalesce("g_b", "b")).select("a", "b")

    pairs = met.where("e IS NULL").select("a", "b")
    # First every line with the smallest one near it, so that a group of many variants costs little.
    group, new = apart(pairs, before) if before else (None, pairs)
    tried = _written(new.groupBy("b").agg(F.min("a").alias("a")).select("a", "b", F.col("a").alias("c")))
    if group is not None:
        discard(group)
    first = verified(tried)

    group, rest = apart(pairs, before + first)
    lists = met.where("e IS NOT NULL").withColumnRenamed("b", "s").join(of(group, "a"), "a", "left").withColumn("g", F.coalesce("g_a", "a"))
    other = lists.select("e", F.col("a").alias("b"), *[F.col(x).alias(f"{x}_b") for x in ("s", "l", "p", "g")])
    # The pairs of a list stay together; those of a list of more than LIST_CELL lines, block by block.
    block = lambda x: F.pmod(F.col(x), F.ceil(F.col("n") / LIST_CELL))
    near = lists.join(other, "e").where(f"a < b AND g <> g_b AND {NEAR}").select("a", "b", F.xxhash64("e", block("a"), block("b")).alias("c"))
    rest = rest.withColumn("c", F.col("a")).union(near).groupBy("a", "b").agg(F.min("c").alias("c"))
    rest = _written(rest.join(tried.select("a", "b"), ["a", "b"], "left_anti"))
    found = first if rest.isEmpty() else first + verified(rest)
    for table in (group, tried, rest):
        discard(table)
    return found


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` with the text reduced to its kept lines, and n_lines, n_dropped (lines that are not blank)."""
    small_batches(docs.sparkSession)
    plain = docs.drop("n_lines", "n_dropped")
    held = identified(plain, key).select("doc", "uid", F.col(f"doc.`{text}`").cast("string").alias("text"))
    seen = _written(_occurrences(held))
    classes = _written(seen.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("uid", "pos")).alias("first")))
    parts = components(line_links(held, classes)).withColumnRenamed("node", "h")
    told = classes.join(parts, "h", "left").select("h", "n", "first", F.coalesce("component", "h").alias("g"))
    groups = told.groupBy("g").agg(F.sum("n").alias("total"), F.min("first").alias("kept")).where("total > 1")
    again = told.join(groups, "g").select("h", F.col("kept.uid").alias("kept_uid"), F.col("kept.pos").alias("kept_pos"))
    dropped = seen.select("uid", "pos", "h").join(again, "h").where("NOT (uid = kept_uid AND pos = kept_pos)")
    dropped = _written(dropped.groupBy("uid").agg(F.collect_list("pos").alias("gone")))

    def keep(texts: pa.Array, gone: pa.Array) -> pa.Array:
        left, n, m = [], [], []
        for t, g in zip(texts.to_pylist(), gone.to_pylist()):
            lines, without = (t or "").split("\n"), set(g or ())
            n.append(sum(bool(x.strip()) for x in lines))
            m.append(len(without))
            left.append("\n".join([x for i, x in enumerate(lines) if i not in without]) if without else t)
        return pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(n, pa.int64()), pa.array(m, pa.int64())], ["text", "n", "m"])

    told = held.join(_few_or_merged(dropped), "uid", "left").select("doc", F.arrow_udf(keep, "struct<text:string,n:bigint,m:bigint>")("text", "gone").alias("kept"))
    return told.select(*[F.col("kept.text").alias(text) if c == text else F.col(f"doc.`{c}`") for c in plain.columns], F.col("kept.n").alias("n_lines"), F.col("kept.m").alias("n_dropped"))


def keep_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", size: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` with their kept lines; rows all of whose lines went are dropped, ``size`` follows the text."""
    told = dedup(docs, key, text).where("n_dropped = 0 OR n_dropped < n_lines")
    if size in docs.columns:
        told = told.withColumn(size, F.when(F.col("n_dropped") > 0, F.length(text).cast(docs.schema[size].dataType)).otherwise(F.col(size)))
    return told.select(*docs.columns)
