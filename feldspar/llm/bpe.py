"""BPE encoding and decoding by tree concatenation.

A long text is halved at arbitrary places until its leaves are short. Leaves are encoded independently, then joined in
pairs: a window around the join is encoded anew and grows until both sides agree with it exactly. Agreement means one
of two things. (1) The window ends where the splitting pattern must end a word whatever stands around (a change of
letter, digit, sign and white space): what lies outside cannot change. (2) The window lies within one very long word,
and its first and last ids are those that the sides have there. A sequence of ids is the encoding of a word if every
neighbouring pair is the encoding of its own bytes, and all pairs occur in the left side, the right side or the window.

Documents above ``spread_chars`` characters are dealt out over the cluster as rows of that many characters; only these
are shuffled. Their ids are joined per document, by the same rule, which needs the ids alone: bytes come from the ids.

Nulls encode as empty texts; special tokens written in a text become their ids, as in the tokenizers library. Equal
rows stay separate rows; an empty table gives an empty result. Only the id and text columns of the input are read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspar.llm.storage import small_batches
from feldspar.llm.vocab import Vocab, default_path, vocab
from feldspar.plans.spread import spread

LEAF_CHARS = 4096
SPREAD_CHARS = 32_768
WHITE, LETTER, DIGIT, SIGN = "white", "letter", "digit", "sign"


def kind(c: str) -> str | None:
    """White space, letter, digit or sign as the splitting pattern sees it; None if Unicode versions may differ on it."""
    old, new = unicodedata.ucd_3_2_0.category(c), unicodedata.category(c)
    if old != new or old == "Cn":
        return None
    if c in " \t\n\r\x0b\x0c":
        return WHITE
    if c.isspace() or old[0] in "ZC":
        return None
    return {"L": LETTER, "N": DIGIT}.get(old[0], SIGN)


def ends_word(a: str, b: str) -> bool:
    """True if the splitting pattern ends a word between these neighbours in any text."""
    x, y = kind(a), kind(b)
    if x is None or y is None or x == WHITE or x == y:
        return False
    return y == WHITE or not (a == "'" and y == LETTER)


def _text(octets: bytes) -> tuple[str, int]:
    """The whole characters of some bytes, and how many bytes were left out at the start."""
    skip = 0
    while skip < min(4, len(octets)) and octets[skip] & 0xC0 == 0x80:
        skip += 1
    return octets[skip:].decode("utf-8", "ignore"), skip


def join(v: Vocab, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ids of the text that ``left`` and ``right`` encode the two parts of."""
    if not len(left) or not len(right):
        return np.concatenate([left, right])
    n = 8
    while True:
        tail, head = left[-n:], right[:n]
        whole_left, whole_right = len(tail) == len(left), len(head) == len(right)
        before = b"".join([v.bytes[i] for i in tail])
        after = b"".join([v.bytes[i] for i in head])
        if whole_left and whole_right:
            return v.plain((before + after).decode("utf-8"))
        s, skipped = _text(before)
        t, _ = _text(after)
        a = next((i for i in range(len(s) - 1, 0, -1) if ends_word(s[i - 1], s[i])), None)
        b = next((i for i in range(1, len(t)) if ends_word(t[i - 1], t[i])), None)
        start = 0 if a is None and whole_left else None if a is None else skipped + len(s[:a].encode())
        stop = len(after) if b is None and whole_right else None if b is None else len(t[:b].encode())
        if start is not None and stop is not None:
            lengths = np.cumsum(v.lengths[tail])
            i = 0 if start == 0 else int(np.searchsorted(lengths, start)) + 1
            ends = np.cumsum(v.lengths[head])
            j = int(np.searchsorted(ends, stop)) + 1
            if (start == 0 or lengths[i - 1] == start) and ends[j - 1] == stop:
                window = v.plain((before[start:] + after[:stop]).decode("utf-8"))
                return np.concatenate([left[: len(left) - len(tail) + i], window, right[j:]])
        elif a is None and b is None and not whole_left and not whole_right and not skipped:
            more = b"".join([v.bytes[i] for i in right[n : n + 2]])
            kinds = {kind(c) for c in set(s + _text(after + more)[0])}
            if len(kinds) == 1 and kinds != {None} and len(right) >= n + 2 and _whole(before) and _whole(after):
                window = v.piece(before + after)
                if len(window) > 1 and window[0] == tail[0] and window[-1] == head[-1]:
                    return np.concatenate([left[:-n], window, right[n:]])
        n *= 2


def _whole(octets: bytes) -> bool:
    try:
        octets.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def encode_tree(v: Vocab, text: str, leaf: int = LEAF_CHARS) -> np.ndarray:
    """Ids of a text without special tokens: halves, joined."""
    if len(text) <= leaf:
        return v.plain(text)
    middle = len(text) // 2
    return join(v, encode_tree(v, text[:middle], leaf), encode_tree(v, text[middle:], leaf))


def encode_text(v: Vocab, text: str | None, leaf: int = LEAF_CHARS) -> np.ndarray:
    """Ids of a whole text; special tokens written in it become their ids."""
    parts = [text or ""]
    for s, i in v.special.items():
        parts = [y for x in parts for y in (_between(x.split(s), i) if isinstance(x, str) else [x])]
    if len(parts) == 1:
        return encode_tree(v, parts[0], leaf)
    return np.concatenate([encode_tree(v, x, leaf) if isinstance(x, str) else np.array([x], np.uint32) for x in parts])


def _between(parts: list[str], token: int) -> list:
    out: list = [parts[0]]
    for p in parts[1:]:
        out += [token, p]
    return out


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays).astype(np.int32) if arrays else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


#: Rows are encoded this many at a time, so that a batch of long texts does not become one large list.
ROWS_AT_ONCE = 512


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, leaf: int = LEAF_CHARS, spread_chars: int = SPREAD_CHARS) -> DataFrame:
    """(key, ids array<int>) for every row."""
    path = path or default_path()
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kind_of_key = rows.schema["key"].dataType.simpleString()
    specials = list(vocab(path).special)
    long = F.length("text") > spread_chars

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocab(path)
        for batch in batches:
            at = batch.schema.names.index("text")
            others = [i for i in range(batch.num_columns) if i != at]
            for k in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(k, ROWS_AT_ONCE)
                ids = _lists([encode_text(v, x, leaf) for x in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(i) for i in others] + [ids], [batch.schema.names[i] for i in others] + ["ids"])

    short = rows.where(~long).mapInArrow(run, f"key {kind_of_key}, ids array<int>")

    # A special token is kept whole: parts of a long text are cut at it first, then by length.
    escaped = "|".join(f"\\Q{s}\\E" for s in specials) or "(?!)"
    named = rows.where(long).select(F.monotonically_increasing_id().alias("row"), "key", "text")
    parts = named.select("row", "key", F.posexplode(F.split("text", f"(?<={escaped})|(?={escaped})")).alias("part", "text"))
    pieces = parts.select("row", "key", "part", F.posexplode(_cut("text", spread_chars)).alias("piece", "text"))
    pieces = spread(pieces, "row", "part", "piece")
    coded = pieces.mapInArrow(run, f"row bigint, key {kind_of_key}, part int, piece int, ids array<int>")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocab(path)
        for batch in batches:
            for k in range(batch.num_rows):
                by_part: dict[int, list] = {}
                for x in sorted(batch.column(1)[k], key=lambda x: (x["part"].as_py(), x["piece"].as_py())):
                    by_part.setdefault(x["part"].as_py(), []).append(x["ids"].values.to_numpy().astype(np.uint32))
                ids = np.concatenate([_join_all(v, x) for x in by_part.values()])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), _lists([ids])], ["key", "ids"])

    grouped = coded.groupBy("row", "key").agg(F.collect_list(F.struct("part", "piece", "ids")).alias("pieces")).select("key", "pieces")
    joined = grouped.mapInArrow(merge, f"key {kind_of_key}, ids array<int>")
    return short.union(joined).select(F.col("key").alias(key), "ids")


def _cut(column: str, size: int):
    """A string as an array of substrings of ``size`` characters."""
    return F.regexp_extract_all(F.col(column), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def _join_all(v: Vocab, parts: list[np.ndarray]) -> np.ndarray:
    while len(parts) > 1:
        parts = [join(v, *parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def decode_ids(v: Vocab, ids: np.ndarray) -> bytes:
    """Bytes of ids, by halves; unknown ids have none."""
    if len(ids) > LEAF_CHARS:
        return decode_ids(v, ids[: len(ids) // 2]) + decode_ids(v, ids[len(ids) // 2 :])
    known = len(v.bytes)
    return b"".join([v.bytes[i] for i in ids.tolist() if 0 <= i < known])


def decode(coded: DataFrame, ids: str = "ids", into: str = "decoded", path: str | None = None) -> DataFrame:
    """Add ``into``: the text of ``ids`` (null: empty); bytes that are not UTF-8 become U+FFFD."""
    path = path or default_path()

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = vocab(path)
        for c in columns:
            flat, offsets = c.flatten().to_numpy(zero_copy_only=False), c.offsets.to_numpy() - c.offsets[0].as_py()
            yield pa.array([decode_ids(v, flat[a:b]).decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])], pa.string())

    to_text = F.arrow_udf(run, "string")
    return coded.withColumn(into, to_text(F.coalesce(F.col(ids), F.array().cast("array<int>"))))
