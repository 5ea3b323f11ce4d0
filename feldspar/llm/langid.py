"""Language identification by error-correcting output codes.

Every language has a codeword of bits. One binary classifier per bit looks at hashed letter n-grams (1 to 3) of the
whole text: its weights are log-odds of the n-gram counts of the languages on either side of the bit. Decoding weighs
each bit's loss by how often that bit is right for the language in question, and takes the nearest codeword; a text
whose two nearest codewords are nearly as near is flagged as ambiguous.

Training takes a bounded sample of labelled rows, ``rows_per_language`` of each language at most, chosen by a hash of
the key. Null labels teach nothing. Texts that are null or hold no letter are ``und`` with score 0, as is everything
when no language could be learnt. Equal rows get equal results; an empty table gives an empty result. Other columns of
the input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feldspar.llm.storage import materialize, small_batches

UNKNOWN = "und"
BUCKETS = 1 << 14
ROWS_PER_LANGUAGE = 3000
#: Below this difference of the two best scores a text is ambiguous.
AMBIGUOUS = 0.2
#: Sharpness of the scores made from decoding losses.
SHARPNESS = 4.0


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case letter of each code point; 0 for anything else."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed n-grams of letters and gaps in a whole text; None without letters."""
    if not text:
        return None
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not codes.any():
        return None
    codes = np.concatenate([[0], codes, [0]]).astype(np.uint32)
    keep = (codes[1:] != 0) | (codes[:-1] != 0)  # a run of other characters is one gap
    codes = codes[np.concatenate([[True], keep])]
    two = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:]
    three = two[:-1] * np.uint32(0x85EBCA6B) + codes[2:]
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    hashed = [(x * np.uint32(0xC2B2AE35) ^ np.uint32(seed)) * np.uint32(0x27D4EB2F) >> shift for x, seed in ((codes, 1), (two, 2), (three, 3))]
    return np.bincount(np.concatenate(hashed), minlength=BUCKETS)


def codewords(languages: int) -> np.ndarray:
    """Codewords of +1 and -1: all different splits for up to seven languages, else spread-out random ones."""
    if languages < 2:
        return np.ones((languages, 1))
    if languages <= 7:
        columns = [[1.0 if language == 0 or not (bits >> (language - 1)) & 1 else -1.0 for language in range(languages)] for bits in range(1, 2 ** (languages - 1))]
        return np.array(columns).T
    rng, best, width = np.random.default_rng(7), None, 15 * int(np.ceil(np.log2(languages)))
    for _ in range(50):
        m = rng.choice([-1.0, 1.0], (languages, width))
        apart = min((m[i] != m[j]).sum() for i in range(languages) for j in range(i))
        if best is None or apart > best[0]:
            best = (apart, m)
    return best[1]


class Model:
    """Weights per bit, and how far each bit is right for each language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages, self.code = languages, codewords(len(languages))
        rates = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True)
        self.weights = np.zeros((BUCKETS, self.code.shape[1]))
        for j in range(self.code.shape[1]):
            on = self.code[:, j] > 0
            if on.any() and not on.all():
                self.weights[:, j] = np.log(rates[on].mean(0)) - np.log(rates[~on].mean(0))
        expected = rates @ self.weights  # mean margin of each language
        high = np.array([expected[self.code[:, j] > 0, j].mean() if (self.code[:, j] > 0).any() else 0 for j in range(self.code.shape[1])])
        low = np.array([expected[self.code[:, j] < 0, j].mean() if (self.code[:, j] < 0).any() else 0 for j in range(self.code.shape[1])])
        self.middle, self.half = (high + low) / 2, np.maximum((high - low) / 2, 1e-9)
        self.right = np.ones_like(self.code)

    def margins(self, counts: np.ndarray) -> np.ndarray:
        return (counts @ self.weights / counts.sum() - self.middle) / self.half

    def decode(self, margins: np.ndarray) -> np.ndarray:
        """Probability-like scores of the languages: loss-weighted distances, sharpened."""
        loss = np.exp(-np.clip(self.code * margins, -4, 4))
        distance = (self.right * loss).sum(1) / self.right.sum(1)
        p = np.exp(-SHARPNESS * (distance - distance.min()))
        return p / p.sum()


def _remainder(key: str, parts: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows_per_language: int = ROWS_PER_LANGUAGE) -> Model | None:
    """Learn from the rows of ``docs``: two passes over a bounded sample of them."""
    known = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return None
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, rows_per_language / n))])
    chance = F.pmod(F.xxhash64(F.lit("sample"), "key"), F.lit(1 << 30)) / float(1 << 30)
    sample = materialize(known.where(chance < share[F.col("lang")]).select("lang", "text").repartition(8))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                c = ngram_counts(t)
                if c is not None:
                    # Every document weighs the same, however long.
                    sums[lang] = sums.get(lang, 0) + c * (1000.0 / c.sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([x.tolist() for x in sums.values()], pa.list_(pa.float64()))], ["lang", "counts"])

    totals = np.zeros((len(languages), BUCKETS))
    for r in sample.mapInArrow(count, "lang string, counts array<double>").collect():  # 8 rows a language
        totals[languages.index(r["lang"])] += np.array(r["counts"])
    heard = totals.sum(1) > 0
    languages, totals = [x for x, h in zip(languages, heard) if h], totals[heard]
    if not languages:
        return None
    model = Model(languages, totals)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, n = np.zeros_like(model.code), np.zeros(len(languages))
        for batch in batches:
            for lang, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                c = ngram_counts(t)
                if c is not None:
                    i = languages.index(lang)
                    right[i] += model.margins(c) * model.code[i] > 0
                    n[i] += 1
        yield pa.RecordBatch.from_arrays([pa.array(languages), pa.array(n), pa.array(right.tolist(), pa.list_(pa.float64()))], ["lang", "n", "right"])

    right, n = np.ones_like(model.code), np.full(len(languages), 2.0)
    for r in sample.mapInArrow(test, "lang string, n double, right array<double>").collect():
        right[languages.index(r["lang"])] += np.array(r["right"])
        n[languages.index(r["lang"])] += r["n"]
    model.right = right / n[:, None]
    return model


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add lang_pred, score, second, ambiguous to every row of ``docs``."""
    small_batches(docs.sparkSession)
    shape = "struct<lang_pred:string,score:double,second:string,ambiguous:boolean>"

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for c in texts:
            out = []
            for t in c.to_pylist():
                counts = ngram_counts(t) if model else None
                if counts is None:
                    out.append((UNKNOWN, 0.0, None, True))
                    continue
                p = model.decode(model.margins(counts))
                order = np.argsort(-p, kind="stable")
                other = order[1] if len(order) > 1 else None
                out.append((model.languages[order[0]], float(p[order[0]]), None if other is None else model.languages[other], bool(other is not None and p[order[0]] - p[other] < AMBIGUOUS)))
            yield pa.StructArray.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 4, (pa.string(), pa.float64(), pa.string(), pa.bool_()))], ["lang_pred", "score", "second", "ambiguous"])

    said = F.arrow_udf(run, shape)(F.col(text).cast("string"))
    names = ["lang_pred", "score", "second", "ambiguous"]
    return docs.drop(*names).withColumn("__said", said).select("*", *[F.col(f"__said.{c}").alias(c) for c in names]).drop("__said")


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", parts: int = 4, held: int = 2) -> DataFrame:
    """(key, held_out, lang_pred, score, second, ambiguous) for every row, learnt from the rows that are not held out."""
    out = _remainder(key, parts) == F.lit(held)
    model = fit(docs.where(~out), key, text, lang)
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"), out.alias("held_out"))
    said = predict(rows, model, "__text")
    return said.select(F.col("__key").alias(key), "held_out", "lang_pred", "score", "second", "ambiguous")


def keep_known(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language can be told at all: texts that are null or without a letter go, also where no language could be learnt."""
    model = fit(docs, key, text, lang)
    if model is None:
        small_batches(docs.sparkSession)

        def lettered(texts: pa.Array) -> pa.Array:
            return pa.array([ngram_counts(t) is not None for t in texts.to_pylist()], pa.bool_())

        return docs.where(F.arrow_udf(lettered, "boolean")(F.col(text).cast("string")))
    said = predict(docs.select(F.struct("*").alias("__row"), F.col(text).alias("__text")), model, "__text")
    return said.where(F.col("lang_pred") != UNKNOWN).select("__row.*")
