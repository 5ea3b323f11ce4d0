"""Text expressions, all evaluated by Spark: no text goes through Python workers."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token patterns, with letter and digit classes spelled out.
WORD_WITH_LETTER = r"[\p{L}\p{N}_]*[a-zA-Z][\p{L}\p{N}_]*"
ANY_WORD = r"[\p{L}\p{N}_]+"

# Fixed value: the ASCII punctuation marks that separate words (all but the apostrophe).
SEPARATORS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def word_count(text: Column) -> Column:
    """Number of white-space separated words after punctuation is blanked."""
    return F.regexp_count(F.translate(text, SEPARATORS, " " * len(SEPARATORS)), F.lit(r"\S+"))


# Fixed value: every character with a combining class.
COMBINING = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.combining(c))


def _when_not_ascii(text: Column, reduced: Callable[[Column], Column]) -> Column:
    """``reduced`` of the text's NFKD form, by the ICU library in Spark's class path. ASCII text, a byte per character, stays as it is."""
    nfkd = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), F.coalesce(text, F.lit("")), F.lit(True))
    return F.when(F.octet_length(text) > F.char_length(text), reduced(nfkd)).otherwise(text)


def strip_accents(text: Column) -> Column:
    """Decompose (NFKD) and drop combining marks (without a regular expression, which would slow those that find the words)."""
    return _when_not_ascii(text, lambda t: F.translate(t, COMBINING, ""))


def ascii_fold(text: Column) -> Column:
    """Decompose (NFKD) and drop everything outside ASCII."""
    return _when_not_ascii(text, lambda t: F.regexp_replace(t, r"[^\x00-\x7F]+", ""))


def normalize(text: Column) -> Column:
    """Drop non-ASCII, newline to space, spaces round punctuation marks, lower-case."""
    ascii_only = F.regexp_replace(text, r"[^\x00-\x7F]", "")
    one_line = F.regexp_replace(ascii_only, "\n", " ")
    return F.lower(F.regexp_replace(one_line, r"([.!?,'/()\\])", " $1 "))


def label(value: Column) -> Column:
    return F.concat(F.lit("__label__"), value.cast("string"))


def words(text: Column, pattern: str = WORD_WITH_LETTER) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def one_spaced(text: Column) -> Column:
    """The lower-cased text, white space collapsed."""
    return F.regexp_replace(F.lower(text), r"\s+", " ")


def char_ngrams(text: Column, low: int, high: int) -> Column:
    """All character n-grams of low..high characters of the whole lower-cased text, white space collapsed.

    The text is cut into characters once and n-grams are joined from single elements: substring() would walk
    the UTF-8 text, and slice() copy the array, once per n-gram.
    """
    chars = F.split(one_spaced(text), "")

    def of_size(c: Column, n: int) -> Column:
        last = F.size(c) - n
        starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(*[F.get(c, i + j) for j in range(n)]))

    # transform() over a one-element array binds the characters, so they are not computed again per n-gram.
    return F.flatten(F.transform(F.array(chars), lambda c: F.flatten(F.array(*[of_size(c, n) for n in range(low, high + 1)]))))


def counted(terms: Column) -> Column:
    """array<struct<term, tf>>: the distinct terms of an array and how often each occurs, by runs of the sorted array."""

    def runs(s: Column) -> Column:
        places = F.when(F.size(s) > 0, F.sequence(F.lit(0), F.size(s) - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return F.transform(F.array(starts), lambda a: F.transform(a, lambda i, j: F.struct(F.get(s, i).alias("term"), (F.coalesce(F.get(a, j + 1), F.size(s)) - i).cast("long").alias("tf"))))[0]

    # transform() over a one-element array binds what is used more than once.
    return F.transform(F.array(F.sort_array(F.coalesce(terms, F.array().cast("array<string>")))), runs)[0]
