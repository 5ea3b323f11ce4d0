"""TF-IDF in long form (key, term, weight), chi-square terms, bag of words.

Texts are not shuffled: the terms of a document are counted inside its row, so the vocabulary's aggregate starts from
one row per (document, term) and combines them before its exchange. A vocabulary of at most ``max_features`` terms is a
fitted count model; weights and the L2 norm are computed inside the row as well. Without that bound the vocabulary is
measured before it is broadcast, and the counted rows join it. Terms are formed twice, once for the vocabulary and once
for the weights: written counts of n-grams would take many times the bytes of the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, StopWordsRemover
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feldspar.functions import ngrams as ng
from feldspar.functions import text as tx
from feldspar.operators.profile import TRAIN, q
from feldspar.plans.lookup import lookup_join
from feldspar.plans.ordering import POSITION, group_positions, with_position
from feldspar.plans.spread import spread_scan
from feldspar.plans.storage import materialize


@dataclass(frozen=True)
class Analyzer:
    """How a text column becomes an array of terms, and which terms and weights are kept."""

    terms: Callable[[Column], Column]
    strip_accents: bool = False
    stop_words: tuple[str, ...] = ()
    sublinear: bool = False
    min_df: float | int = 1
    max_features: int | None = 10_000
    fit_on_test: bool = False
    #: Sizes of the character n-grams that ``terms`` forms, where it forms these.
    ngrams: tuple[int, int] | None = None


def english_stop_words() -> tuple[str, ...]:
    """The engine's own English list; pass another tuple to :class:`Analyzer` where a different list is wanted."""
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def word_analyzer(min_df: float | int = 0.001, max_features: int | None = 10_000, strip_accents: bool = True) -> Analyzer:
    """Words with at least one ASCII letter, raw counts, fitted on the train rows."""
    return Analyzer(lambda c: tx.words(c, tx.WORD_WITH_LETTER), strip_accents, (), False, min_df, max_features)


def sublinear_word_analyzer(stop_words: Sequence[str] | None = None, max_features: int | None = 10_000) -> Analyzer:
    """Any word outside the stop list, 1 + ln(tf), fitted on train and test rows."""
    stops = english_stop_words() if stop_words is None else tuple(stop_words)
    return Analyzer(lambda c: tx.words(c, tx.ANY_WORD), True, stops, True, 1, max_features, True)


def char_analyzer(low: int = 2, high: int = 6, max_features: int | None = 50_000) -> Analyzer:
    """Character n-grams of the whole text, 1 + ln(tf), fitted on train and test rows."""
    return Analyzer(lambda c: tx.char_ngrams(c, low, high), True, (), True, 1, max_features, True, (low, high))


def document_terms(df: DataFrame, key: str, text: str, a: Analyzer, keep: Sequence[str] = ()) -> DataFrame:
    """(key, is_train, columns to keep, __terms): the array of a document's terms, empty for a null text."""
    terms = F.coalesce(a.terms(_body(text, a)), F.array().cast("array<string>"))
    if a.stop_words:
        terms = F.filter(terms, lambda t: ~t.isin(*a.stop_words))
    others = [q(c) for c in (key, TRAIN, *keep)]
    return spread_scan(df.select(*others, q(text))).select(*others, terms.alias("__terms"))


def _body(text: str, a: Analyzer) -> Column:
    return tx.strip_accents(F.lower(q(text))) if a.strip_accents else F.lower(q(text))


def _gram_texts(df: DataFrame, key: str, text: str, a: Analyzer) -> DataFrame:
    """(key, is_train, __text): the texts whose characters make the n-grams."""
    return spread_scan(df.select(q(key), q(TRAIN), q(text))).select(q(key), q(TRAIN), tx.one_spaced(_body(text, a)).alias("__text"))


def gram_counts(texts: DataFrame, low: int, high: int) -> DataFrame:
    """(term, tf, df) of the n-grams of ``__text``, counted and added up where the texts lie; a term comes once per ``HELD`` n-grams at least."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            column = batch.column(0)
            for start, stop in ng.pieces(column):
                for g in ng.grams(column[start:stop].to_pylist(), low, high):
                    tf = np.bincount(g.gram, g.count).astype(np.int64)
                    held.append(pa.record_batch([g.terms, pa.array(tf), pa.array(np.bincount(g.gram))], ["term", "tf", "df"]))
                    rows += len(tf)
                if rows > ng.HELD:
                    sums = ng.added(held)
                    held, rows = sums.to_batches(), sums.num_rows
                    pa.default_memory_pool().release_unused()
                    if rows > ng.HELD // 2:
                        yield from held
                        held, rows = [], 0
        if held:
            yield from ng.added(held).to_batches()

    return texts.select("__text").mapInArrow(counted, "term string, tf long, df long")


def _gram_weights(texts: DataFrame, vocab: DataFrame, key: str, a: Analyzer) -> DataFrame:
    """(key, is_train, term, weight) of the n-grams in the vocabulary, formed where the texts lie."""
    rows = vocab.select("term", "idf").collect()  # max_features rows at most
    names = texts.sparkSession.createDataFrame([(i, r["term"]) for i, r in enumerate(rows)], "__at int, term string")
    cells = gram_cells(texts, [(r["term"], r["idf"]) for r in rows], a).select(key, TRAIN, F.inline(F.arrays_zip("__at", "__w")))
    return cells.join(F.broadcast(names), "__at").select(key, TRAIN, "term", F.col("__w").alias("weight"))


def gram_cells(texts: DataFrame, known: Sequence[tuple[str, float]], a: Analyzer, coefficients: np.ndarray | None = None) -> DataFrame:
    """``texts`` with ``__at``, ``__w`` instead of ``__text``: the places among the ``known`` (n-gram, idf), ascending, and the L2-normalised weights.

    With ``coefficients`` (models, places) there is an array ``__margin`` instead, the sum of weight times coefficient for each model.
    """
    terms, idf = [t for t, _ in known], np.array([w for _, w in known], np.float64)
    (low, high), sublinear = a.ngrams, a.sublinear
    lists = {"__at": T.ArrayType(T.IntegerType()), "__w": T.ArrayType(T.DoubleType())} if coefficients is None else {"__margin": T.ArrayType(T.DoubleType())}
    kept = [i for i, c in enumerate(texts.columns) if c != "__text"]
    schema = T.StructType([*(texts.schema[i] for i in kept), *(T.StructField(*x) for x in lists.items())])
    of_text = texts.columns.index("__text")

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sized = [np.array([i for i, t in enumerate(terms) if len(t) == n], np.int64) for n in range(low, high + 1)]
        values = [pa.array([terms[i] for i in of], pa.string()) for of in sized]
        for batch in batches:
            column = batch.column(of_text)
            for start, stop in ng.pieces(column):
                cells = [(np.empty(0, np.int64),) * 3]
                for g, of, value in zip(ng.grams(column[start:stop].to_pylist(), low, high), sized, values):
                    found = pc.fill_null(pc.index_in(g.terms, value_set=value), -1).to_numpy(zero_copy_only=False)[g.gram]
                    held = found >= 0
                    cells.append((g.document[held], of[found[held]], g.count[held]))
                document, place, count = ng.by_document(*(np.concatenate(c) for c in zip(*cells)))
                weight = (1.0 + np.log(count) if sublinear else count) * idf[place]
                weight /= np.sqrt(np.bincount(document, weight * weight, stop - start))[document]
                if coefficients is None:
                    ends = pa.array(np.searchsorted(document, np.arange(stop - start + 1)).astype(np.int32))
                    made = [pa.ListArray.from_arrays(ends, x) for x in (pa.array(place.astype(np.int32)), pa.array(weight))]
                else:
                    made = [_margins(document, place, weight, stop - start, coefficients)]
                out = pa.record_batch([*(batch.column(i).slice(start, stop - start) for i in kept), *made], schema.names)
                yield from (out.slice(at, 64) for at in range(0, out.num_rows, 64))

    return texts.mapInArrow(weighed, schema)


def _margins(row: np.ndarray, place: np.ndarray, weight: np.ndarray, rows: int, coefficients: np.ndarray) -> pa.ListArray:
    sums = np.stack([np.bincount(row, weight * c[place], rows) for c in coefficients], 1)
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * len(coefficients)), pa.array(sums.ravel()))


def term_counts(docs: DataFrame) -> DataFrame:
    """Every column of ``docs`` but the terms, with a row (term, tf) per distinct term of a document."""
    others = [q(c) for c in docs.columns if c != "__terms"]
    return docs.select(*others, F.inline(tx.counted(F.col("__terms"))))


def vocabulary(df: DataFrame, counts: DataFrame, a: Analyzer) -> DataFrame:
    """(term, total_tf, df, idf) of the counted rows that are fitted on: enough documents, then the most frequent terms (ties by term)."""
    docs = df if a.fit_on_test else df.filter(q(TRAIN) == 1)
    n = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    documents = F.sum("df") if "df" in counts.columns else F.count(F.lit(1))
    table = counts.groupBy("term").agg(F.sum("tf").alias("total_tf"), documents.alias("df"))
    least = F.lit(a.min_df) * n if isinstance(a.min_df, float) else F.lit(a.min_df)
    table = table.filter(F.col("df") >= least)
    if a.max_features is not None:
        table = table.orderBy(F.desc("total_tf"), "term").limit(a.max_features)
    return table.withColumn("idf", F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0))


def in_batches(a: Analyzer) -> bool:
    """Whether the terms are character n-grams that are counted in Arrow batches."""
    return bool(a.ngrams) and not a.stop_words and a.max_features is not None


def fitted(df: DataFrame, key: str, text: str, a: Analyzer) -> DataFrame:
    """The written vocabulary (term, total_tf, df, idf) of a text column."""
    if in_batches(a):
        texts = _gram_texts(df, key, text, a)
        return materialize(vocabulary(df, gram_counts(texts if a.fit_on_test else texts.filter(q(TRAIN) == 1), *a.ngrams), a))
    docs = document_terms(df, key, text, a)
    return materialize(vocabulary(df, term_counts(docs.filter(q(TRAIN) == 1) if not a.fit_on_test else docs), a))


def tfidf(df: DataFrame, key: str, text: str, a: Analyzer) -> tuple[DataFrame, DataFrame]:
    """Long (key, is_train, term, weight) with L2-normalised weights, and the vocabulary."""
    vocab = fitted(df, key, text, a)
    if in_batches(a):
        return _gram_weights(_gram_texts(df, key, text, a), vocab, key, a), vocab
    docs = document_terms(df, key, text, a)
    if a.max_features is not None:
        return _weights_in_row(docs, vocab, key, a), vocab
    rows = lookup_join(term_counts(docs), vocab.select("term", "df", "idf"), ["term"], weight="df", null_safe=False, stored=True)
    rows = rows.filter(F.col("idf").isNotNull())
    tf = F.col("tf").cast("double")
    rows = rows.withColumn("__w", (F.lit(1.0) + F.log(tf) if a.sublinear else tf) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("__w") * F.col("__w")).over(Window.partitionBy(key)))
    return rows.select(key, TRAIN, "term", (F.col("__w") / norm).alias("weight")), vocab


def best_terms(table: DataFrame, most: int) -> list[tuple[str, float]]:
    """The ``most`` most frequent (term, idf) of a vocabulary (ties by term), in the order of the terms."""
    best = table.orderBy(F.desc("total_tf"), "term").limit(most).select("term", "idf").collect()
    return sorted((r["term"], r["idf"]) for r in best)


def _scaled(docs: DataFrame, known: Sequence[tuple[str, float]], tf: str, out: str) -> DataFrame:
    counts = CountVectorizerModel.from_vocabulary([t for t, _ in known], inputCol="__terms", outputCol=tf)
    scale = ElementwiseProduct(scalingVec=Vectors.dense([w for _, w in known]), inputCol=tf, outputCol=out)
    return scale.transform(counts.transform(docs))


def count_vectorize(docs: DataFrame, terms: str, min_df: float, name: str) -> DataFrame:
    """``docs`` with the counts of the terms of at least a share ``min_df`` of all rows, as a sparse vector; a null array has none.

    The document frequencies are an aggregate: a CountVectorizer's own fit would hold the term arrays of all rows in memory.
    The vocabulary, on the driver, has at most the mean number of distinct terms over ``min_df``.
    """
    docs = docs.withColumn(terms, F.coalesce(q(terms), F.array().cast("array<string>")))
    each = docs.select(F.explode(F.array_distinct(q(terms))).alias("term"))
    frequent = each.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= F.lit(min_df) * docs.count())
    known = sorted(r["term"] for r in frequent.select("term").collect())
    if not known:
        known, docs = [""], docs.withColumn(terms, F.array().cast("array<string>"))  # a vector has one place at least
    return CountVectorizerModel.from_vocabulary(known, inputCol=terms, outputCol=name).transform(docs)


def with_vectors(docs: DataFrame, known: Sequence[tuple[str, float]], name: str) -> DataFrame:
    """``docs`` with the L2-normalised counts times idf of the known terms as a sparse vector, formed inside the row."""
    known = known or [("", 1.0)]  # a vector has one place at least; no word is empty
    scaled = _scaled(docs, known, "__tf", "__tfidf")
    return Normalizer(p=2.0, inputCol="__tfidf", outputCol=name).transform(scaled).drop("__tf", "__tfidf")


def _word_weights(docs: DataFrame, known: Sequence[tuple[str, float]], a: Analyzer) -> DataFrame:
    """``docs`` with ``__at``, ``__w`` instead of ``__terms``: the places among the ``known`` (term, idf), ascending, and the weights before they are normalised."""
    others = [q(c) for c in docs.columns if c != "__terms"]
    vectors = _scaled(docs, known or [("", 1.0)], "__tf", "__tfidf")  # no word is empty
    held = vectors.select(*others, F.unwrap_udt("__tf").alias("__t"), F.unwrap_udt("__tfidf")["values"].alias("__w"))
    if a.sublinear:
        held = held.withColumn("__w", F.transform("__w", lambda w, i: w * (F.lit(1.0) + F.log(F.get("__t.values", i))) / F.get("__t.values", i)))
    return held.select(*others, F.col("__t.indices").alias("__at"), "__w")


def _unit(w: pa.Array) -> pa.Array:
    """Lists of numbers over their L2 norms."""
    row, weight = (x.to_numpy(zero_copy_only=False) for x in (pc.list_parent_indices(w), pc.list_flatten(w)))
    ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(w))))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(weight / np.sqrt(np.bincount(row, weight * weight, len(w)))[row]))


def _weights_in_row(docs: DataFrame, vocab: DataFrame, key: str, a: Analyzer) -> DataFrame:
    """(key, is_train, term, weight): a count model over the vocabulary and its scaling by idf, no exchange of documents."""
    known = sorted((r["term"], r["idf"]) for r in vocab.select("term", "idf").collect())  # max_features rows at most
    if not known:
        return docs.select(key, TRAIN, F.lit("").alias("term"), F.lit(0.0).alias("weight")).where("false")
    norm = F.sqrt(F.aggregate("__w", F.lit(0.0), lambda s, w: s + w * w))
    held = _word_weights(docs.select(key, TRAIN, "__terms"), known, a).withColumn("norm", norm)
    cells = held.select(key, TRAIN, "norm", F.inline(F.arrays_zip("__at", "__w")))
    names = docs.sparkSession.createDataFrame([(i, t) for i, (t, _) in enumerate(known)], "__at int, term string")
    return cells.join(F.broadcast(names), "__at").select(key, TRAIN, "term", (F.col("__w") / F.col("norm")).alias("weight"))


def _blocks(df: DataFrame, text: str, analyzers: Sequence[Analyzer], known: Sequence[Sequence[tuple[str, float]]], coefficients: Sequence[np.ndarray | None]) -> DataFrame:
    """``df`` without its text, with ``__at0``, ``__w0``, ``__at1`` ..., or ``__margin0`` ... where there are coefficients. Nothing is exploded or exchanged."""
    rows = spread_scan(df)
    for i, (a, terms, models) in enumerate(zip(analyzers, known, coefficients)):
        if in_batches(a):
            rows = gram_cells(rows.withColumn("__text", tx.one_spaced(_body(text, a))), terms, a, models)
        else:
            found = F.coalesce(a.terms(_body(text, a)), F.array().cast("array<string>"))
            found = F.filter(found, lambda t: ~t.isin(*a.stop_words)) if a.stop_words else found
            rows = _word_weights(rows.withColumn("__terms", found), terms, a)
            # Not an expression: a norm would be worked out anew for every weight.
            rows = rows.withColumn("__w", F.arrow_udf(_unit, "array<double>")("__w"))
            if models is not None:
                rows = rows.withColumn("__margin", _margin_of(models)("__at", "__w")).drop("__at", "__w")
        rows = rows.withColumnsRenamed({"__at": f"__at{i}", "__w": f"__w{i}", "__margin": f"__margin{i}"})
    return rows.drop(text)


def _margin_of(models: np.ndarray) -> Callable[..., Column]:
    def margins(at: pa.Array, w: pa.Array) -> pa.Array:
        row, place, weight = (x.to_numpy(zero_copy_only=False) for x in (pc.list_parent_indices(at), pc.list_flatten(at), pc.list_flatten(w)))
        return _margins(row, place, weight, len(at), models)

    return F.arrow_udf(margins, "array<double>")


def stacked_cells(df: DataFrame, text: str, analyzers: Sequence[Analyzer], known: Sequence[Sequence[tuple[str, float]]]) -> DataFrame:
    """``df`` without its text, with ``__at`` and ``__w``: the cells of all blocks side by side, formed inside the row.

    ``known`` has the (term, idf) of each analyzer, each bounded by ``max_features``.
    """
    rows, at, offset = _blocks(df, text, analyzers, known, [None] * len(analyzers)), [], 0
    for i, terms in enumerate(known):
        start = F.lit(offset)
        at.append(F.transform(f"__at{i}", lambda x: x + start) if offset else F.col(f"__at{i}"))  # called at once
        offset += len(terms)
    w = F.concat(*[F.col(f"__w{i}") for i in range(len(known))])
    return rows.select(*[q(c) for c in df.columns if c != text], F.concat(*at).alias("__at"), w.alias("__w"))


def stacked_margins(df: DataFrame, text: str, analyzers: Sequence[Analyzer], known: Sequence[Sequence[tuple[str, float]]], coefficients: np.ndarray) -> DataFrame:
    """``df`` without its text, with ``__margin``: for each model (a row of ``coefficients``) the sum over the stacked cells of weight times coefficient."""
    ends = np.cumsum([len(terms) for terms in known])[:-1]
    rows = _blocks(df, text, analyzers, known, np.split(coefficients, ends, axis=1))
    total = F.array(*[sum((F.col(f"__margin{i}")[m] for i in range(1, len(known))), F.col("__margin0")[m]) for m in range(len(coefficients))])
    return rows.select(*[q(c) for c in df.columns if c != text], total.alias("__margin"))


def wide_terms(df: DataFrame, long: DataFrame, key: str, terms: Sequence[str], postfix: str = "") -> tuple[DataFrame, list[str]]:
    """One column ``<term>_tfidf<postfix>`` per listed term, 0 where the document lacks it."""
    names = [f"{t}_tfidf{postfix}" for t in terms]
    cells = long.filter(F.col("term").isin(*terms)).groupBy(key).agg(
        *[F.max(F.when(F.col("term") == t, F.col("weight"))).alias(n) for t, n in zip(terms, names)]
    )
    out = df.drop(*names).join(cells, key, "left")
    return out.withColumns({n: F.coalesce(q(n), F.lit(0.0)) for n in names}), names


def stack_features(blocks: Sequence[tuple[DataFrame, DataFrame]], key: str) -> tuple[DataFrame, DataFrame]:
    """Bind sparse blocks side by side: long (key, index, weight), and (block, term, index) of all columns.

    Each block is (long weights, vocabulary); terms are numbered in sorted order.
    """
    parts, catalogs, offset = [], [], 0
    for i, (long, vocab) in enumerate(blocks):
        placed = with_position(vocab.select("term", "df"), [F.col("term")])
        numbered = materialize(placed.select("term", "df", (F.col(POSITION) + offset).alias("index")))
        parts.append(lookup_join(long, numbered, ["term"], weight="df", null_safe=False, stored=True).select(key, "index", "weight"))
        catalogs.append(numbered.select(F.lit(i).alias("block"), "term", "index"))
        offset += numbered.count()
    out, catalog = parts[0], catalogs[0]
    for p, c in zip(parts[1:], catalogs[1:]):
        out, catalog = out.unionByName(p), catalog.unionByName(c)
    return out, catalog


def sparse_vector(size: Column, indices: Column, values: Column) -> Column:
    """A sparse vector from arrays without Python: the parser knows the vector's storage struct."""
    body = F.struct(F.lit(0).alias("type"), size.cast("int").alias("size"), indices.alias("indices"), values.alias("values"))
    schema = T.StructType([T.StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(body.alias("v"))), schema)["v"]


def term_chi2(long: DataFrame, labels: DataFrame, key: str, targets: Sequence[str]) -> DataFrame:
    """Long (target, term, df, chi2) of term presence: observed against class share times document frequency."""
    present = long.filter((q(TRAIN) == 1) & (F.col("weight") > 0)).select(key, "term")
    y = labels.filter(q(TRAIN) == 1).select(key, *targets)
    n = y.agg(F.count(F.lit(1)).alias("n")).scalar().cast("double")
    counts = present.join(y, key).groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), *[F.count_if(q(t) == 1).alias(f"__one{i}") for i, t in enumerate(targets)]
    )
    cells = []
    for i, t in enumerate(targets):
        share = y.agg(F.count_if(q(t) == 1).alias("s")).scalar() / n
        chi2 = F.lit(0.0)
        for observed, part in ((F.col(f"__one{i}"), share), (F.col("df") - F.col(f"__one{i}"), F.lit(1.0) - share)):
            expected = F.nullif(part * F.col("df"), F.lit(0.0))
            chi2 = chi2 + (observed - expected) * (observed - expected) / expected
        cells.append(F.struct(F.lit(t).alias("target"), chi2.alias("chi2")))
    return counts.select("term", "df", F.inline(F.array(*cells)))


def rank_terms(chi2: DataFrame) -> DataFrame:
    """Rank (0 = best) of every term per target, from positions in one cluster-wide order."""
    falling = -F.coalesce(F.col("chi2"), F.lit(float("-inf")))
    ranked = group_positions(chi2, ["target"], [falling, F.col("term")])
    return ranked.withColumn("rank", F.col(POSITION).cast("int")).drop(POSITION, "__n")


def top_terms(chi2: DataFrame, k: int = 150) -> DataFrame:
    """The k best terms per target. The limit is applied before the shuffle, so a target never fills a task."""
    best = Window.partitionBy("target").orderBy(F.desc_nulls_last("chi2"), "term")
    return chi2.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).withColumn("rank", F.col("rank") - 1)


def bag_of_words(chi2: DataFrame, k: int = 150) -> DataFrame:
    """Union over targets of the k best terms, ASCII-folded: one ``word`` per row (at most k per target)."""
    words = top_terms(chi2, k).select("term").distinct()
    return words.select(tx.ascii_fold(F.col("term")).alias("word")).distinct()


def word_exist(df: DataFrame, text: str, words: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """One 0/1 column ``w_<word>`` per word: case-sensitive substring test."""
    new = {f"w_{w}": F.contains(q(text), F.lit(w)).cast("int") for w in words}
    return df.withColumns(new), list(new)


def word_exist_array(df: DataFrame, text: str, words: Sequence[str], name: str = "word_exist") -> DataFrame:
    """The same flags for hundreds of words, as one array."""
    table = F.array(*[F.lit(w) for w in words])
    return df.withColumn(name, F.transform(table, lambda w: F.contains(q(text), w).cast("int")))


def normalize_label_prob(df: DataFrame, label: str, prob: str) -> DataFrame:
    """Probability of the predicted label becomes the probability of class 1."""
    return df.withColumn(prob, F.when(q(label) == 0, F.lit(1.0) - q(prob)).otherwise(q(prob)))
