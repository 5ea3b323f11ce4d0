"""Text features, label sets, files."""

from __future__ import annotations

from pyspark.sql import functions as F

from feldspar.catalog.base import COMMENTS, comments, query, table
from feldspar.functions import text as tx
from feldspar.operators import groupstats as gs
from feldspar.operators import sets as so
from feldspar.operators import textfeatures as tf
from feldspar.sources import tables as io

DOCS = "SELECT doc_id, text FROM documents"
PUNCT = tx.SEPARATORS.replace("'", "''")
WORD = r"[\p{L}\p{N}_]*[a-zA-Z][\p{L}\p{N}_]*"

# Words left out by the query's stop list.
STOPS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "he", "her", "his", "i", "in", "is", "it", "of", "on",
    "or", "she", "so", "that", "the", "they", "this", "to", "was", "we", "were", "with", "you",
)


@query(
    "word_count",
    f"""SELECT doc_id, CAST(len(regexp_extract_all(translate(text, '{PUNCT}', '{" " * len(tx.SEPARATORS)}'), '\\S+')) AS INT) AS word_count
FROM documents""",
)
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.word_count(F.col("text")).alias("word_count"))


def _tfidf_sql(
    tokens: str, source: str = COMMENTS, min_df: str = "0", top: int | None = 10000, sublinear: bool = False, fit_all: bool = False, where: str = "TRUE", terms: str | None = None
) -> str:
    fit = "TRUE" if fit_all else "is_train = 1"
    tf_ = "(1 + ln(tf))" if sublinear else "tf"
    limit = f"ORDER BY total_tf DESC, term LIMIT {top}" if top else ""
    return f"""WITH c AS ({source}), n AS (SELECT count(*) AS n FROM c WHERE {fit}),
t AS ({terms or f"SELECT doc_id, is_train, unnest({tokens}) AS term FROM c"}),
k AS (SELECT doc_id, is_train, term, count(*) AS tf FROM t WHERE {where} GROUP BY 1, 2, 3),
v AS (SELECT term, sum(tf) AS total_tf, count(*) AS df FROM k WHERE {fit} GROUP BY 1 HAVING count(*) >= {min_df} * (SELECT n FROM n) {limit}),
w AS (SELECT doc_id, is_train, term, {tf_} * (ln((1 + n) / CAST(1 + df AS DOUBLE)) + 1) AS w FROM k JOIN v USING (term), n)
SELECT doc_id, is_train, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w"""


STRIPPED = "strip_accents(lower(comment_text))"
TFIDF_SQL = _tfidf_sql(f"regexp_extract_all({STRIPPED}, '{WORD}')", min_df="0.01")


@query("tfidf_word", TFIDF_SQL, rounds=["weight"])
def _(spark, d):
    return tf.tfidf(comments(spark, d), "doc_id", "comment_text", tf.word_analyzer(min_df=0.01))[0]


@query(
    "tfidf_word_columns",
    f"""WITH x AS ({TFIDF_SQL}) SELECT doc_id, """
    + ", ".join(f"coalesce(max(CASE WHEN term = '{t}' THEN weight END), 0.0) AS {t}_tfidf_word" for t in ("the", "and", "ing", "que"))
    + " FROM documents LEFT JOIN x USING (doc_id) GROUP BY doc_id",
    rounds=[f"{t}_tfidf_word" for t in ("the", "and", "ing", "que")],
)
def _(spark, d):
    df = comments(spark, d)
    long, _vocab = tf.tfidf(df, "doc_id", "comment_text", tf.word_analyzer(min_df=0.01))
    return tf.wide_terms(df.select("doc_id"), long, "doc_id", ["the", "and", "ing", "que"], "_word")[0]


@query(
    "tfidf_word_sublinear",
    _tfidf_sql(
        rf"regexp_extract_all({STRIPPED}, '[\p{{L}}\p{{N}}_]+')",
        sublinear=True,
        fit_all=True,
        where="term NOT IN (" + ", ".join(f"'{s}'" for s in STOPS) + ")",
    ),
    rounds=["weight"],
)
def _(spark, d):
    return tf.tfidf(comments(spark, d), "doc_id", "comment_text", tf.sublinear_word_analyzer(STOPS))[0]


def _ngram_sql(low: int = 2, high: int = 6, top: int = 50000) -> str:
    """N-grams of the white-space collapsed text, as runs of following characters."""
    body = rf"regexp_replace({STRIPPED}, '[\t\n\f\r\x0B ]+', ' ', 'g')"
    cells = ", ".join(f"lead(ch, {j}) OVER w AS ch{j}" for j in range(1, high))
    sizes = [
        f"SELECT doc_id, is_train, {' || '.join(['ch', *[f'ch{j}' for j in range(1, n)]])} AS term FROM g WHERE ch{n - 1} IS NOT NULL"
        for n in range(low, high + 1)
    ]
    terms = f"""WITH p AS (SELECT doc_id, is_train, unnest(chars) AS ch, generate_subscripts(chars, 1) AS i
    FROM (SELECT doc_id, is_train, string_split({body}, '') AS chars FROM c)),
  g AS (SELECT doc_id, is_train, ch, {cells} FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY i))
  {' UNION ALL '.join(sizes)}"""
    return _tfidf_sql("", top=top, sublinear=True, fit_all=True, terms=terms)


@query("tfidf_char_ngram", _ngram_sql(), rounds=["weight"])
def _(spark, d):
    """Sizes 2 to 6 and 50,000 columns."""
    return tf.tfidf(comments(spark, d), "doc_id", "comment_text", tf.char_analyzer())[0]


@query(
    "tfidf_char_ngram_full",
    f"WITH x AS ({_ngram_sql()}) SELECT doc_id, count(*) AS n_terms, max(weight) AS max_weight FROM x GROUP BY doc_id",
    rounds=["max_weight"],
)
def _(spark, d):
    """The same, summarised per document."""
    long, _vocab = tf.tfidf(comments(spark, d), "doc_id", "comment_text", tf.char_analyzer())
    return long.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"), F.max("weight").alias("max_weight"))


@query(
    "stack_features",
    f"""WITH a AS ({TFIDF_SQL}), b AS ({_tfidf_sql(f"regexp_extract_all({STRIPPED}, '[a-z]+')", top=500, fit_all=True)}),
va AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS i FROM (SELECT DISTINCT term FROM a WHERE is_train = 1)),
vb AS (SELECT term, row_number() OVER (ORDER BY term) - 1 + (SELECT count(*) FROM va) AS i FROM (SELECT DISTINCT term FROM b))
SELECT doc_id, va.i AS index, weight FROM a JOIN va USING (term) UNION ALL SELECT doc_id, vb.i, weight FROM b JOIN vb USING (term)""",
    rounds=["weight"],
)
def _(spark, d):
    df = comments(spark, d)
    letters = tf.Analyzer(lambda c: tx.words(c, "[a-z]+"), strip_accents=True, max_features=500, fit_on_test=True)
    blocks = [tf.tfidf(df, "doc_id", "comment_text", a) for a in (tf.word_analyzer(min_df=0.01), letters)]
    return tf.stack_features(blocks, "doc_id")[0]


CHI2_SQL = f"""WITH x AS ({TFIDF_SQL}), y AS (SELECT doc_id, toxic, quality FROM labels),
s AS (SELECT avg(toxic) AS pt, avg(quality) AS pq FROM y),
k AS (SELECT term, count(*) AS df, sum(toxic) AS ot, sum(quality) AS oq FROM x JOIN y USING (doc_id) WHERE is_train = 1 AND weight > 0 GROUP BY term),
z AS (SELECT term, df, 'toxic' AS target, power(ot - pt * df, 2) / (pt * df) + power(df - ot - (1 - pt) * df, 2) / ((1 - pt) * df) AS chi2 FROM k, s
  UNION ALL SELECT term, df, 'quality', power(oq - pq * df, 2) / (pq * df) + power(df - oq - (1 - pq) * df, 2) / ((1 - pq) * df) FROM k, s)"""
# Scores are rounded before they are ranked, so that equal scores tie on both sides.
RANKED_SQL = CHI2_SQL + """,
r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY round(chi2, 9) DESC, term) - 1 AS rank FROM z)"""


def _chi2(spark, d):
    df = comments(spark, d)
    long, _vocab = tf.tfidf(df, "doc_id", "comment_text", tf.word_analyzer(min_df=0.01))
    return tf.term_chi2(long, df, "doc_id", ["toxic", "quality"]).withColumn("chi2", F.round("chi2", 9))


@query("term_chi2", CHI2_SQL + " SELECT term, df, target, chi2 FROM z", rounds=["chi2"])
def _(spark, d):
    return _chi2(spark, d)


@query("rank_order", RANKED_SQL + " SELECT target, term, CAST(rank AS INT) AS rank FROM r")
def _(spark, d):
    return tf.rank_terms(_chi2(spark, d)).select("target", "term", "rank")


@query("topk_per_target_union", RANKED_SQL + " SELECT DISTINCT term FROM r WHERE rank < 150")
def _(spark, d):
    return tf.top_terms(_chi2(spark, d), 150).select("term").distinct()


@query("bag_of_words", RANKED_SQL + r" SELECT DISTINCT regexp_replace(term, '[^\x00-\x7F]', '', 'g') AS word FROM r WHERE rank < 150")
def _(spark, d):
    return tf.bag_of_words(_chi2(spark, d), 150)


@query(
    "vocabulary_union",
    f"""SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{WORD}')) AS term FROM documents SEMI JOIN labels USING (doc_id)
UNION SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{WORD}')) FROM documents ANTI JOIN labels USING (doc_id)""",
)
def _(spark, d):
    """Labelled and unlabelled documents, as train and test texts."""
    docs = comments(spark, d)
    frames = [f.select(F.explode(tx.words(F.col("comment_text"))).alias("term")) for f in (docs.filter("is_train = 1"), docs.filter("is_train = 0"))]
    return so.distinct_union(frames, "term")


EXIST = ("the", "and", "tion", "que", "The")


@query(
    "word_exist",
    "SELECT doc_id, " + ", ".join(f"CAST(contains(text, '{w}') AS INT) AS w_{w}{'_cap' if w == 'The' else ''}" for w in EXIST) + " FROM documents",
)
def _(spark, d):
    out, new = tf.word_exist(table(spark, d, "documents").select("doc_id", "text"), "text", EXIST[:4])
    return out.withColumn("w_The_cap", F.contains("text", F.lit("The")).cast("int")).select("doc_id", *new, "w_The_cap")


@query(
    "count_vectorize",
    """WITH t AS (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS term FROM documents),
v AS (SELECT term FROM t GROUP BY 1 HAVING count(DISTINCT doc_id) >= 0.05 * (SELECT count(*) FROM documents)),
k AS (SELECT doc_id, count(*) AS n_tokens, count(DISTINCT term) AS n_terms FROM t JOIN v USING (term) GROUP BY 1)
SELECT doc_id, coalesce(n_tokens, 0) AS n_tokens, coalesce(n_terms, 0) AS n_terms FROM documents LEFT JOIN k USING (doc_id)""",
)
def _(spark, d):
    """Token and term numbers per document, read from its count vector over the terms of at least 5 % of documents."""
    docs = table(spark, d, "documents").select("doc_id", F.split(F.lower("text"), " ").alias("tokens"))
    counted = tf.count_vectorize(docs, "tokens", 0.05, "counts").select("doc_id", F.unwrap_udt("counts")["values"].alias("c"))
    return counted.select(
        "doc_id",
        F.aggregate("c", F.lit(0.0), lambda a, x: a + x).cast("long").alias("n_tokens"),
        F.size("c").cast("long").alias("n_terms"),
    )


@query(
    "hash_vectorize",
    "SELECT doc_id, CAST(len(string_split(lower(text), ' ')) AS BIGINT) AS n_tokens FROM documents",
)
def _(spark, d):
    """Hashed term counts keep every token: their sum is the token count."""
    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import vector_to_array

    docs = table(spark, d, "documents").select("doc_id", F.split(F.lower("text"), " ").alias("tokens"))
    hashed = HashingTF(inputCol="tokens", outputCol="counts", numFeatures=1 << 12).transform(docs)
    total = F.aggregate(vector_to_array("counts"), F.lit(0.0), lambda a, x: a + x)
    return hashed.select("doc_id", total.cast("long").alias("n_tokens"))


@query("ascii_fold", "SELECT doc_id, regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g') AS folded FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.ascii_fold(F.col("text")).alias("folded"))


NORMALIZED = r"lower(regexp_replace(replace(regexp_replace(text, '[^\x00-\x7F]', '', 'g'), chr(10), ' '), '([.!?,''/()\\])', ' \1 ', 'g'))"


@query("text_normalize", f"SELECT doc_id, {NORMALIZED} AS text FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.normalize(F.col("text")).alias("text"))


@query("label_string", "SELECT doc_id, '__label__' || CAST(toxic AS VARCHAR) AS label FROM labels")
def _(spark, d):
    return table(spark, d, "labels").select("doc_id", tx.label(F.col("toxic")).alias("label"))


@query(
    "normalize_label_prob",
    "SELECT doc_id, toxic, CASE WHEN toxic = 0 THEN 1 - p ELSE p END AS p FROM (SELECT doc_id, toxic, (doc_id % 97) / 97.0 AS p FROM labels)",
    rounds=["p"],
)
def _(spark, d):
    df = table(spark, d, "labels").select("doc_id", "toxic", ((F.col("doc_id") % 97) / F.lit(97.0)).alias("p"))
    return tf.normalize_label_prob(df, "toxic", "p")


# ---- label sets ----

LABELS4 = """SELECT doc_id, toxic, quality, CAST(CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS INT) AS insult,
  CAST(CASE WHEN doc_id % 5 = 0 THEN toxic ELSE 0 END AS INT) AS threat FROM labels"""
TARGETS = ["toxic", "quality", "insult", "threat"]


def _labels(spark, d):
    return table(spark, d, "labels").selectExpr(
        "doc_id",
        "toxic",
        "quality",
        "CAST(CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS INT) AS insult",
        "CAST(CASE WHEN doc_id % 5 = 0 THEN toxic ELSE 0 END AS INT) AS threat",
    )


def _overlap_sql() -> str:
    parts = []
    for a in TARGETS:
        for b in TARGETS:
            if a != b:
                parts.append(f"SELECT '{a}' AS label, '{b}' AS other, avg(CASE WHEN {b} = 1 THEN 1.0 ELSE 0.0 END) AS ratio FROM l WHERE {a} = 1")
        others = " AND ".join(f"{b} = 0" for b in TARGETS if b != a)
        parts.append(f"SELECT '{a}', NULL, avg(CASE WHEN {others} THEN 1.0 ELSE 0.0 END) FROM l WHERE {a} = 1")
    return f"WITH l AS ({LABELS4}) " + "\nUNION ALL ".join(parts)


@query("label_overlap_matrix", _overlap_sql(), rounds=["ratio"])
def _(spark, d):
    return gs.label_overlap(_labels(spark, d), TARGETS)


@query("label_intersect_ratio", "SELECT avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END) AS ratio FROM labels WHERE toxic = 1", rounds=["ratio"])
def _(spark, d):
    return so.label_intersect_ratio(_labels(spark, d), "toxic", "quality")


@query(
    "label_only_ratio",
    f"SELECT avg(CASE WHEN quality = 0 AND insult = 0 AND threat = 0 THEN 1.0 ELSE 0.0 END) AS ratio FROM ({LABELS4}) WHERE toxic = 1",
    rounds=["ratio"],
)
def _(spark, d):
    return so.label_only_ratio(_labels(spark, d), "toxic", ["quality", "insult", "threat"])


@query(
    "rows_with_no_label",
    f"SELECT *, CAST(CASE WHEN greatest(toxic, quality, insult, threat) = 0 THEN 1 ELSE 0 END AS INT) AS non_toxic FROM ({LABELS4})",
)
def _(spark, d):
    return so.rows_with_no_label(_labels(spark, d), TARGETS)


@query("filter_by_label", f"SELECT doc_id, comment_text, toxic FROM ({COMMENTS}) WHERE toxic = 1 ORDER BY doc_id LIMIT 5")
def _(spark, d):
    from feldspar.operators.profile import filter_by_label

    return filter_by_label(comments(spark, d), "toxic", ["doc_id"]).select("doc_id", "comment_text", "toxic")


# ---- files ----


@query("scan_csv", "SELECT doc_id, text, lang, n_chars FROM documents")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "n_chars")
    path = io.scratch_path(spark, "csv")
    io.write_csv(docs, path)
    return io.scan_csv(spark, path, docs.schema)


@query("fill_text_nulls", "SELECT doc_id, coalesce(CASE WHEN doc_id % 4 <> 0 THEN text END, ' ') AS text, n_chars FROM documents")
def _(spark, d):
    df = table(spark, d, "documents").selectExpr("doc_id", "CASE WHEN doc_id % 4 <> 0 THEN text END AS text", "n_chars")
    return io.fill_text_nulls(df)


@query("sink_predictions", "SELECT doc_id AS id, toxic / 2.0 AS toxic, quality / 4.0 AS quality FROM labels", rounds=["toxic", "quality"])
def _(spark, d):
    df = table(spark, d, "labels").select(F.col("doc_id").alias("id"), (F.col("toxic") / 2).alias("toxic"), (F.col("quality") / 4).alias("quality"))
    path = io.scratch_path(spark, "predictions")
    io.sink_predictions(df, "id", ["toxic", "quality"], path)
    return io.scan_csv(spark, path, "id long, toxic double, quality double")


@query("sink_csv_gz", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = io.gz_path("orders", io.scratch_path(spark, "gz") + "/")
    io.sink_csv_gz(df, path)
    return io.scan_csv_gz(spark, path, df.schema)


LINES = f"""SELECT {NORMALIZED} AS text, y AS label, target, is_train AS split FROM
  (SELECT d.text, l.toxic AS y, 'toxic' AS target, CAST(l.doc_id % 2 AS INT) AS is_train FROM documents d JOIN labels l ON d.doc_id = l.doc_id
   UNION ALL SELECT d.text, l.quality, 'quality', CAST(l.doc_id % 2 AS INT) FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def _written_lines(spark, d):
    df = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    df = df.withColumn("split", (F.col("doc_id") % 2).cast("int"))
    path = io.scratch_path(spark, "labeled")
    io.sink_labeled_text(df, "text", ["toxic", "quality"], "split", path)
    return path


@query("sink_labeled_text", f"SELECT text || ' __label__' || label AS value, target, split FROM ({LINES})")
def _(spark, d):
    return spark.read.text(_written_lines(spark, d))


@query("scan_labeled_text", f"SELECT CASE WHEN text = '' THEN ' ' ELSE text END AS text, CAST(label AS INT) AS label, TRUE AS ok, target, split FROM ({LINES})")
def _(spark, d):
    return io.scan_labeled_text(spark, _written_lines(spark, d))


@query("save_load_table", "SELECT * FROM orders")
def _(spark, d):
    path = io.scratch_path(spark, "table")
    io.save_table(table(spark, d, "orders"), path)
    return io.load_table(spark, path)
