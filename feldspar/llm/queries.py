"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STEPS = ", ".join(
    f"('{''.join(order)}', {k + 1}, {sum(1 << 'ABCDE'.index(f) for f in order[:k])}, {1 << 'ABCDE'.index(name)})"
    for order in permutations("ABCDE")
    for k, name in enumerate(order)
)
_AUDIT = f"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
e AS (SELECT text, min(doc_id) AS first_id FROM d GROUP BY text),
m AS (SELECT d.part,
    (CASE WHEN len(words) < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 5 * length(d.text) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(d.text, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN d.doc_id > e.first_id THEN 16 ELSE 0 END) AS mask,
    CASE WHEN d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) THEN 1 ELSE 0 END AS good,
    CASE WHEN d.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) THEN 1 ELSE 0 END AS bad
  FROM d JOIN e ON e.text = d.text),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM m GROUP BY part, mask),
o(filter_order, step, prefix, bit) AS (VALUES {_STEPS}),
r AS (SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (prefix | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & prefix = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & prefix <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & prefix = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & prefix = 0 AND mask & bit <> 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM c, o GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op8_warc_segments": """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
f AS (SELECT payload, min(page_id) AS first_id FROM p WHERE octet_length(payload) >= 100 GROUP BY payload)
SELECT p.page_id, octet_length(p.payload) AS payload_bytes, sha256(p.payload) AS payload_digest,
  CASE WHEN f.first_id IS NULL OR f.first_id = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  nullif(f.first_id, p.page_id) AS refers_to
FROM p LEFT JOIN f ON f.payload = p.payload""",
    "op12_filter_audit": _AUDIT,
}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op5_bpe_tree_concatenation(spark: SparkSession, folder: str) -> DataFrame:
    from feldspar.llm.bpe import decode, encode

    coded = decode(encode(table(spark, folder, "documents")))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_jump_consistent_hashing(spark: SparkSession, folder: str) -> DataFrame:
    from feldspar.llm.sharding import assign

    return assign(table(spark, folder, "documents"), shards=24)


@query
def op4_language_codes(spark: SparkSession, folder: str) -> DataFrame:
    from feldspar.llm.langid import identify

    return identify(table(spark, folder, "documents"))


@query
def op7_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    from feldspar.llm.packing import harmonic

    return harmonic(table(spark, folder, "documents"))


@query
def op3_subsequence_kernel(spark: SparkSession, folder: str) -> DataFrame:
    from feldspar.llm.toxicity import detect

    return detect(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_multiprobe_hashing(spark: SparkSession, folder: str) -> DataFrame:
    from feldspar.llm.ann import nearest

    return nearest(table(spark, folder, "embeddings"))


@query
def op1_cover_tree_pairs(spark: SparkSession, folder: str) -> DataFrame:
    from feldspar.llm.covertree import link

    return link(table(spark, folder, "embeddings"))


@query
def op8_warc_segments(spark: SparkSession, folder: str) -> DataFrame:
    from feldspar.llm.warc import round_trip

    return round_trip(table(spark, folder, "pages"))


@query
def op2_size_aware_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    from feldspar.llm.jaccard import link

    return link(table(spark, folder, "documents"))


@query
def op10_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    from feldspar.llm.lines import dedup

    return dedup(table(spark, folder, "documents")).select("doc_id", "text", "n_lines", "n_dropped")


@query
def op11_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    from feldspar.llm.passages import dedup

    return dedup(table(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    from feldspar.llm.filteraudit import audit

    return audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    from feldspar.llm.periodic import collapse, echoed, longest

    found = collapse(echoed(table(spark, folder, "documents"))).withColumn("best", longest())
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, folder)
