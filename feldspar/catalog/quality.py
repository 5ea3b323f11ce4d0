"""Feature quality and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from feldspar.catalog.base import CLAIMS, HOUSES, claims, houses, query, table
from feldspar.operators import encode as en
from feldspar.operators import metrics as me
from feldspar.operators import quality as fq

VALUES = ("bedroomcnt", "bathroomcnt", "qty", "l_extendedprice")


def _f_sql(group: str, values, source: str) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", (SELECT sum(n * power(m - (SELECT avg({c}) FROM ({source})), 2)) / (count(*) - 1)
  FROM (SELECT count({c}) AS n, avg({c}) AS m FROM ({source}) WHERE {group} IS NOT NULL AND {c} IS NOT NULL GROUP BY {group})) /
 (SELECT sum(v * (n - 1)) / sum(n - 1) FROM (SELECT count({c}) AS n, coalesce(var_samp({c}), 0) AS v FROM ({source})
  WHERE {group} IS NOT NULL AND {c} IS NOT NULL GROUP BY {group})) AS f"""
        for c in values
    )


@query("f_test", _f_sql("flag_cat", VALUES, HOUSES), rounds=["f"])
def _(spark, d):
    return fq.f_test(houses(spark, d), "flag_cat", VALUES)


@query("f_classif", f"SELECT * FROM ({_f_sql('target', ['balance', 'region', 'c_custkey'], CLAIMS)}) WHERE f > 150", rounds=["f"])
def _(spark, d):
    return fq.select_by_f(claims(spark, d), "target", ["balance", "region", "c_custkey"], 150)


@query("group_measurement", f"SELECT \"column\", f AS score FROM ({_f_sql('status_cat', VALUES, HOUSES)})", rounds=["score"])
def _(spark, d):
    return fq.group_measurement(houses(spark, d), VALUES, "status_cat")


def _z_sql(group: str, values, source: str) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", sum(z * n1) / sum(n1) AS z FROM (
 SELECT a.g, count(*) FILTER (WHERE s.g IS NOT DISTINCT FROM a.g) AS n1, count(*) FILTER (WHERE s.g IS DISTINCT FROM a.g) AS n2,
  abs(avg(x) FILTER (WHERE s.g IS NOT DISTINCT FROM a.g) - avg(x) FILTER (WHERE s.g IS DISTINCT FROM a.g)) / sqrt(
   var_samp(x) FILTER (WHERE s.g IS NOT DISTINCT FROM a.g) / count(*) FILTER (WHERE s.g IS NOT DISTINCT FROM a.g) +
   var_samp(x) FILTER (WHERE s.g IS DISTINCT FROM a.g) / count(*) FILTER (WHERE s.g IS DISTINCT FROM a.g)) AS z
 FROM (SELECT DISTINCT {group} AS g FROM ({source})) a, (SELECT {group} AS g, {c} AS x FROM ({source})) s GROUP BY a.g)
WHERE n1 >= 20 AND n2 >= 20"""
        for c in values
    )


@query("z_test_one_vs_all", _z_sql("flag_cat", VALUES, HOUSES), rounds=["z"])
def _(spark, d):
    return fq.z_test(houses(spark, d), "flag_cat", VALUES)


def _cosine_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", sum(a * b) / (sqrt(sum(a * a)) * sqrt(sum(b * b))) AS similarity FROM
 (SELECT {c}, CAST(sum(CASE WHEN target = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS a, CAST(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS b
  FROM ({CLAIMS}) WHERE {c} IS NOT NULL GROUP BY 1)"""


@query("histogram_cosine", "\nUNION ALL ".join(_cosine_sql(c) for c in ("seg_cat", "nation_cat", "region")), rounds=["similarity"])
def _(spark, d):
    return fq.histogram_cosine(claims(spark, d), ["seg_cat", "nation_cat", "region"], "target")


def _ami_sql(c: str, source: str) -> str:
    """Mutual information, entropies and the hypergeometric expectation, summed over every cell and count."""
    return f"""SELECT '{c}' AS "column", (mi - e) / (greatest(ha, hb) - e) AS ami FROM (
WITH s AS ({source}), n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM s),
a AS (SELECT {c} AS v, CAST(count(*) AS DOUBLE) AS a FROM s GROUP BY 1), b AS (SELECT target AS t, CAST(count(*) AS DOUBLE) AS b FROM s GROUP BY 1),
ab AS (SELECT {c} AS v, target AS t, CAST(count(*) AS DOUBLE) AS k FROM s GROUP BY 1, 2),
x AS (SELECT a, b, n, CAST(unnest(generate_series(CAST(greatest(1, a + b - n) AS BIGINT), CAST(least(a, b) AS BIGINT))) AS DOUBLE) AS k FROM a, b, n)
SELECT (SELECT sum(k / n * ln(n * k / (a * b))) FROM ab JOIN a ON ab.v IS NOT DISTINCT FROM a.v JOIN b ON ab.t = b.t, n) AS mi,
 (SELECT -sum(a / n * ln(a / n)) FROM a, n) AS ha, (SELECT -sum(b / n * ln(b / n)) FROM b, n) AS hb,
 (SELECT sum(k / n * ln(n * k / (a * b)) * exp(lgamma(a + 1) + lgamma(b + 1) + lgamma(n - a + 1) + lgamma(n - b + 1) - lgamma(n + 1)
   - lgamma(k + 1) - lgamma(a - k + 1) - lgamma(b - k + 1) - lgamma(n - a - b + k + 1))) FROM x) AS e)"""


AMI_COLUMNS = ["seg_cat", "nation_cat", "region"]


@query("adjusted_mutual_info", "\nUNION ALL ".join(_ami_sql(c, CLAIMS) for c in AMI_COLUMNS), rounds=["ami"])
def _(spark, d):
    return fq.adjusted_mutual_info(claims(spark, d), AMI_COLUMNS, "target")


PAIRS = f"""SELECT target, seg_cat || '-' || coalesce(nation_cat, 'nan') AS "seg_cat-nation_cat",
  seg_cat || '-' || CAST(region AS VARCHAR) AS "seg_cat-region", coalesce(nation_cat, 'nan') || '-' || CAST(region AS VARCHAR) AS "nation_cat-region"
FROM ({CLAIMS})"""
PAIR_NAMES = ("seg_cat-nation_cat", "seg_cat-region", "nation_cat-region")


@query(
    "topk_mutual_info",
    "SELECT * FROM ("
    + "\nUNION ALL ".join(_ami_sql(f'"{c}"', PAIRS).replace(f"'\"{c}\"'", f"'{c}'") for c in PAIR_NAMES)
    + ') ORDER BY ami DESC, "column" LIMIT 20',
    rounds=["ami"],
)
def _(spark, d):
    df, pairs = en.interaction_codes(claims(spark, d), AMI_COLUMNS)
    return fq.top_mutual_info(df, pairs, "target", 20)


# ---- metrics on lineitem: tax is the label side, discount the prediction side ----

SCORES = """SELECT l_tax AS y, l_discount AS p, CAST(CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END AS INT) AS label,
  CAST(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS INT) AS pred, l_extendedprice AS score FROM lineitem"""


def _scores(spark, d):
    return table(spark, d, "lineitem").selectExpr(
        "l_tax AS y",
        "l_discount AS p",
        "CAST(CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END AS INT) AS label",
        "CAST(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS INT) AS pred",
        "l_extendedprice AS score",
    )


def _metric(name: str, sql: str, column):
    @query(name, f"SELECT {sql} AS value FROM ({SCORES})", rounds=["value"])
    def _(spark, d):
        return _scores(spark, d).agg(column().alias("value"))


_metric("rmse", "sqrt(avg(power(y - p, 2)))", lambda: me.rmse("y", "p"))
_metric("rmsle", "sqrt(avg(power(ln(1 + p) - ln(1 + y), 2)))", lambda: me.rmsle("y", "p"))
_metric("rss", "sum(power(y - p, 2))", lambda: me.rss("y", "p"))
_metric("mae", "avg(abs(y - p))", lambda: me.mae("y", "p"))
_metric("accuracy", "avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END)", lambda: me.accuracy("label", "pred"))
_metric(
    "positive_hit_rate",
    "CAST(sum(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) AS DOUBLE) / sum(pred)",
    lambda: me.positive_hit_rate("label", "pred"),
)
_metric(
    "false_discovery_rate",
    "CAST(sum(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS DOUBLE) / sum(pred)",
    lambda: me.false_discovery_rate("label", "pred"),
)


@query(
    "classification_report",
    f"""WITH s AS ({SCORES}), k AS (SELECT c.class, sum(CASE WHEN label = c.class AND pred = c.class THEN 1 ELSE 0 END) AS hit,
  CAST(sum(CASE WHEN pred = c.class THEN 1 ELSE 0 END) AS DOUBLE) AS predicted, CAST(sum(CASE WHEN label = c.class THEN 1 ELSE 0 END) AS DOUBLE) AS support
  FROM s, (SELECT 0 AS class UNION ALL SELECT 1) c GROUP BY 1),
m AS (SELECT CAST(class AS VARCHAR) AS class, hit / predicted AS precision, hit / support AS recall,
  2 * (hit / predicted) * (hit / support) / (hit / predicted + hit / support) AS f1, CAST(support AS BIGINT) AS support FROM k)
SELECT * FROM m UNION ALL SELECT 'avg / total', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM m""",
    rounds=["precision", "recall", "f1"],
)
def _(spark, d):
    return me.classification_report(_scores(spark, d), "label", "pred")


AUC_SQL = f"""WITH k AS (SELECT score, sum(label) AS pos, count(*) AS n FROM ({SCORES}) GROUP BY 1),
r AS (SELECT pos, n, sum(n) OVER (ORDER BY score) - (n - 1) / 2.0 AS rank FROM k)
SELECT CAST((sum(pos * rank) - sum(pos) * (sum(pos) + 1) / 2.0) / (CAST(sum(pos) AS DOUBLE) * (sum(n) - sum(pos))) AS DOUBLE) AS auc FROM r"""


@query("roc_auc", AUC_SQL, rounds=["auc"], digits=9)
def _(spark, d):
    return me.roc_auc(_scores(spark, d), "label", "score")


@query("gini_normalized", f"SELECT 2 * auc - 1 AS gini FROM ({AUC_SQL.replace('score', 'qty_score').replace('l_extendedprice AS qty_score', 'l_quantity AS qty_score')})", rounds=["gini"], digits=9)
def _(spark, d):
    df = table(spark, d, "lineitem").selectExpr("CAST(CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END AS INT) AS label", "l_quantity AS score")
    return me.gini_normalized(df, "label", "score")
