"""Target and category encodings, folds and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from feldspar.catalog.base import (
    CLAIMS, COMMENTS, HOUSE_KEY, HOUSES, ORDERS_SPLIT, claims, comments, houses, md5_fold, orders_split, query, table,
)
from feldspar.functions import numeric as fn
from feldspar.operators import encode as en
from feldspar.operators import splits as sp

KEY = ", ".join(HOUSE_KEY)


def _oof_sql(source: str, key: str, columns: list[str], target: str, k: int = 5) -> str:
    """Fold by fold: category means of the other folds, looked up per row."""
    cells, joins = [], []
    for i, c in enumerate(columns):
        joins.append(
            f"LEFT JOIN (SELECT f.fold, s.{c} AS v, avg(s.{target}) AS m FROM folds f JOIN s ON s.is_train = 1 AND s.fold <> f.fold "
            f"WHERE s.{c} IS NOT NULL GROUP BY 1, 2) a{i} ON a{i}.fold = s.fold AND a{i}.v = s.{c}"
        )
        joins.append(f"LEFT JOIN (SELECT {c} AS v, avg({target}) AS m FROM s WHERE is_train = 1 AND {c} IS NOT NULL GROUP BY 1) b{i} ON b{i}.v = s.{c}")
        cells.append(f'CASE WHEN s.is_train = 1 THEN coalesce(a{i}.m, r.m) ELSE coalesce(b{i}.m, t.m) END AS "oof_{target}@{c}"')
    return f"""WITH s AS (SELECT *, {md5_fold(key, k)} AS fold FROM ({source})),
folds AS (SELECT DISTINCT fold FROM s),
r AS (SELECT f.fold, avg(s.{target}) AS m FROM folds f JOIN s ON s.is_train = 1 AND s.fold <> f.fold GROUP BY 1),
t AS (SELECT avg({target}) AS m FROM s WHERE is_train = 1)
SELECT s.{key}, {', '.join(cells)} FROM s {' '.join(joins)} LEFT JOIN r ON r.fold = s.fold, t"""


def _smooth_cell(target: str, c: str, i: int, leaf: float, smoothing: float) -> str:
    lam = f"(1 / (1 + exp(-(a{i}.n - {leaf}) / CAST({smoothing} AS DOUBLE))))"
    return f'coalesce(t.m * (1 - {lam}) + a{i}.m * {lam}, t.m) AS "smooth_{target}@{c}"'


def _smooth_sql(source: str, key: str, columns: list[str], target: str, leaf: float, smoothing: float) -> str:
    joins = " ".join(
        f"LEFT JOIN (SELECT {c} AS v, avg({target}) AS m, count({target}) AS n FROM s WHERE is_train = 1 GROUP BY 1) a{i} ON a{i}.v = s.{c}"
        for i, c in enumerate(columns)
    )
    cells = ", ".join(_smooth_cell(target, c, i, leaf, smoothing) for i, c in enumerate(columns))
    return f"WITH s AS ({source}), t AS (SELECT avg({target}) AS m FROM s WHERE is_train = 1) SELECT s.{key}, {cells} FROM s {joins}, t"


@query("oof_target_mean", _oof_sql(COMMENTS, "doc_id", ["lang", "source"], "toxic"), rounds=["oof_toxic@lang", "oof_toxic@source"])
def _(spark, d):
    out, new = en.oof_target_mean(comments(spark, d).drop("comment_text"), ["lang", "source"], "toxic", "doc_id")
    return out.select("doc_id", *new)


CLAIM_CATS = ["seg_cat", "nation_cat", "region"]


@query("oof_target_mean_claims", _oof_sql(CLAIMS, "c_custkey", CLAIM_CATS, "target"), rounds=[f"oof_target@{c}" for c in CLAIM_CATS])
def _(spark, d):
    out, new = en.oof_target_mean(claims(spark, d), CLAIM_CATS, "target", "c_custkey")
    return out.select("c_custkey", *new)


@query(
    "oof_target_mean_orders",
    _oof_sql(ORDERS_SPLIT, "o_orderkey", ["o_custkey", "priority_cat"], "price"),
    rounds=["oof_price@o_custkey", "oof_price@priority_cat"],
    digits=4,
)
def _(spark, d):
    out, new = en.oof_target_mean(orders_split(spark, d), ["o_custkey", "priority_cat"], "price", "o_orderkey")
    return out.select("o_orderkey", *new)


@query(
    "smoothed_target_mean",
    _smooth_sql(COMMENTS, "doc_id", ["lang", "source"], "toxic", 200, 10),
    rounds=["smooth_toxic@lang", "smooth_toxic@source"],
)
def _(spark, d):
    out, new = en.smoothed_target_mean(comments(spark, d).drop("comment_text"), ["lang", "source"], "toxic")
    return out.select("doc_id", *new)


@query(
    "smoothed_target_mean_claims",
    _smooth_sql(CLAIMS, "c_custkey", CLAIM_CATS, "target", 20, 5),
    rounds=[f"smooth_target@{c}" for c in CLAIM_CATS],
)
def _(spark, d):
    out, new = en.smoothed_target_mean(claims(spark, d), CLAIM_CATS, "target", min_samples_leaf=20, smoothing=5)
    return out.select("c_custkey", *new)


@query("multiplicative_noise", "SELECT o_orderkey, o_totalprice AS price FROM orders")
def _(spark, d):
    return orders_split(spark, d).select("o_orderkey", fn.multiplicative_noise(F.col("price"), 0).alias("price"))


def _uniform_sql(key: str, seed: int, part: int = 0) -> str:
    digits = f"substr(md5(CAST({key} AS VARCHAR) || '#{seed}'), {1 + 16 * part}, 13)"
    return f"((CAST('0x' || {digits} AS BIGINT) + 0.5) / {1 << 52}.0::DOUBLE)"


_NORMAL = f"sqrt(-2.0 * ln({_uniform_sql('o_orderkey', 7)})) * cos(2.0 * pi() * {_uniform_sql('o_orderkey', 7, 1)})"


@query(
    "multiplicative_noise_level",
    f"SELECT o_orderkey, o_totalprice AS price, o_totalprice * (1.0 + CAST(0.05 AS DOUBLE) * {_NORMAL}) AS noisy FROM orders",
    rounds=["noisy"],
)
def _(spark, d):
    noisy = fn.multiplicative_noise(F.col("price"), 0.05, F.col("o_orderkey"))
    return orders_split(spark, d).select("o_orderkey", "price", noisy.alias("noisy"))


@query(
    "laplace_noise",
    f"""SELECT o_orderkey, price, price - 10.0::DOUBLE * sign(u) * ln(1.0 - 2 * abs(u)) AS noisy
FROM (SELECT o_orderkey, o_totalprice AS price, {_uniform_sql('o_orderkey', 7)} - CAST(0.5 AS DOUBLE) AS u FROM orders)""",
    rounds=["noisy"],
)
def _(spark, d):
    noisy = fn.laplace_noise(F.col("price"), 10.0, F.col("o_orderkey"))
    return orders_split(spark, d).select("o_orderkey", "price", noisy.alias("noisy"))


def _likelihood_sql() -> str:
    cells, joins = [], []
    for i, c in enumerate(("flag_cat", "status_cat", "l_suppkey")):
        joins.append(
            f"LEFT JOIN (SELECT f.fold, s.{c} AS v, avg(s.logerror) AS m FROM folds f JOIN s ON s.is_train = 1 AND s.fold <> f.fold "
            f"GROUP BY 1, 2) a{i} ON a{i}.fold = s.fold AND a{i}.v IS NOT DISTINCT FROM s.{c}"
        )
        joins.append(f"LEFT JOIN (SELECT {c} AS v, avg(logerror) AS m FROM s WHERE is_train = 1 GROUP BY 1) b{i} ON b{i}.v IS NOT DISTINCT FROM s.{c}")
        cells.append(f'coalesce(CASE WHEN s.is_train = 1 THEN a{i}.m ELSE b{i}.m END, 0.0) AS "{c}_tar_avg"')
    keys = ", ".join(f"s.{c}" for c in HOUSE_KEY)
    return f"""WITH h AS ({HOUSES}),
s AS (SELECT *, least(floor((row_number() OVER (ORDER BY transactiondate, {KEY}) - 1) / floor((SELECT count(*) FROM h WHERE is_train = 1) / 5)), 4) AS fold
  FROM h WHERE is_train = 1 UNION ALL SELECT *, NULL FROM h WHERE is_train = 0),
folds AS (SELECT DISTINCT fold FROM s WHERE is_train = 1)
SELECT {keys}, {', '.join(cells)} FROM s {' '.join(joins)}"""


@query("likelihood_encoding", _likelihood_sql(), rounds=["flag_cat_tar_avg", "status_cat_tar_avg", "l_suppkey_tar_avg"], digits=8)
def _(spark, d):
    out, new = en.likelihood_encoding(houses(spark, d), ["flag_cat", "status_cat", "l_suppkey"], "logerror", ["transactiondate", *HOUSE_KEY])
    return out.select(*HOUSE_KEY, *new)


# ---- folds and splits ----


@query("stratified_kfold", f"SELECT doc_id, toxic, {md5_fold('doc_id', 5)} AS fold FROM labels")
def _(spark, d):
    return sp.stratified_kfold(table(spark, d, "labels").select("doc_id", "toxic"), "doc_id")


@query(
    "stratified_kfold_exact",
    """SELECT doc_id, toxic, CAST((row_number() OVER (PARTITION BY toxic ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1) % 5 AS INT) AS fold
FROM labels""",
)
def _(spark, d):
    return sp.stratified_kfold(table(spark, d, "labels").select("doc_id", "toxic"), "doc_id", target="toxic")


@query("kfold_contiguous", "SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) - 1 AS INT) AS fold FROM orders")
def _(spark, d):
    return sp.kfold_contiguous(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 7)


@query(
    "time_series_split",
    """WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CAST(CASE WHEN pos < floor(n / 6) + n % 6 THEN 0 ELSE floor((pos - floor(n / 6) - n % 6) / floor(n / 6)) + 1 END AS INT) AS block FROM o""",
)
def _(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return sp.time_series_split(df, ["o_orderdate", "o_orderkey"], 5).drop("o_orderdate")


@query(
    "train_test_split_ordered",
    """SELECT o_orderkey, CAST(CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= (SELECT CAST(floor(count(*) * (1 - CAST(0.33 AS DOUBLE))) AS BIGINT) FROM orders)
  THEN 1 ELSE 0 END AS INT) AS is_train FROM orders""",
)
def _(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return sp.train_test_split_ordered(df, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "train_test_split_random",
    """SELECT o_orderkey, CAST(CASE WHEN u < 0.35 THEN 1 ELSE 0 END AS INT) AS is_train FROM
  (SELECT o_orderkey, CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 AS u FROM orders)
WHERE u < CAST(0.35 AS DOUBLE) + CAST(0.15 AS DOUBLE)""",
)
def _(spark, d):
    return sp.train_test_split_random(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 0.35, 0.15)


# ---- category encodings ----


def _codes(c: str, name: str, source: str) -> str:
    return f"(SELECT {c} AS v, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INT) AS {name} FROM (SELECT DISTINCT {c} FROM ({source}) WHERE {c} IS NOT NULL))"


@query(
    "category_codes",
    f"""SELECT o_orderkey, coalesce(a.x, -1) AS priority_cat_cat, coalesce(b.y, -1) AS o_custkey_cat FROM ({ORDERS_SPLIT}) o
LEFT JOIN {_codes("priority_cat", "x", ORDERS_SPLIT)} a ON a.v = o.priority_cat LEFT JOIN {_codes("o_custkey", "y", ORDERS_SPLIT)} b ON b.v = o.o_custkey""",
)
def _(spark, d):
    out, new = en.category_codes(orders_split(spark, d), ["priority_cat", "o_custkey"])
    return out.select("o_orderkey", *new)


PAIRED = f"""SELECT c_custkey, coalesce(seg_cat, 'nan') || '-' || coalesce(nation_cat, 'nan') AS a,
  coalesce(seg_cat, 'nan') || '-' || coalesce(CAST(region AS VARCHAR), 'nan') AS b,
  coalesce(nation_cat, 'nan') || '-' || coalesce(CAST(region AS VARCHAR), 'nan') AS c FROM ({CLAIMS})"""


@query(
    "interaction_codes",
    f"""SELECT p.c_custkey, x.x AS "seg_cat-nation_cat", y.y AS "seg_cat-region", z.z AS "nation_cat-region" FROM ({PAIRED}) p
JOIN {_codes("a", "x", PAIRED)} x ON x.v = p.a JOIN {_codes("b", "y", PAIRED)} y ON y.v = p.b JOIN {_codes("c", "z", PAIRED)} z ON z.v = p.c""",
)
def _(spark, d):
    out, new = en.interaction_codes(claims(spark, d), ["seg_cat", "nation_cat", "region"])
    return out.select("c_custkey", *new)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "one_hot",
    "SELECT o_orderkey, "
    + ", ".join(f"CAST(CASE WHEN priority_cat = '{p}' THEN 1 ELSE 0 END AS INT) AS \"priority_cat_{p}\"" for p in PRIORITIES)
    + f", CAST(CASE WHEN priority_cat IS NULL THEN 1 ELSE 0 END AS INT) AS priority_cat_nan FROM ({ORDERS_SPLIT})",
)
def _(spark, d):
    out, new = en.one_hot(orders_split(spark, d), ["priority_cat"])
    return out.select("o_orderkey", *new)


@query(
    "binary_encode",
    f"""WITH c AS (SELECT *, coalesce(CAST(nation_cat AS VARCHAR), 'nan') AS v FROM ({CLAIMS})),
f AS (SELECT v, row_number() OVER (ORDER BY min((1 - is_train) * 1000000000 + c_custkey)) - 1 AS code FROM c GROUP BY v)
SELECT c_custkey, """
    + ", ".join(f"CAST((code >> {4 - i}) & 1 AS INT) AS nation_cat_b{i}" for i in range(5))
    + " FROM c JOIN f USING (v)",
)
def _(spark, d):
    out, new = en.binary_encode(claims(spark, d), ["nation_cat"], ["c_custkey"])
    return out.select("c_custkey", *new)
