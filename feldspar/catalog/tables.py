"""Profiles, joins, group statistics, missing values, numbers, sets and sorts on the relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from feldspar.catalog.base import (
    CLAIMS, HOUSE_KEY, HOUSES, ORDERS_SPLIT, PARTS, claims, houses, orders_split, pandas_div, parts, query, table,
)
from feldspar.operators import groupstats as gs
from feldspar.operators import joins as jn
from feldspar.operators import missing as mv
from feldspar.operators import numeric as nm
from feldspar.operators import profile as pf
from feldspar.operators import sets as so

KEY = ", ".join(HOUSE_KEY)
CELLS = ["bedroomcnt", "bathroomcnt", "qty", "flag_cat", "status_cat"]
MIX = ["ps_car_01_cat", "ps_car_02_cat", "ps_reg_03_bin", "ps_car_12", "ps_car_13", "ps_car_15"]


# ---- profiles and column selection ----


@query("select_by_suffix_cat", f"SELECT p_partkey, ps_car_01_cat, ps_car_02_cat FROM ({PARTS})")
def _(spark, d):
    return pf.select_by_suffix(parts(spark, d), "_cat", keep=["p_partkey"])


@query("select_by_suffix_bin", f"SELECT p_partkey, ps_reg_03_bin FROM ({PARTS})")
def _(spark, d):
    return pf.select_by_suffix(parts(spark, d), "_bin", keep=["p_partkey"])


@query(
    "classify_columns_by_name",
    f"""SELECT 'car' AS class, CAST(5 AS INT) AS n_columns, CAST(count(ps_car_01_cat) + count(ps_car_02_cat)
  + count(ps_car_12) + count(ps_car_13) + count(ps_car_15) AS BIGINT) AS n_values FROM ({PARTS})
UNION ALL SELECT 'reg', 1, count(ps_reg_03_bin) FROM ({PARTS})""",
)
def _(spark, d):
    df = parts(spark, d)
    classes = {k: v for k, v in pf.classify_columns(df.columns).items() if k in ("car", "reg")}
    cells = [
        F.struct(
            F.lit(k).alias("class"),
            F.lit(len(v)).alias("n_columns"),
            sum((F.col(f"n_{c}") for c in v), F.lit(0)).cast("long").alias("n_values"),
        )
        for k, v in classes.items()
    ]
    counts = df.agg(*[F.count(c).alias(f"n_{c}") for v in classes.values() for c in v])
    return counts.select(F.inline(F.array(*cells)))


def _long(cells: dict[str, str], value: str, source: str) -> str:
    return "\nUNION ALL ".join(f"SELECT '{c}' AS \"column\", {e} AS {value} FROM ({source})" for c, e in cells.items())


@query(
    "sparse_columns",
    "SELECT *, CAST(CASE WHEN ratio > 0.5 THEN 1 ELSE 0 END AS INT) AS is_sparse FROM ("
    + _long({c: f"avg(CASE WHEN {c} = -1 THEN 1.0 ELSE 0.0 END)" for c in ("ps_car_12", "ps_car_15")}, "ratio", PARTS)
    + ")",
    rounds=["ratio"],
)
def _(spark, d):
    return pf.sparse_columns(parts(spark, d), ["ps_car_12", "ps_car_15"], value=-1)


@query(
    "major_minor_columns",
    "SELECT *, CASE WHEN ratio < 0.6 THEN 'major' ELSE 'minor' END AS kind FROM ("
    + _long({c: f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)" for c in CELLS}, "ratio", HOUSES)
    + ")",
    rounds=["ratio"],
)
def _(spark, d):
    return pf.major_minor_columns(houses(spark, d), CELLS)


@query(
    "split_by_cardinality",
    "SELECT *, CASE WHEN cardinality > 200 THEN 'high' ELSE 'low' END AS kind FROM ("
    + _long(
        {c: f"CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT)" for c in [*CELLS, "l_suppkey", "l_partkey"]},
        "cardinality",
        HOUSES,
    )
    + ")",
)
def _(spark, d):
    return pf.split_by_cardinality(houses(spark, d), [*CELLS, "l_suppkey", "l_partkey"])


@query("drop_univalue_columns", f"SELECT o_orderkey, price FROM ({ORDERS_SPLIT})")
def _(spark, d):
    df = orders_split(spark, d).select("o_orderkey", "price", "is_train")
    df = df.withColumns({"constant": F.lit(3), "empty": F.lit(None).cast("int")})
    return pf.drop_univalue_columns(df, ["o_orderkey", "price", "constant", "empty"])[0].drop("is_train")


@query("remove_columns", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(spark, d):
    return pf.remove_columns(table(spark, d, "orders"), ["o_custkey", "o_orderdate", "o_orderpriority", "no_such_column"])


@query(
    "outlier_profile",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(sum(CASE WHEN z > 3 THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers, max(z) AS max_z
FROM (SELECT abs({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_samp({c}) FROM lineitem) AS z FROM lineitem)"""
        for c in ("l_extendedprice", "l_quantity", "l_tax")
    ),
    rounds=["max_z"],
)
def _(spark, d):
    return pf.outlier_profile(table(spark, d, "lineitem"), ["l_extendedprice", "l_quantity", "l_tax"])


@query(
    "feature_range",
    f"""SELECT min(least(bedroomcnt, bathroomcnt, qty)) AS min_value, max(greatest(bedroomcnt, bathroomcnt, qty)) AS max_value
FROM ({HOUSES})""",
)
def _(spark, d):
    return pf.feature_range(houses(spark, d), ["bedroomcnt", "bathroomcnt", "qty"])


@query(
    "overlap_column_replace",
    "SELECT o_orderkey, o_totalprice * 2 AS price, upper(o_orderstatus) AS status_cat FROM orders",
)
def _(spark, d):
    df = orders_split(spark, d).select("o_orderkey", "price", "status_cat")
    return pf.attach_columns(df, {"price": F.col("price") * 2, "status_cat": F.upper("status_cat")})


@query(
    "null_pattern_count",
    "SELECT CAST("
    + " + ".join(f"CASE WHEN {c} IS NOT NULL THEN {1 << i} ELSE 0 END" for i, c in enumerate(CELLS))
    + f" AS BIGINT) AS pattern, count(*) AS n_rows FROM ({HOUSES}) GROUP BY 1",
)
def _(spark, d):
    return pf.null_pattern_count(houses(spark, d), CELLS, as_number=True)


@query(
    "assert_no_nulls",
    "\nUNION ALL ".join(
        f"""SELECT is_train, '{c}' AS "column", CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null
FROM ({HOUSES}) GROUP BY is_train"""
        for c in ("qty", "status_cat", "logerror")
    ),
)
def _(spark, d):
    return pf.assert_no_nulls(houses(spark, d), ["qty", "status_cat", "logerror"])


# ---- joins ----


@query(
    "left_join_lookup",
    """SELECT 2 * c_custkey AS c_custkey, coalesce(n_orders, 0) AS n_orders, coalesce(spent, 0.0) AS spent FROM customer LEFT JOIN
  (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS spent FROM orders GROUP BY 1)
  ON 2 * c_custkey = o_custkey""",
    rounds=["spent"],
    digits=2,
)
def _(spark, d):
    """Doubled keys, so that half of the rows have no match."""
    totals = jn.group_table(table(spark, d, "orders"), ["o_custkey"], {"n_orders": F.count(F.lit(1)), "spent": F.sum("o_totalprice")})
    rows = table(spark, d, "customer").select((2 * F.col("c_custkey")).alias("c_custkey"))
    return jn.left_join_lookup(
        rows, totals.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"], "n_orders", {"n_orders": 0, "spent": 0.0}
    )


@query(
    "inner_join_stats",
    """SELECT l_suppkey, count(*) AS n, avg(l_quantity) AS mean_qty, max(l_extendedprice) AS top_price, min(l_tax) AS low_tax
FROM lineitem GROUP BY l_suppkey""",
    rounds=["mean_qty"],
)
def _(spark, d):
    return jn.group_table(
        table(spark, d, "lineitem"),
        ["l_suppkey"],
        {"n": F.count(F.lit(1)), "mean_qty": F.avg("l_quantity"), "top_price": F.max("l_extendedprice"), "low_tax": F.min("l_tax")},
    )


@query(
    "map_lookup",
    """SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN n_name END AS nation
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def _(spark, d):
    rows = table(spark, d, "customer").selectExpr("c_custkey", "CASE WHEN c_custkey % 10 <> 0 THEN c_nationkey END AS code")
    return jn.map_lookup(rows, "code", table(spark, d, "nation"), "n_nationkey", "n_name", "nation").drop("code")


@query(
    "index_join",
    "SELECT o_orderkey, o_orderstatus, o_totalprice / 2 AS o_totalprice, n_lines FROM orders LEFT JOIN "
    "(SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_lines"))
    return jn.key_join(orders.withColumn("o_totalprice", F.col("o_totalprice") / 2), lines, ["o_orderkey"])


@query(
    "semi_membership",
    """SELECT avg(CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') THEN 1.0 ELSE 0.0 END) AS share
FROM customer WHERE c_acctbal > 5000""",
    rounds=["share"],
)
def _(spark, d):
    urgent = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").withColumnRenamed("o_custkey", "c_custkey")
    rich = table(spark, d, "customer").filter("c_acctbal > 5000").select("c_custkey")
    return jn.membership_share(urgent, rich, "c_custkey")


@query(
    "contingency_pair",
    f"""SELECT nation_cat, CAST(sum(CASE WHEN target = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n0,
  CAST(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n1 FROM ({CLAIMS}) GROUP BY nation_cat""",
)
def _(spark, d):
    return jn.contingency(claims(spark, d), "nation_cat", "target")


# ---- group statistics ----

OBS, GRP = ["bedroomcnt", "qty"], ["flag_cat", "l_suppkey"]


def _stats_sql() -> str:
    ctes, joins, cells = [], [], []
    for g in GRP:
        aggs = [f"count(*) AS n_{g}"]
        for o in OBS:
            aggs += [
                f"{fn} AS {s}_{o}_{g}"
                for s, fn in {
                    "mean": f"avg({o})",
                    "std": f"stddev_samp({o})",
                    "median": f"quantile_cont({o}, 0.5)",
                    "max": f"max({o})",
                    "min": f"min({o})",
                }.items()
            ]
            cells.append(f'n_{g} AS "{o}_count_on_{g}"')
            cells += [f'coalesce({s}_{o}_{g}, 0) AS "{o}_{s}_on_{g}"' for s in ("mean", "std", "median", "max", "min")]
        ctes.append(f"g_{g} AS (SELECT coalesce(CAST({g} AS VARCHAR), 'nan') AS k, {', '.join(aggs)} FROM h GROUP BY 1)")
        joins.append(f"JOIN g_{g} ON coalesce(CAST(h.{g} AS VARCHAR), 'nan') = g_{g}.k")
    keys = ", ".join(f"h.{c}" for c in [*HOUSE_KEY, *OBS, "is_train"])
    return f"WITH h AS ({HOUSES}), {', '.join(ctes)} SELECT {keys}, {', '.join(cells)} FROM h {' '.join(joins)}"


STAT_COLUMNS = [f"{o}_{s}_on_{g}" for g in GRP for o in OBS for s in ("mean", "std", "median")]


@query("group_stats", _stats_sql(), rounds=STAT_COLUMNS)
def _(spark, d):
    df = houses(spark, d).select(*HOUSE_KEY, *OBS, "flag_cat", "is_train")
    out, new = gs.group_stats(df, OBS, GRP)
    return out.select(*HOUSE_KEY, *OBS, "is_train", *new)


def _ratio_sql() -> str:
    raw, nan_flags, cells, ratios = [], [], [], []
    for g in GRP:
        for o in OBS:
            s = {k: f'"{o}_{k}_on_{g}"' for k in ("mean", "std", "median", "max", "min")}
            spread = f"({s['max']} - {s['min']})"
            for name, a, b in (
                ("meanrat", o, s["mean"]),
                ("stdrat", f"({o} - {s['mean']})", s["std"]),
                ("medrat", f"({o} - {s['median']})", spread),
                ("minrat", f"({o} - {s['min']})", spread),
            ):
                raw.append(f'{pandas_div(a, b)} AS "{o}_{name}_on_{g}"')
                ratios.append(f"{o}_{name}_on_{g}")
            raw.append(f'{spread} AS "{o}_range_on_{g}"')
            cells.append(f'"{o}_range_on_{g}"')
    # Nulls of the observed column occur in the train rows of every ratio of bedroomcnt; no ratio is infinite.
    for c in ratios:
        cells.append(f'coalesce("{c}", 0.0) AS "{c}"')
        if c.startswith("bedroomcnt"):
            nan_flags.append(f'CAST(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END AS INT) AS "{c}_nan"')
    return (
        f"SELECT {KEY}, {', '.join(OBS)}, is_train, {', '.join(cells + nan_flags)} FROM "
        f"(SELECT {KEY}, {', '.join(OBS)}, is_train, {', '.join(raw)} FROM ({_stats_sql()}))"
    )


RATIO_COLUMNS = [f"{o}_{s}_on_{g}" for g in GRP for o in OBS for s in ("meanrat", "stdrat", "medrat", "minrat", "range")]


@query("group_stats_ratio", _ratio_sql(), rounds=RATIO_COLUMNS, digits=5)
def _(spark, d):
    df = houses(spark, d).select(*HOUSE_KEY, *OBS, "flag_cat", "is_train")
    df, _stats = gs.group_stats(df, OBS, GRP)
    df, new = gs.group_stats_ratio(df, OBS, GRP)
    ranges = [f"{o}_range_on_{g}" for g in GRP for o in OBS]
    return df.select(*HOUSE_KEY, *OBS, "is_train", *ranges, *new)


@query(
    "occurrence_ratio",
    f"""WITH o AS ({ORDERS_SPLIT}), n AS (SELECT count(*) AS total FROM o)
SELECT o_orderkey, o.priority_cat, o.status_cat, a.c / CAST(total AS DOUBLE) AS priority_cat_occur_r, b.c / CAST(total AS DOUBLE) AS status_cat_occur_r
FROM o JOIN (SELECT priority_cat, count(*) AS c FROM o GROUP BY 1) a ON o.priority_cat IS NOT DISTINCT FROM a.priority_cat
JOIN (SELECT status_cat, count(*) AS c FROM o GROUP BY 1) b ON o.status_cat = b.status_cat, n""",
)
def _(spark, d):
    df = orders_split(spark, d).select("o_orderkey", "priority_cat", "status_cat")
    return gs.occurrence_ratio(df, ["priority_cat", "status_cat"])[0]


@query(
    "null_ratio_feature",
    f"""WITH h AS ({HOUSES}), r AS (SELECT avg(CASE WHEN bedroomcnt IS NULL THEN 1.0 ELSE 0.0 END) AS a,
  avg(CASE WHEN flag_cat IS NULL THEN 1.0 ELSE 0.0 END) AS b FROM h WHERE is_train = 1)
SELECT {KEY}, CASE WHEN bedroomcnt IS NULL THEN a ELSE 1 - a END AS bedroomcnt_nan_r,
  CASE WHEN flag_cat IS NULL THEN b ELSE 1 - b END AS flag_cat_nan_r FROM h, r""",
    rounds=["bedroomcnt_nan_r", "flag_cat_nan_r"],
)
def _(spark, d):
    out, new = gs.null_ratio_feature(houses(spark, d), ["bedroomcnt", "flag_cat"])
    return out.select(*HOUSE_KEY, *new)


@query(
    "class_histogram",
    f"""WITH c AS ({CLAIMS}) SELECT target, nation_cat, n, class_n, n / CAST(class_n AS DOUBLE) AS share FROM
  (SELECT target, nation_cat, count(*) AS n FROM c WHERE nation_cat IS NOT NULL GROUP BY 1, 2)
  JOIN (SELECT target, count(nation_cat) AS class_n FROM c GROUP BY 1) USING (target)""",
)
def _(spark, d):
    return gs.class_histogram(claims(spark, d), "target", "nation_cat")


@query(
    "correlation_matrix",
    "\nUNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM ({HOUSES})"
        for a in ("bedroomcnt", "bathroomcnt", "qty", "logerror")
        for b in ("bedroomcnt", "bathroomcnt", "qty", "logerror")
    ),
    rounds=["corr"],
)
def _(spark, d):
    return gs.correlation_matrix(houses(spark, d), ["bedroomcnt", "bathroomcnt", "qty", "logerror"])


@query(
    "rank_features_by_corr",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", abs(corr({c}, logerror)) AS abs_corr FROM ({HOUSES})"
        for c in ("bedroomcnt", "bathroomcnt", "qty", "l_extendedprice")
    ),
    rounds=["abs_corr"],
)
def _(spark, d):
    return gs.rank_by_correlation(houses(spark, d), ["bedroomcnt", "bathroomcnt", "qty", "l_extendedprice"], "logerror")


def _bin_sql(x: str, low: str, high: str, bins: int) -> str:
    return f"CAST(least(floor(({x} - {low}) / ({high} - {low}) * {float(bins)}), {bins - 1}) AS BIGINT)"


@query(
    "binned_histogram_by_target",
    f"""WITH c AS ({CLAIMS}), m AS (SELECT min(balance) AS lo, max(balance) AS hi FROM c)
SELECT target, {_bin_sql("balance", "lo", "hi", 100)} AS bin, count(*) AS n FROM c, m GROUP BY 1, 2""",
)
def _(spark, d):
    return gs.binned_histogram(claims(spark, d), "target", "balance")


@query(
    "group_density",
    f"""WITH c AS (SELECT * FROM ({CLAIMS}) WHERE nation_cat IS NOT NULL), m AS (SELECT min(balance) AS lo, max(balance) AS hi FROM ({CLAIMS})),
b AS (SELECT nation_cat, {_bin_sql("balance", "lo", "hi", 20)} AS bin, lo, hi, count(*) AS n FROM c, m GROUP BY ALL)
SELECT nation_cat, bin, n, CAST(sum(n) OVER (PARTITION BY nation_cat) AS BIGINT) AS group_n,
  CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY nation_cat) / ((hi - lo) / 20) AS density FROM b""",
    rounds=["density"],
    digits=10,
)
def _(spark, d):
    return gs.group_density(claims(spark, d), "nation_cat", "balance", bins=20)


def _scatter_sql(a: str, b: str) -> str:
    return f"""SELECT target, '{a}' AS x, '{b}' AS y, {_bin_sql(a, "xl", "xh", 20)} AS bx, {_bin_sql(b, "yl", "yh", 20)} AS "by", count(*) AS n
FROM ({PARTS}), (SELECT min({a}) AS xl, max({a}) AS xh, min({b}) AS yl, max({b}) AS yh FROM ({PARTS}))
WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL"""


@query(
    "pair_scatter_grid",
    "\nUNION ALL ".join(_scatter_sql(a, b) for a, b in (("ps_car_12", "ps_car_13"), ("ps_car_12", "ps_car_15"), ("ps_car_13", "ps_car_15"))),
)
def _(spark, d):
    return gs.pair_scatter_grid(parts(spark, d), "target", ["ps_car_12", "ps_car_13", "ps_car_15"], bins=20)


# ---- missing values ----


@query(
    "mean_impute",
    f"""SELECT {KEY}, coalesce(bedroomcnt, (SELECT avg(bedroomcnt) FROM ({HOUSES}))) AS bedroomcnt,
  coalesce(bathroomcnt, (SELECT avg(bathroomcnt) FROM ({HOUSES}))) AS bathroomcnt FROM ({HOUSES})""",
    rounds=["bedroomcnt", "bathroomcnt"],
)
def _(spark, d):
    df = houses(spark, d).select(*HOUSE_KEY, "bedroomcnt", "bathroomcnt")
    return mv.mean_impute(df, ["bedroomcnt", "bathroomcnt"])


INF_SOURCE = f"""SELECT {KEY}, is_train, {pandas_div("logerror", "bedroomcnt")} AS ratio,
  CASE WHEN is_train = 1 THEN qty ELSE {pandas_div("qty", "bathroomcnt")} END AS test_only FROM ({HOUSES})"""


def _with_inf(spark, d):
    from feldspar.functions.numeric import divide

    return houses(spark, d).select(
        *HOUSE_KEY,
        "is_train",
        divide(F.col("logerror"), F.col("bedroomcnt")).alias("ratio"),
        F.when(F.col("is_train") == 1, F.col("qty")).otherwise(divide(F.col("qty"), F.col("bathroomcnt"))).alias("test_only"),
    )


@query(
    "inf_impute",
    f"""WITH s AS ({INF_SOURCE}) SELECT {KEY}, is_train,
  CASE WHEN isinf(ratio) THEN 0.0 ELSE ratio END AS ratio,
  CAST(CASE WHEN ratio = CAST('inf' AS DOUBLE) THEN 1 WHEN ratio = CAST('-inf' AS DOUBLE) THEN -1 ELSE 0 END AS INT) AS ratio_inf,
  CASE WHEN isinf(test_only) THEN (SELECT avg(test_only) FROM s WHERE is_train = 1) ELSE test_only END AS test_only FROM s""",
    rounds=["ratio", "test_only"],
)
def _(spark, d):
    return mv.inf_impute(_with_inf(spark, d), ["ratio", "test_only"])[0]


@query(
    "nan_impute",
    f"""WITH s AS (SELECT {KEY}, is_train, bedroomcnt, CASE WHEN is_train = 0 AND l_linenumber = 2 THEN NULL ELSE qty END AS qty FROM ({HOUSES}))
SELECT {KEY}, is_train, coalesce(bedroomcnt, 0.0) AS bedroomcnt, CAST(CASE WHEN bedroomcnt IS NULL THEN 1 ELSE 0 END AS INT) AS bedroomcnt_nan,
  coalesce(qty, (SELECT avg(qty) FROM s WHERE is_train = 1)) AS qty FROM s""",
    rounds=["qty"],
)
def _(spark, d):
    df = houses(spark, d).select(
        *HOUSE_KEY, "is_train", "bedroomcnt", F.expr("CASE WHEN is_train = 0 AND l_linenumber = 2 THEN NULL ELSE qty END").alias("qty")
    )
    return mv.nan_impute(df, ["bedroomcnt", "qty"])[0]


# ---- numbers ----


@query(
    "inverse_features",
    f"""WITH s AS (SELECT {KEY}, bedroomcnt, qty, {pandas_div("1.0", "bedroomcnt")} AS i FROM ({HOUSES}))
SELECT {KEY}, CASE WHEN isinf(i) THEN 0.0 ELSE i END AS bedroomcnt_inv, CAST(CASE WHEN isinf(i) THEN 1 ELSE 0 END AS INT) AS bedroomcnt_inv_inf,
  1 / qty AS qty_inv FROM s""",
    rounds=["bedroomcnt_inv", "qty_inv"],
)
def _(spark, d):
    out, new = nm.inverse_features(houses(spark, d), ["bedroomcnt", "qty"])
    return out.select(*HOUSE_KEY, *new)


@query(
    "inverse_columns",
    f"""SELECT {KEY}, CASE WHEN bathroomcnt = 0 THEN 0.0 ELSE 1 / bathroomcnt END AS bathroomcnt_inv,
  CAST(CASE WHEN bathroomcnt = 0 THEN 1 ELSE 0 END AS INT) AS bathroomcnt_inv_inf FROM ({HOUSES})""",
    rounds=["bathroomcnt_inv"],
)
def _(spark, d):
    out, new = nm.inverse_columns(houses(spark, d), ["bathroomcnt", "flag_cat"])
    return out.select(*HOUSE_KEY, *new)


@query(
    "log1p_features",
    f"""SELECT p_partkey, ln(1 + ps_car_13) AS ps_car_13_log1p,
  CASE WHEN ps_car_15 = -1 THEN CAST('-inf' AS DOUBLE) ELSE ln(1 + ps_car_15) END AS ps_car_15_log1p FROM ({PARTS})""",
    rounds=["ps_car_13_log1p", "ps_car_15_log1p"],
)
def _(spark, d):
    out, new = nm.log1p_features(parts(spark, d), ["ps_car_13", "ps_car_15"])
    return out.select("p_partkey", *new)


@query(
    "polynomial_features",
    f"""SELECT {KEY}, bedroomcnt * bedroomcnt AS "bedroomcnt^2", bedroomcnt * qty AS "bedroomcnt qty", qty * qty AS "qty^2" FROM ({HOUSES})""",
)
def _(spark, d):
    out, new = nm.polynomial_features(houses(spark, d), ["bedroomcnt", "qty"], interaction_only=False)
    return out.select(*HOUSE_KEY, *new)


@query(
    "magic_features",
    f"""SELECT p_partkey, round_even(ps_car_13 * ps_car_13 * 48400, 2) AS ps_car_13_magic, CAST(ps_car_15 AS DOUBLE) * ps_car_15 AS ps_car_15_magic,
  round_even(ps_car_12 * ps_car_12, 4) * 10000 AS ps_car_12_magic FROM ({PARTS})""",
    rounds=["ps_car_13_magic", "ps_car_12_magic"],
)
def _(spark, d):
    out, new = nm.magic_features(parts(spark, d), squared="ps_car_15", scaled="ps_car_13", rounded="ps_car_12")
    return out.select("p_partkey", *new)


@query(
    "ratio_diff_features",
    f"""SELECT {KEY}, CASE WHEN bedroomcnt = 0 THEN 0.0 ELSE bathroomcnt / bedroomcnt END AS babr_ratio,
  CAST(CASE WHEN bedroomcnt = 0 THEN 1 ELSE 0 END AS INT) AS no_br, bathroomcnt - bedroomcnt AS babr_diff FROM ({HOUSES})""",
    rounds=["babr_ratio"],
)
def _(spark, d):
    out, new = nm.ratio_diff_features(houses(spark, d), "bathroomcnt", "bedroomcnt")
    return out.select(*HOUSE_KEY, *new)


@query(
    "standard_scale",
    f"""WITH h AS ({HOUSES}), s AS (SELECT avg(qty) AS m, stddev_pop(qty) AS sd FROM h WHERE is_train = 1)
SELECT {KEY}, (qty - m) / sd AS qty FROM h, s""",
    rounds=["qty"],
)
def _(spark, d):
    return nm.standard_scale(houses(spark, d).select(*HOUSE_KEY, "qty", "is_train"), ["qty"]).drop("is_train")


@query("clip_max", f"SELECT {KEY}, CASE WHEN qty > 4 THEN 4.0 ELSE qty END AS qty FROM ({HOUSES})")
def _(spark, d):
    return nm.clip_columns(houses(spark, d).select(*HOUSE_KEY, "qty"), ["qty"], 4)


# ---- sets, sorts, top-k ----


@query("order_by_key", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey")
def _(spark, d):
    return so.order_by_key(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])


@query("order_by_group_size", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey")
def _(spark, d):
    return so.order_by_group_size(table(spark, d, "orders"), "o_custkey")


@query(
    "topk_importance",
    "SELECT o_custkey, sum(o_totalprice) AS importance FROM orders GROUP BY 1 ORDER BY importance DESC, o_custkey LIMIT 50",
    rounds=["importance"],
    digits=2,
)
def _(spark, d):
    spent = table(spark, d, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("importance"))
    return so.top_k(spent, "importance", "o_custkey", 50)


@query(
    "sort_desc_scores",
    "SELECT p_brand, avg(p_retailprice) AS score FROM part GROUP BY 1 ORDER BY score DESC, p_brand",
    rounds=["score"],
)
def _(spark, d):
    scores = table(spark, d, "part").groupBy("p_brand").agg(F.avg("p_retailprice").alias("score"))
    return so.sort_scores(scores, "score", "p_brand")


@query(
    "union_all_train_test",
    f"""SELECT o_orderkey, price, CAST(1 AS INT) AS is_train FROM ({ORDERS_SPLIT}) WHERE is_train = 1
UNION ALL SELECT o_orderkey, NULL, CAST(0 AS INT) FROM ({ORDERS_SPLIT}) WHERE is_train = 0""",
)
def _(spark, d):
    df = orders_split(spark, d)
    train = df.filter("is_train = 1").select("o_orderkey", "price")
    return so.union_train_test(train, df.filter("is_train = 0").select("o_orderkey"))


@query(
    "entity_union",
    "SELECT DISTINCT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer",
)
def _(spark, d):
    a = table(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    b = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return so.distinct_union([a, b], "k")
