"""Query registry, table access and the input bindings shared by queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# A fixed fraction of the last kept digit, added before rounding on both sides: exact ties (k/128 at six
# digits, say) would otherwise fall either way with the last bit of a sum.
TIE_SHIFT = 0.1234567
#: Scaled values from here on are rounded as decimal numbers.
EXACT_BELOW = 2.0**36


def rounded(df: DataFrame, columns: Sequence[str], digits: int) -> DataFrame:
    """Round the listed doubles (and turn -0.0 into 0.0), so that summation order does not show."""
    shift, scale = F.lit(TIE_SHIFT * 10**-digits), F.lit(10.0**digits)

    def near(x: Column) -> Column:
        # round() goes by a decimal number for every value. Without ties, doubles give the same where they hold fractions well.
        quick = F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)) / scale
        return F.when(F.abs(x) * scale < F.lit(EXACT_BELOW), quick).otherwise(F.round(x, digits)) + F.lit(0.0)

    return df.withColumns({c: near(F.col(f"`{c}`").cast("double") + shift) for c in columns})


def query(name: str, sql: str | None = None, rounds: Sequence[str] = (), digits: int = 6, dates: Sequence[str] = ()):
    """Register a query; ``sql`` is its counterpart.

    On both sides, columns in ``rounds`` are rounded and those in ``dates`` are written as text.
    """

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            out = fn(spark, folder)
            out = rounded(out, rounds, digits) if rounds else out
            return out.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else out

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            shift = TIE_SHIFT * 10**-digits
            cells = [f'round(CAST("{c}" AS DOUBLE) + CAST({shift!r} AS DOUBLE), {digits}) + 0.0 AS "{c}"' for c in rounds]
            cells += [f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in dates]
            ORACLES[name] = f"SELECT * REPLACE ({', '.join(cells)}) FROM (\n{sql}\n)" if cells else sql
        return fn

    return register


def bind(source: str, exprs: Sequence[str]) -> tuple[Callable[[SparkSession, str], DataFrame], str]:
    """A projection of one table, as a DataFrame builder and as SQL; both read the same expressions."""
    return (lambda spark, folder: table(spark, folder, source).selectExpr(*exprs)), f"SELECT {', '.join(exprs)} FROM {source}"


HOUSE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
houses, HOUSES = bind(
    "lineitem",
    [
        *HOUSE_KEY,
        "l_discount - l_tax AS logerror",
        "CAST(l_shipdate AS DATE) AS transactiondate",
        "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_tax END AS bedroomcnt",
        "CASE WHEN l_linenumber = 5 THEN NULL ELSE l_discount END AS bathroomcnt",
        "l_quantity AS qty",
        "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_returnflag END AS flag_cat",
        "l_linestatus AS status_cat",
        "CAST(CASE WHEN l_orderkey % 10 < 7 THEN 1 ELSE 0 END AS INT) AS is_train",
    ],
)

orders_split, ORDERS_SPLIT = bind(
    "orders",
    [
        "o_orderkey",
        "o_custkey",
        "o_orderstatus AS status_cat",
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS priority_cat",
        "o_totalprice AS price",
        "CAST(o_orderdate AS DATE) AS day",
        "CAST(CASE WHEN o_orderkey % 5 < 4 THEN 1 ELSE 0 END AS INT) AS is_train",
    ],
)

parts, PARTS = bind(
    "part",
    [
        "p_partkey",
        "p_brand AS ps_car_01_cat",
        "CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_type END AS ps_car_02_cat",
        "CAST(CASE WHEN p_retailprice > 950 THEN 1 ELSE 0 END AS INT) AS ps_reg_03_bin",
        "p_size / CAST(10 AS DOUBLE) AS ps_car_12",
        "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_retailprice / 1000 END AS ps_car_13",
        "CASE WHEN p_partkey % 5 < 3 THEN -1 ELSE p_size END AS ps_car_15",
        "CAST(CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS INT) AS target",
        "CAST(CASE WHEN p_partkey % 10 < 7 THEN 1 ELSE 0 END AS INT) AS is_train",
    ],
)

CLAIMS = """SELECT c_custkey, c_mktsegment AS seg_cat,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE n_name END AS nation_cat,
  c_acctbal AS balance, n_regionkey AS region,
  CAST(CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS INT) AS target,
  CAST(CASE WHEN c_custkey % 10 < 7 THEN 1 ELSE 0 END AS INT) AS is_train
FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def claims(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")  # 25 rows
    joined = table(spark, folder, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.selectExpr(
        "c_custkey",
        "c_mktsegment AS seg_cat",
        "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE n_name END AS nation_cat",
        "c_acctbal AS balance",
        "n_regionkey AS region",
        "CAST(CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS INT) AS target",
        "CAST(CASE WHEN c_custkey % 10 < 7 THEN 1 ELSE 0 END AS INT) AS is_train",
    )


COMMENTS = """SELECT d.doc_id, d.text AS comment_text, d.lang, d.source, d.n_chars, l.toxic, l.quality,
  CAST(CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 END AS INT) AS is_train
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def comments(spark: SparkSession, folder: str) -> DataFrame:
    """All documents; those with labels are the train rows."""
    labels = table(spark, folder, "labels").withColumn("is_train", F.lit(1))
    return (
        table(spark, folder, "documents")
        .join(labels, "doc_id", "left")
        .select(
            "doc_id",
            F.col("text").alias("comment_text"),
            "lang",
            "source",
            "n_chars",
            "toxic",
            "quality",
            F.coalesce("is_train", F.lit(0)).alias("is_train"),
        )
    )


VISITS = """SELECT o_orderpriority AS air_store_id, CAST(o_orderdate AS DATE) AS visit_date,
  CAST(count(*) AS DOUBLE) AS visitors,
  CAST(CASE WHEN CAST(o_orderdate AS DATE) < DATE '2001-06-01' THEN 1 ELSE 0 END AS INT) AS is_train
FROM orders GROUP BY 1, 2, 4"""


def visits(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per priority and day; the last two months are the test rows."""
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderpriority").alias("air_store_id"), F.to_date("o_orderdate").alias("visit_date"))
        .agg(F.count(F.lit(1)).cast("double").alias("visitors"))
        .withColumn("is_train", (F.col("visit_date") < F.lit("2001-06-01").cast("date")).cast("int"))
    )


USER_VISITS = """SELECT user_id, CAST(ts AS DATE) AS visit_date, CAST(count(*) AS DOUBLE) AS visitors,
  CAST(CASE WHEN CAST(ts AS DATE) < DATE '2024-01-25' THEN 1 ELSE 0 END AS INT) AS is_train
FROM events GROUP BY 1, 2, 4"""


def user_visits(spark: SparkSession, folder: str) -> DataFrame:
    """Events per user and day; the last days are the test rows."""
    return (
        table(spark, folder, "events")
        .groupBy("user_id", F.to_date("ts").alias("visit_date"))
        .agg(F.count(F.lit(1)).cast("double").alias("visitors"))
        .withColumn("is_train", (F.col("visit_date") < F.lit("2024-01-25").cast("date")).cast("int"))
    )


def pandas_div(a: str, b: str) -> str:
    """x/0 is signed infinity, 0/0 is null."""
    return (
        f"CASE WHEN {b} = 0 THEN CASE WHEN {a} > 0 THEN CAST('inf' AS DOUBLE) "
        f"WHEN {a} < 0 THEN CAST('-inf' AS DOUBLE) END ELSE {a} / {b} END"
    )


def md5_fold(key: str, k: int) -> str:
    return f"CAST(CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % {k} AS INT)"
