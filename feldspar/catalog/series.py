"""Calendar features and history over daily series."""

from __future__ import annotations

from pyspark.sql import functions as F

from feldspar.catalog.base import HOUSE_KEY, HOUSES, USER_VISITS, VISITS, houses, query, table, user_visits, visits
from feldspar.functions import calendar as cal
from feldspar.operators import groupstats as gs
from feldspar.operators import history as hi

KEY = ", ".join(HOUSE_KEY)
DAYS = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders"


def _days(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))


def _week(d: str) -> str:
    return f"CASE WHEN month({d}) = 1 AND week({d}) > 5 THEN 1 ELSE week({d}) END"


def _since(d: str, unit: str) -> str:
    start = f"CAST(date_trunc('{unit}', {d}) AS DATE)"
    return f"{_week(d)} - CASE WHEN month({d}) = 1 AND week({start}) > 5 THEN 1 ELSE week({start}) END + 1"


CALENDAR_SQL = {
    "year": "year(d)",
    "quarter": "quarter(d)",
    "month": "month(d)",
    "week": _week("d"),
    "wom": _since("d", "month"),
    "woq": _since("d", "quarter"),
    "moq": "month(d) - (quarter(d) - 1) * 3",
    "dom": "day(d)",
    "doy": "dayofyear(d)",
    "doq": "date_diff('day', CAST(date_trunc('quarter', d) AS DATE), d) + 1",
    "dow": "isodow(d) - 1",
}


def _calendar_sql(names, extra="") -> str:
    cells = ", ".join(f"CAST({CALENDAR_SQL[n]} AS INT) AS {n}" for n in names)
    return f"SELECT o_orderkey, {cells}{extra} FROM ({DAYS})"


@query(
    "calendar_columns",
    _calendar_sql(CALENDAR_SQL, f", CAST(date_diff('day', (SELECT min(d) FROM ({DAYS})), d) AS INT) AS dot"),
)
def _(spark, d):
    df = _days(spark, d)
    first = df.agg(F.min("d")).first()[0]
    return df.select("o_orderkey", *[c.alias(n) for n, c in cal.calendar_fields(F.col("d"), F.lit(first)).items()])


@query("week_of_quarter", _calendar_sql(["woq"]))
def _(spark, d):
    return _days(spark, d).select("o_orderkey", cal.week_of_quarter(F.col("d")).alias("woq"))


@query("week_of_month", _calendar_sql(["wom"]))
def _(spark, d):
    return _days(spark, d).select("o_orderkey", cal.week_of_month(F.col("d")).alias("wom"))


@query("month_of_quarter", _calendar_sql(["moq"]))
def _(spark, d):
    return _days(spark, d).select("o_orderkey", cal.month_of_quarter(F.col("d")).alias("moq"))


@query("day_of_quarter", f"SELECT o_orderkey, doq AS visit_dayofquarter FROM ({_calendar_sql(['doq'])})")
def _(spark, d):
    return _days(spark, d).select("o_orderkey", cal.day_of_quarter(F.col("d")).alias("visit_dayofquarter"))


@query("period_day_columns", f"SELECT o_orderkey, doy AS visit_dayofyear, quarter FROM ({_calendar_sql(['doy', 'quarter'])})")
def _(spark, d):
    return _days(spark, d).select("o_orderkey", F.dayofyear("d").alias("visit_dayofyear"), F.quarter("d").alias("quarter"))


@query(
    "month_range_bounds",
    f"""SELECT o_orderkey, CAST(date_trunc('month', d) - INTERVAL 3 MONTH AS DATE) AS range_begin,
  CAST(date_trunc('month', d) - INTERVAL 1 DAY AS DATE) AS range_end FROM ({DAYS})""",
    dates=["range_begin", "range_end"],
)
def _(spark, d):
    return _days(spark, d).select(
        "o_orderkey", cal.months_before(F.col("d"), 3).alias("range_begin"), cal.end_of_previous_month(F.col("d")).alias("range_end")
    )


@query(
    "days_since_start",
    f"SELECT o_orderkey, CAST(date_diff('day', (SELECT min(d) FROM ({DAYS})), d) AS INT) AS dot FROM ({DAYS})",
)
def _(spark, d):
    df = _days(spark, d)
    start = df.agg(F.min("d").alias("start")).scalar()
    return df.select("o_orderkey", cal.days_since(F.col("d"), start).alias("dot"))


HOLIDAY = f"""SELECT air_store_id, visit_date, year(visit_date) AS year, {_week('visit_date')} AS week, isodow(visit_date) - 1 AS dow,
  CAST(CASE WHEN visitors < 3 AND day(visit_date) % 3 = 0 THEN 1 ELSE 0 END AS INT) AS flg FROM ({VISITS})"""


def _holiday_rows(spark, d):
    day = F.col("visit_date")
    return visits(spark, d).select(
        "air_store_id",
        "visit_date",
        F.year(day).alias("year"),
        cal.week(day).alias("week"),
        F.weekday(day).alias("dow"),
        ((F.col("visitors") < 3) & (F.dayofmonth(day) % 3 == 0)).cast("int").alias("flg"),
    )


WEEKS = f"""SELECT year, week, CAST(sum(hit) AS BIGINT) AS cur FROM
  (SELECT year, week, dow, CASE WHEN sum(flg) <> 0 THEN 1 ELSE 0 END AS hit FROM ({HOLIDAY}) GROUP BY 1, 2, 3) GROUP BY 1, 2"""


@query(
    "holiday_week_count",
    f"""WITH w AS (SELECT *, lag(cur) OVER (ORDER BY year, week) AS prev, lead(cur) OVER (ORDER BY year, week) AS nxt FROM ({WEEKS}))
SELECT air_store_id, visit_date, cur AS holiday_cnt_currweek, prev AS holiday_cnt_lastweek, nxt AS holiday_cnt_nextweek
FROM ({HOLIDAY}) h JOIN w USING (year, week)""",
    dates=["visit_date"],
)
def _(spark, d):
    out, new = gs.holiday_week_count(_holiday_rows(spark, d), "flg")
    return out.select("air_store_id", "visit_date", *new)


@query(
    "lag_lead_week",
    f"""SELECT year, week, n, lag(n) OVER (ORDER BY year, week) AS last_n, lead(n) OVER (ORDER BY year, week) AS next_n
FROM (SELECT year(d) AS year, CAST({_week('d')} AS INT) AS week, count(*) AS n FROM ({DAYS}) GROUP BY 1, 2)""",
)
def _(spark, d):
    weeks = _days(spark, d).groupBy(F.year("d").alias("year"), cal.week(F.col("d")).alias("week")).agg(F.count(F.lit(1)).alias("n"))
    return gs.lag_lead(weeks, "n", ["year", "week"], "last_n", "next_n")


# ---- lagged history ----


def _masked(source: str) -> str:
    return f"SELECT *, CASE WHEN is_train = 1 THEN visitors END AS v, date_diff('day', DATE '1970-01-01', visit_date) AS dn FROM ({source})"


def _mean_count_std_sql(source: str, entity: str, offset: int) -> tuple[str, list[str]]:
    """Self-join formulation: every row with the days of its own lagged window."""
    import math

    weeks = math.ceil(offset / 7)
    grid = [(1, (weeks + i) * 7) for i in range(4)] + [(7, offset + i * 7 + 1) for i in range(4)]
    grid += [(30, offset + i * 30 + 1) for i in range(2)] + [(60, offset + i * 60 + 1) for i in range(2)]
    cells, rounds = [], []
    for length, tp in grid:
        inside = f"FILTER (WHERE p.dn BETWEEN s.dn - {tp + length - 1} AND s.dn - {tp})"
        span = f"over_day_{tp}-{tp + length - 1}_in_past"
        cells.append(f'avg(p.v) {inside} AS "store_visitors_mean_{span}"')
        cells.append(
            f"CASE WHEN max(s.known) AND s.dn - {tp} >= max(s.first_dn) THEN count(p.v) {inside} END AS \"store_visitors_count_{span}\""
        )
        rounds.append(f"store_visitors_mean_{span}")
        if length > 1:
            cells.append(f'stddev_samp(p.v) {inside} AS "store_visitors_std_{span}"')
            rounds.append(f"store_visitors_std_{span}")
    far = max(tp + length for length, tp in grid)
    sql = f"""WITH b AS ({_masked(source)}),
s AS (SELECT b.*, e.first_dn, e.known FROM b JOIN (SELECT {entity}, min(dn) AS first_dn, count(v) > 0 AS known FROM b GROUP BY 1) e USING ({entity}))
SELECT s.{entity}, s.visit_date, {', '.join(cells)}
FROM s LEFT JOIN b p ON p.{entity} = s.{entity} AND p.dn BETWEEN s.dn - {far} AND s.dn GROUP BY s.{entity}, s.visit_date, s.dn"""
    return sql, rounds


# The test days span 2001-06-01..2001-08-01 (orders) and 2024-01-25..2024-01-30 (events).
_LONG, _LONG_ROUNDS = _mean_count_std_sql(VISITS, "air_store_id", 61)
_SHORT, _SHORT_ROUNDS = _mean_count_std_sql(USER_VISITS, "user_id", 5)


@query("history_mean_count_std", _LONG, rounds=_LONG_ROUNDS, dates=["visit_date"])
def _(spark, d):
    out, new = hi.history_mean_count_std(visits(spark, d), "air_store_id", "visit_date", "visitors", [])
    return out.select("air_store_id", "visit_date", *new)


@query("history_mean_count_std_users", _SHORT, rounds=_SHORT_ROUNDS, dates=["visit_date"])
def _(spark, d):
    out, new = hi.history_mean_count_std(user_visits(spark, d), "user_id", "visit_date", "visitors", [])
    return out.select("user_id", "visit_date", *new)


def _stat_cells(v: str, inside: str, name, constant: str) -> list[str]:
    """Nine statistics; skewness and kurtosis of constant values are ``constant``."""
    n = f"count({v}) {inside}"
    varied = f"max({v}) {inside} > min({v}) {inside}"
    return [
        f'avg({v}) {inside} AS "{name("mean")}"',
        f'quantile_cont({v}, 0.5) {inside} AS "{name("med")}"',
        f'CASE WHEN {n} > 0 THEN {n} / sum(1 / CASE WHEN {v} = 0 THEN 0.1 ELSE {v} END) {inside} END AS "{name("hmean")}"',
        f'stddev_samp({v}) {inside} AS "{name("std")}"',
        f'CASE WHEN {varied} THEN skewness({v}) {inside} WHEN {n} >= 3 THEN {constant} END AS "{name("skew")}"',
        f'CASE WHEN {varied} THEN kurtosis({v}) {inside} WHEN {n} >= 4 THEN {constant} END AS "{name("kurt")}"',
        f'quantile_cont({v}, 0.1) {inside} AS "{name("pct10")}"',
        f'quantile_cont({v}, 0.9) {inside} AS "{name("pct90")}"',
    ]


ROUND_STATS = ("mean", "med", "hmean", "std", "skew", "kurt", "pct10", "pct90")


def _distribution_sql(tp: int) -> tuple[str, list[str]]:
    cells, rounds = [], []
    for length in (30, 60, 90, 180, 360):
        inside = f"FILTER (WHERE p.dn BETWEEN s.dn - {tp + length - 1} AND s.dn - {tp})"
        name = lambda s, length=length: f"{s}_on_{tp + length - 1}-{tp}({length})"
        cells.append(f"CASE WHEN s.dn - {tp} >= max(s.first_dn) THEN count(p.v) {inside} END AS \"{name('cnt')}\"")
        cells += _stat_cells("p.v", inside, name, "NULL")
        rounds += [name(s) for s in ROUND_STATS]
    sql = f"""WITH b AS ({_masked(VISITS)}),
s AS (SELECT b.*, e.first_dn FROM b JOIN (SELECT air_store_id, min(dn) AS first_dn FROM b GROUP BY 1) e USING (air_store_id))
SELECT s.air_store_id, s.visit_date, {', '.join(cells)}
FROM s LEFT JOIN b p ON p.air_store_id = s.air_store_id AND p.dn BETWEEN s.dn - {tp + 359} AND s.dn - {tp}
GROUP BY s.air_store_id, s.visit_date, s.dn"""
    return sql, rounds


_DIST, _DIST_ROUNDS = _distribution_sql(61)


@query("history_distribution", _DIST, rounds=_DIST_ROUNDS, dates=["visit_date"])
def _(spark, d):
    out, new = hi.history_distribution(visits(spark, d), "air_store_id", "visit_date", "visitors", [])
    return out.select("air_store_id", "visit_date", *new)


FLAGGED = f"""SELECT *, CASE WHEN day(visit_date) = 13 THEN NULL ELSE CAST(CASE WHEN isodow(visit_date) >= 6 THEN 1 ELSE 0 END AS INT) END AS weekend,
  CASE WHEN day(visit_date) % 10 = 7 THEN NULL ELSE visitors END AS seen, year(visit_date) * 12 + month(visit_date) AS m FROM ({VISITS})"""


def _flag_sql() -> tuple[str, list[str]]:
    cells, rounds = [], []
    for r in hi.FLAG_MONTHS:
        inside = f"FILTER (WHERE p.m BETWEEN s.m - {r} AND s.m - 1)"
        name = lambda s, r=r: f"weekend_{s}_{r}month(s)"
        cells.append(f"CASE WHEN count(p.air_store_id) {inside} > 0 THEN count(p.seen) {inside} END AS \"{name('cnt')}\"")
        cells += _stat_cells("p.seen", inside, name, "0.0")
        rounds += [name(s) for s in ROUND_STATS]
    keys = "air_store_id, weekend, m"
    names = ", ".join(f'x."weekend_{s}_{r}month(s)"' for s in hi.FLAG_STATS for r in hi.FLAG_MONTHS)
    sql = f"""WITH f AS ({FLAGGED}), s AS (SELECT DISTINCT {keys} FROM f),
x AS (SELECT s.air_store_id, s.weekend, s.m, {', '.join(cells)} FROM s LEFT JOIN f p
  ON p.air_store_id = s.air_store_id AND p.weekend = s.weekend AND p.m BETWEEN s.m - 12 AND s.m - 1 GROUP BY 1, 2, 3)
SELECT f.air_store_id, f.visit_date, f.weekend, {names} FROM f LEFT JOIN x
  ON x.air_store_id = f.air_store_id AND x.weekend = f.weekend AND x.m = f.m"""
    return sql, rounds


_FLAG, _FLAG_ROUNDS = _flag_sql()


@query("flag_history", _FLAG, rounds=_FLAG_ROUNDS, dates=["visit_date"])
def _(spark, d):
    day = F.col("visit_date")
    df = visits(spark, d).withColumns(
        {
            "weekend": F.when(F.dayofmonth(day) != 13, (F.weekday(day) >= 5).cast("int")),
            "seen": F.when(F.dayofmonth(day) % 10 != 7, F.col("visitors")),
        }
    )
    out, new = hi.flag_history(df, "air_store_id", "visit_date", "seen", "weekend")
    return out.select("air_store_id", "visit_date", "weekend", *new)


@query(
    "weekday_interpolate",
    f"""WITH b AS (SELECT user_id, visit_date, CASE WHEN is_train = 1 THEN visitors END AS v FROM ({USER_VISITS})),
g AS (SELECT user_id, CAST(unnest(generate_series(min(visit_date), max(visit_date), INTERVAL 1 DAY)) AS DATE) AS day FROM b GROUP BY 1),
j AS (SELECT g.user_id, g.day, CAST(isodow(g.day) - 1 AS INT) AS weekday, v FROM g LEFT JOIN b ON b.user_id = g.user_id AND b.visit_date = g.day),
p AS (SELECT *, last_value(v IGNORE NULLS) OVER w AS pv, last_value(CASE WHEN v IS NOT NULL THEN day END IGNORE NULLS) OVER w AS pd,
  first_value(v IGNORE NULLS) OVER x AS nv, first_value(CASE WHEN v IS NOT NULL THEN day END IGNORE NULLS) OVER x AS nd FROM j
  WINDOW w AS (PARTITION BY user_id, weekday ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         x AS (PARTITION BY user_id, weekday ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT user_id, day, weekday, CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN nv
  ELSE pv + (nv - pv) * (day - pd) / (nd - pd) END AS value FROM p""",
    rounds=["value"],
    dates=["day"],
)
def _(spark, d):
    daily = hi.daily_series(user_visits(spark, d), "user_id", "visit_date", "visitors", [])
    return hi.weekday_interpolate(daily, "user_id")


@query(
    "null_state_running_count",
    f"""SELECT {KEY}, """
    + ", ".join(
        f"row_number() OVER (PARTITION BY {c} IS NULL ORDER BY transactiondate, {KEY}) AS {c}_nan_cond_accu" for c in ("bedroomcnt", "flag_cat")
    )
    + f" FROM ({HOUSES})",
)
def _(spark, d):
    out, new = hi.null_state_running_count(houses(spark, d), ["bedroomcnt", "flag_cat"], ["transactiondate", *HOUSE_KEY])
    return out.select(*HOUSE_KEY, *new)


@query("history_decayed", dates=["visit_date"])
def _(spark, d):
    out, new = hi.history_decayed(visits(spark, d), "air_store_id", "visit_date", "visitors", [])
    return out.select("air_store_id", "visit_date", *new)


@query("ridge_trend", dates=["visit_date"])
def _(spark, d):
    df = visits(spark, d).withColumn("row_key", F.concat_ws("|", "air_store_id", "visit_date"))
    first = df.agg(F.min("visit_date")).first()[0]
    df = df.withColumns(cal.calendar_fields(F.col("visit_date"), F.lit(first)))
    df = df.withColumns({"dayofwork": F.col("dow") % 5, "dayofholiday": (F.col("dow") >= 5).cast("int")})
    out, new = hi.ridge_trend(df, "air_store_id", "visitors", "row_key")
    return out.select("air_store_id", "visit_date", "visitors", *new)
