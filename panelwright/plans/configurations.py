"""Queries: indicators on a dense grid in all their settings, sampled returns of a universe, files by schema, texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.functions import columns as C
from panelwright.operators import calendar as CAL
from panelwright.operators import indicators as T
from panelwright.operators import joins as J
from panelwright.operators import recursive as U
from panelwright.plans import views as V
from panelwright.plans.joining import _CAL, _RANGE
from panelwright.plans.registry import query, r, rnd, rs
from panelwright.plans.technical import _k_sql, _ultosc_sql, _willr_sql
from panelwright.plans.views import SQL, cents, fill, roll
from panelwright.plans.views import with_views as S
from panelwright.session import scratch
from panelwright.sources import readers as R
from panelwright.sources import writers as O

W = "WINDOW w AS (PARTITION BY ticker ORDER BY date)"

# bars of a fortnight of all suppliers, which trade in nearly every one ---------
_STEP = 14  # days, counted from a Monday
SQL["lines"] = (
    (),
    """SELECT CAST(l_shipdate AS DATE) - CAST((CAST(l_shipdate AS DATE) - DATE '1990-01-01') % 14 AS INTEGER) AS date, CAST(l_suppkey AS BIGINT) AS ticker, max(floor(l_extendedprice / l_quantity * 10000) / 10000) AS high,
       min(floor(l_extendedprice / l_quantity * 10000) / 10000) AS low,
       arg_max(floor(l_extendedprice / l_quantity * 10000) / 10000, row(l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_discount)) AS close
FROM lineitem GROUP BY 1, 2""",
)
SQL["line_grid"] = (
    ("lines",),
    """SELECT d.date, t.ticker, high, low, close FROM (SELECT DISTINCT date FROM lines) d CROSS JOIN (SELECT DISTINCT ticker FROM lines) t
LEFT JOIN lines p ON p.date = d.date AND p.ticker = t.ticker""",
)
SQL["line3"] = (("line_grid",), "SELECT date, ticker, " + ", ".join(f"{cents(fill(c, 3, shift=1))} AS {c}" for c in ("high", "low", "close")) + " FROM line_grid")
SQL["line0"] = (("line_grid",), "SELECT date, ticker, " + ", ".join(f"{cents(f'lag({c}) OVER w')} AS {c}" for c in ("high", "low", "close")) + f" FROM line_grid {W}")


def lines(spark, d):
    rows = V.table(spark, d, "lineitem").select(
        F.date_sub(F.to_date("l_shipdate"), F.pmod(F.date_diff(F.to_date("l_shipdate"), F.lit("1990-01-01").cast("date")), F.lit(_STEP))).alias("date"),
        F.col("l_suppkey").cast("long").alias("ticker"),
        (F.floor(C.ratio("l_extendedprice", "l_quantity") * 10000) / 10000).alias("px"),
        F.col("l_quantity").alias("vol"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount").alias("okey"),
    )
    return V.bars(rows, "date", "ticker")


def _willr(n: int) -> None:
    @query(f"t03_williams_r_{n}_short_fill", _willr_sql(n, "line3"))
    def willr(spark, d):
        return rnd(T.willr(lines(spark, d), n))


@query("t10_ultimate_oscillator_short_fill", _ultosc_sql("line3"))
def ultosc(spark, d):
    return rnd(T.ultosc(lines(spark, d)))


def _numbered(view: str) -> str:
    """Rows from the first price on, numbered from 0."""
    return f"""own AS (SELECT *, row_number() OVER {W.split('AS ')[1]} - 1 AS i FROM
  (SELECT *, count(close) OVER {W.split('AS ')[1]} AS seen FROM {view}) s WHERE seen > 0)"""


def _rsi_sql(n: int) -> str:
    """Wilder's index; a gap ends it."""
    return f"""chg AS (SELECT date, ticker, i, CASE WHEN x > 0 THEN x WHEN x <= 0 THEN 0 END AS up, CASE WHEN x < 0 THEN -x WHEN x >= 0 THEN 0 END AS dn FROM
  (SELECT date, ticker, i, close - lag(close) OVER (PARTITION BY ticker ORDER BY i) AS x FROM own) c),
rsi AS (SELECT ticker, {n}::BIGINT AS i, avg(up) AS g, avg(dn) AS l FROM chg WHERE i BETWEEN 1 AND {n} GROUP BY ticker HAVING count(up) = {n}
  UNION ALL SELECT c.ticker, c.i, (r.g * {n - 1} + c.up) / {n}, (r.l * {n - 1} + c.dn) / {n} FROM rsi r JOIN chg c ON c.ticker = r.ticker AND c.i = r.i + 1),
line AS (SELECT c.date, c.ticker, CASE WHEN g + l = 0 THEN 0.0 ELSE 100 * g / (g + l) END AS rsi FROM rsi JOIN chg c USING (ticker, i))"""


def _stochrsi(n: int, k: int, s: int) -> None:
    tag = f"{n}_{k}_{s}"

    @query(
        f"t01_stochastic_rsi_{tag}",
        S(
            f"""SELECT date, ticker, {r('k', f'STOCHRSI_FASTK_{tag}', 4)}, {r('fd', f'STOCHRSI_FASTD_{tag}', 4)} FROM
            (SELECT date, ticker, k, {roll('avg', 'k', s)} AS fd FROM {_k_sql(k, 'line', 'rsi', 'rsi', 'rsi')} b) c WHERE fd IS NOT NULL""",
            "line3", recursive=True, extra=_numbered("line3") + ",\n" + _rsi_sql(n),
        ),
    )
    def stochrsi(spark, d):
        return rnd(U.stochrsi(lines(spark, d), n, k, s), 4)


def _adx_sql(n: int) -> str:
    """Wilder's sums; a gap ends them, an undefined direction leaves the mean as it was."""
    return f"""mv AS (SELECT date, ticker, i, high - lag(high) OVER w AS up, lag(low) OVER w - low AS dn, high - low AS a, lag(close) OVER w AS pc, high, low
  FROM own WINDOW w AS (PARTITION BY ticker ORDER BY i)),
dm AS (SELECT date, ticker, i, CASE WHEN whole THEN CASE WHEN up > 0 AND up > dn THEN up ELSE 0.0 END END AS p,
    CASE WHEN whole THEN CASE WHEN dn > 0 AND up < dn THEN dn ELSE 0.0 END END AS m, CASE WHEN whole THEN greatest(a, abs(high - pc), abs(low - pc)) END AS t
  FROM (SELECT *, up IS NOT NULL AND dn IS NOT NULL AND a IS NOT NULL AND pc IS NOT NULL AS whole FROM mv) v),
sm AS (SELECT ticker, {n - 1}::BIGINT AS i, sum(p) AS p, sum(m) AS m, sum(t) AS t FROM dm WHERE i BETWEEN 1 AND {n - 1} GROUP BY ticker HAVING count(p) = {n - 1}
  UNION ALL SELECT d.ticker, d.i, s.p - s.p / {n} + d.p, s.m - s.m / {n} + d.m, s.t - s.t / {n} + d.t FROM sm s JOIN dm d ON d.ticker = s.ticker AND d.i = s.i + 1),
dx AS (SELECT ticker, i, t, CASE WHEN t <> 0 AND p + m <> 0 THEN 100 * abs(m - p) / (m + p) END AS dx FROM sm WHERE i >= {n}),
adx AS (SELECT ticker, {2 * n - 1}::BIGINT AS i, sum(coalesce(dx, 0)) / {n} AS adx FROM dx WHERE i BETWEEN {n} AND {2 * n - 1} GROUP BY ticker HAVING count(*) = {n}
  UNION ALL SELECT x.ticker, x.i, CASE WHEN x.dx IS NULL THEN a.adx ELSE (a.adx * {n - 1} + x.dx) / {n} END FROM adx a JOIN dx x ON x.ticker = a.ticker AND x.i = a.i + 1),
line AS (SELECT d.date, d.ticker, adx FROM adx JOIN dx USING (ticker, i) JOIN dm d USING (ticker, i) WHERE dx.t IS NOT NULL)"""


def _adx(n: int) -> None:
    @query(
        f"t05_adx_{n}_grid",
        S(
            f"SELECT date, ticker, {r('adx', f'ADX_{n}')}, {r(roll('avg', 'adx', 3), f'ADX_{n}_MA_3')} FROM line",
            "line0", recursive=True, extra=_numbered("line0") + ",\n" + _adx_sql(n),
        ),
    )
    def adx(spark, d):
        return rnd(U.adx(lines(spark, d), n))


for _n in (14, 63):
    _willr(_n)
for _config in ((14, 5, 3), (30, 10, 5), (63, 15, 10)):
    _stochrsi(*_config)
for _n in (5, 14, 63):
    _adx(_n)


_MONDAYS = f"SELECT (SELECT min(o.date) FROM cal o WHERE o.is_open AND o.date >= c.date) AS date FROM cal c WHERE isodow(c.date) = 1 AND {_RANGE.replace('date BETWEEN', 'c.date BETWEEN')}"


@query(
    "t21_sampled_returns_weekly",
    S(
        f"""SELECT date, ticker, {r('coalesce(lead(ret) OVER w, 0)', 'ret')} FROM (SELECT date, ticker, coalesce(CASE WHEN ret IS NOT NULL THEN
          least(greatest(ret, quantile_cont(ret, 0.005::DOUBLE) OVER (PARTITION BY date)), quantile_cont(ret, 0.995::DOUBLE) OVER (PARTITION BY date)) END, 0) AS ret
          FROM (SELECT date, ticker, x / lag(x) OVER w - 1 AS ret FROM (SELECT * FROM (SELECT date, ticker, {fill('close')} AS x FROM grid) a
            SEMI JOIN ({_MONDAYS}) m USING (date)) b {W}) c
          UNION ALL SELECT date, c_custkey, 0 FROM (SELECT DISTINCT date FROM prices SEMI JOIN ({_MONDAYS}) m USING (date)) x,
            customer WHERE c_custkey NOT IN (SELECT ticker FROM prices)) e {W}""",
        "grid", extra=_CAL,
    ),
)
def sampled_returns_weekly(spark, d):
    rows, universe = V.prices(spark, d), V.table(spark, d, "customer").select(F.col("c_custkey").alias("ticker"))
    start, end = CAL.range_of(rows)
    return rnd(T.sampled_returns(rows, CAL.sample_dates(CAL.calendar(spark), "w-mon", start, end), universe, lead=1))


# files ---------------------------------------------------------------------
@query("src17_strategy_file", S(f"SELECT date, ticker, {rs('close', 'volume')} FROM months", "months"))
def strategy_file(spark, d):
    folder = scratch(spark, "strategy")
    O.write_tables({"strategy": V.months(spark, d).select("date", "ticker", "close", "volume")}, folder, "csv")
    return rnd(R.read_strategy(spark, f"{folder}/strategy", "date DATE, ticker BIGINT, close DOUBLE, volume DOUBLE"))


@query("src18_lineage", "SELECT 'orders.parquet' AS file, count(*) AS n FROM orders UNION ALL SELECT 'lineitem.parquet', count(*) FROM lineitem")
def lineage(spark, d):
    """The files two tables are read from, and the rows each gave."""
    both = [V.table(spark, d, t) for t in ("orders", "lineitem")]
    files = spark.createDataFrame([(f,) for t in both for f in R.lineage(t)], "path string")
    rows = [t.groupBy(F.input_file_name().alias("path")).agg(F.count(F.lit(1)).alias("n")) for t in both]
    found = files.join(rows[0].unionAll(rows[1]), "path")
    return found.select(F.regexp_extract("path", r"(\w+\.parquet)", 1).alias("file"), "n").groupBy("file").agg(F.sum("n").alias("n"))


@query(
    "src19_intervals_from_text",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start_date, CAST(o_orderdate AS DATE) + 30 AS end_date, o_orderpriority AS label FROM orders",
)
def intervals_from_text(spark, d):
    """Dates with a time of day, written as text, come back as days."""
    start = F.to_timestamp("o_orderdate") + F.expr("INTERVAL 9 HOURS")
    rows = V.table(spark, d, "orders").select("o_orderkey", start.alias("start_date"), (start + F.expr("INTERVAL 30 DAYS")).alias("end_date"), F.col("o_orderpriority").alias("label"))
    folder = scratch(spark, "intervals")
    O.write_tables({"intervals": rows}, folder, "csv")
    schema = "o_orderkey BIGINT, start_date TIMESTAMP, end_date TIMESTAMP, label STRING"
    return C.to_day(R.read_table(spark, f"{folder}/intervals", schema, "csv"), "start_date", "end_date")


# texts ---------------------------------------------------------------------
@query(
    "fn_percent_and_signed_text",
    S(
        """SELECT date, ticker, CASE WHEN p >= 0 THEN '' ELSE '-' END || (abs(p) // 100) || '.' || lpad(CAST(abs(p) % 100 AS VARCHAR), 2, '0') || '%' AS share,
        CASE WHEN p > 0 THEN '+' WHEN p < 0 THEN '-' ELSE '' END || (abs(p) // 100) || '.' || lpad(CAST(abs(p) % 100 AS VARCHAR), 2, '0') AS change
        FROM (SELECT date, ticker, CAST(round((close / open - 1) * 10000) AS BIGINT) AS p FROM months) m""",
        "months",
    ),
)
def percent_and_signed_text(spark, d):
    rows = V.months(spark, d).select("date", "ticker", F.round((C.ratio("close", "open") - 1) * 10000).cast("long").alias("p"))
    return rows.select("date", "ticker", C.percent_text(F.col("p") / 100.0).alias("share"), C.signed_text(F.col("p") / 100.0).alias("change"))


@query(
    "fn_display_names",
    """SELECT p_partkey, p_brand AS feature, coalesce(name, p_brand) AS display FROM part LEFT JOIN
    (SELECT 'Brand#' || n_nationkey AS feature, n_name AS name FROM nation) n ON n.feature = p_brand""",
)
def display_names(spark, d):
    """Names for features from a table; a feature without one keeps its own."""
    names = V.table(spark, d, "nation").select(F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("feature"), F.col("n_name").alias("name"))
    rows = V.table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("feature"))
    return J.replace_by(rows, "feature", names, "feature", "name", out="display")
