"""Queries: flagship, windows, null rules, reshaping, projections and filters."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelwright.functions import columns as C
from panelwright.operators import grid as G
from panelwright.operators import indicators as T
from panelwright.operators import picks as K
from panelwright.operators.crosssec import standardize
from panelwright.operators.order_stats import avg_rank, fill_median, qcut, quantiles, winsorize
from panelwright.plans import views as V
from panelwright.plans.registry import query, r, rnd, rs
from panelwright.plans.views import fill, over, pct_rank_sql, qcut_sql, roll, with_views

S = with_views

# Flagship: tick bars -> monthly past return -> clip and score per date -> quintile -> mean later return
_CLIP = (
    "CASE WHEN momentum_score IS NOT NULL THEN least(greatest(momentum_score,"
    " quantile_cont(momentum_score, 0.005::DOUBLE) OVER (PARTITION BY date)),"
    " quantile_cont(momentum_score, 0.995::DOUBLE) OVER (PARTITION BY date)) END"
)


@query(
    "flagship_momentum_quintiles",
    S(
        f"""SELECT date, {", ".join(f"round(avg(CASE WHEN qt = {i} THEN future_ret_5B END), 6) + 0 AS q{i}" for i in range(5))},
        CAST(count(*) AS BIGINT) AS n
        FROM (SELECT date, future_ret_5B, {qcut_sql('x')} AS qt FROM
              (SELECT date, ticker, future_ret_5B, {_CLIP} AS x FROM scores WHERE momentum_score IS NOT NULL) c) b
        GROUP BY date""",
        "scores",
    ),
)
def flagship(spark, d):
    rows = V.scores(spark, d).where(F.col("momentum_score").isNotNull())
    panel = rows.select("date", "ticker", "momentum_score", "future_ret_5B")
    scored = standardize(panel, ["momentum_score"], exclude=["future_ret_5B"])
    bucketed = qcut(scored, "momentum_score", 5, ["date"], 0, "qt")
    out = bucketed.groupBy("date").agg(
        *[F.avg(F.when(F.col("qt") == i, F.col("future_ret_5B"))).alias(f"q{i}") for i in range(5)],
        F.count(F.lit(1)).alias("n"),
    )
    return rnd(out)


@query("s02_tick_bars", S(f"SELECT date, ticker, {rs('open', 'high', 'low', 'close', 'volume')} FROM prices", "prices"))
def tick_bars(spark, d):
    return rnd(V.prices(spark, d))


@query("r01_densify", S(f"SELECT date, ticker, {rs('close', 'volume')} FROM grid", "grid"))
def densify(spark, d):
    return rnd(G.densify(V.prices(spark, d).select("date", "ticker", "close", "volume")))


@query(
    "r02_stack",
    S("SELECT date, ticker, feature, round(value, 6) + 0 AS value FROM (UNPIVOT (SELECT date, ticker, open, close FROM grid) ON open, close INTO NAME feature VALUE value)", "grid"),
)
def stack(spark, d):
    cells = G.densify(V.prices(spark, d).select("date", "ticker", "open", "close"))
    return rnd(G.stacked(cells, ["date", "ticker"], ["open", "close"]))


@query(
    "r03_bounded_pivot",
    S(
        f"""SELECT date, {", ".join(f"round(avg(CASE WHEN series = '{s}' THEN value END), 4) + 0 AS {s}" for s in V.SERIES.values())}
        FROM macro_daily GROUP BY date""",
        "macro_daily",
    ),
)
def bounded_pivot(spark, d):
    return rnd(G.widen(V.macro_daily(spark, d), "date", "series", list(V.SERIES.values()), "value"), 4)


@query(
    "w01_lag_lead",
    S(
        f"""SELECT date, ticker, {r('lag(close, 5) OVER w', 'back')}, {r('lead(close, 5) OVER w', 'ahead')} FROM prices
        WINDOW w AS (PARTITION BY ticker ORDER BY date)""",
        "prices",
    ),
)
def lag_lead(spark, d):
    return rnd(V.prices(spark, d).select("date", "ticker", C.lag_n("close", 5).alias("back"), C.lag_n("close", -5).alias("ahead")))


@query(
    "w02_lag_all_columns",
    S(
        f"""SELECT date, ticker, {", ".join(r(f'lag({c}) OVER w', c) for c in ('open', 'high', 'low', 'close', 'volume'))} FROM prices
        WINDOW w AS (PARTITION BY ticker ORDER BY date)""",
        "prices",
    ),
)
def lag_all(spark, d):
    return rnd(C.lag_all(V.prices(spark, d), ["open", "high", "low", "close", "volume"]))


_DIFFS = {
    "d1": "close - l1",
    "d2": "(close - l1) - (l1 - l2)",
    "ld": "ln(close) - ln(l1)",
    "ld2": "(ln(close) - ln(l1)) - (ln(l1) - ln(l2))",
    "pd": "(close / l1 - 1) - (l1 / l2 - 1)",
}


@query(
    "w03_differences",
    S(
        f"""SELECT date, ticker, {", ".join(r(e, n) for n, e in _DIFFS.items())} FROM
        (SELECT *, lag(close) OVER w AS l1, lag(close, 2) OVER w AS l2 FROM months WINDOW w AS (PARTITION BY ticker ORDER BY date)) x""",
        "months",
    ),
)
def differences(spark, d):
    codes = {"d1": 2, "d2": 3, "ld": 5, "ld2": 6, "pd": 7}
    return rnd(V.months(spark, d).select("date", "ticker", *[C.transform_code("close", k).alias(n) for n, k in codes.items()]))


@query(
    "w04_pct_change",
    S(
        f"""SELECT date, ticker, {r('x / lag(x, 5) OVER w - 1', 'padded')}, {r('close / lag(close, 5) OVER w - 1', 'plain')} FROM
        (SELECT date, ticker, close, {fill('close')} AS x FROM grid) f WINDOW w AS (PARTITION BY ticker ORDER BY date)""",
        "grid",
    ),
)
def pct_changes(spark, d):
    cells = G.densify(V.prices(spark, d).select("date", "ticker", "close"))
    both = C.pct_change(C.pct_change(cells, "close", 5, "padded"), "close", 5, "plain", pad=False)
    return rnd(both.select("date", "ticker", "padded", "plain"))


_ROLLS = {"avg": "avg", "std": "stddev_samp", "var": "var_samp", "max": "max", "min": "min", "sum": "sum"}


@query(
    "w05_rolling_stats",
    S(
        f"""SELECT date, ticker, {", ".join(r(roll(f, 'x', 21), f'{n}_21', 5) for n, f in _ROLLS.items())},
        {r(roll('avg', 'x', 4, 1), 'avg_4_min1')} FROM
        (SELECT date, ticker, close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS x FROM prices) p""",
        "prices",
    ),
)
def rolling_stats(spark, d):
    rows = V.prices(spark, d).select("date", "ticker", (F.col("close") / C.lag_n("close", 1) - 1).alias("x"))
    out = rows.select(
        "date", "ticker",
        *[C.rolling("x", 21, n).alias(f"{n}_21") for n in _ROLLS],
        C.rolling("x", 4, "avg", 1).alias("avg_4_min1"),
    )
    return rnd(out, 5, avg_4_min1=6)


@query("w08_rank_per_date", S("SELECT date, ticker, rank() OVER (PARTITION BY date ORDER BY volume) + (count(*) OVER (PARTITION BY date, volume) - 1) / 2.0 AS volume_rank FROM prices", "prices"))
def rank_per_date(spark, d):
    return avg_rank(V.prices(spark, d).select("date", "ticker", "volume"), "volume", "volume_rank").drop("volume")


@query("w09_percent_rank", S(f"SELECT date, ticker, round({pct_rank_sql('size_score')}, 9) + 0 AS pct FROM scores", "scores"))
def percent_rank(spark, d):
    rows = V.scores(spark, d).select("date", "ticker", "size_score")
    return rnd(avg_rank(rows, "size_score", "pct", pct=True).drop("size_score"), 9)


@query(
    "w10_forward_fill",
    S(f"SELECT date, ticker, {r(fill('close', 3), 'upto_3')}, {r(fill('close'), 'without_limit')} FROM grid", "grid"),
)
def forward_fill(spark, d):
    cells = G.densify(V.prices(spark, d).select("date", "ticker", "close"))
    return rnd(cells.select("date", "ticker", C.ffill("close", 3).alias("upto_3"), C.ffill("close").alias("without_limit")))


@query(
    "w12_keep_first",
    S(
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice, 2) + 0 AS price FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_extendedprice, l_suppkey, l_discount) = 1"""
    ),
)
def keep_first(spark, d):
    rows = V.table(spark, d, "lineitem").withColumnRenamed("l_extendedprice", "price")
    order = [F.desc("l_shipdate"), F.col("l_partkey"), F.col("price"), F.col("l_suppkey"), F.col("l_discount")]
    one = K.first_by(rows, ["l_orderkey", "l_linenumber"], order)
    return rnd(one.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price"), 2)


@query(
    "w13_cumulative_product",
    S(
        f"SELECT date, ticker, {r(f'exp(sum(ln(1 + x)) {over()}) - 1', 'cum')} FROM (SELECT date, ticker, coalesce(momentum_score, 0.0) AS x FROM scores) s",
        "scores",
    ),
)
def cumulative_product(spark, d):
    rows = V.scores(spark, d).fillna(0.0, ["momentum_score"])
    return rnd(rows.select("date", "ticker", C.cumprod1("momentum_score").alias("cum")))


@query(
    "w14_drawdown",
    S(
        f"""SELECT date, ticker, {r('wealth')}, {r('peak')}, {r('(wealth - peak) / peak', 'drawdown')} FROM
        (SELECT date, ticker, wealth, max(wealth) {over()} AS peak FROM
         (SELECT date, ticker, exp(sum(ln(1 + x)) {over()}) AS wealth FROM (SELECT date, ticker, coalesce(momentum_score, 0.0) AS x FROM scores) s) a) b""",
        "scores",
    ),
)
def drawdowns(spark, d):
    rows = V.scores(spark, d).fillna(0.0, ["momentum_score"]).select("date", "ticker", "momentum_score")
    return rnd(C.drawdown(rows, "momentum_score", ["ticker"]).drop("momentum_score"))


@query(
    "w15_longest_run",
    S(
        """SELECT ticker, CAST(max(CASE WHEN hit THEN len ELSE 0 END) AS BIGINT) AS run FROM
        (SELECT ticker, hit, grp, count(*) AS len FROM
          (SELECT ticker, hit, row_number() OVER (PARTITION BY ticker ORDER BY date) - row_number() OVER (PARTITION BY ticker, hit ORDER BY date) AS grp FROM
            (SELECT date, ticker, coalesce(momentum_score > 0, false) AS hit FROM scores) a) b GROUP BY ticker, hit, grp) c GROUP BY ticker""",
        "scores",
    ),
)
def longest_run(spark, d):
    rows = V.scores(spark, d).select("date", "ticker", "momentum_score")
    return K.longest_run(rows, "momentum_score", 1, ["ticker"], ["date"], [])


@query(
    "w17_simple_moving_average",
    S(f"SELECT date, ticker, {r(roll('avg', 'close', 3), 'sma_3')} FROM prices", "prices"),
)
def sma(spark, d):
    return rnd(V.prices(spark, d).select("date", "ticker", C.rolling("close", 3).alias("sma_3")))


@query(
    "w18_sequences",
    S(
        """SELECT date, ticker, round(list_sum(closes), 4) + 0 AS closes_sum, round(closes[6], 4) + 0 AS last_close, CAST(len(closes) AS INTEGER) AS steps FROM
        (SELECT date, ticker, list(close) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS closes,
                lead(close, 6) OVER (PARTITION BY ticker ORDER BY date) AS more FROM months) m WHERE len(closes) = 6 AND more IS NOT NULL""",
        "months",
    ),
)
def sequences(spark, d):
    from panelwright.operators.models import sequences as windows

    rows = windows(V.months(spark, d).select("date", "ticker", "close", "volume"), ["close", "volume"], 6)
    return rnd(
        rows.select(
            "date", "ticker",
            F.aggregate("sequence", F.lit(0.0), lambda a, s: a + s["close"]).alias("closes_sum"),
            F.col("sequence")[5]["close"].alias("last_close"),
            F.size("sequence").alias("steps"),
        ),
        4,
    )


# projections and filters ---------------------------------------------------
@query("p01_normalize_days", "SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events")
def normalize_days(spark, d):
    rows = V.table(spark, d, "events").select("event_id", "user_id", F.col("ts").alias("day"))
    return C.to_day(rows, "day")


@query("p02_select_by_prefix", "SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS l_shipdate FROM lineitem")
def select_by_prefix(spark, d):
    rows = C.to_day(V.table(spark, d, "lineitem"), "l_shipdate")
    return C.select_like(rows, prefix="l_ship", keep=["l_orderkey", "l_linenumber"])


@query("p03_rename_by_rule", S(f"SELECT date, ticker, {r('open', 'open_std')}, {r('close', 'close_std')} FROM months", "months"))
def rename_by_rule(spark, d):
    rows = V.months(spark, d).select("date", "ticker", "open", "close")
    return rnd(C.rename_like(rows, lambda n: n if n in ("date", "ticker") else f"{n}_std"))


@query(
    "p06_expression_columns",
    S(f"SELECT date, ticker, {r('volume * (open + close) / 2.0', 'dollar_volume')}, {r('(open + close) / 2.0', 'average_price')} FROM prices", "prices"),
)
def expression_columns(spark, d):
    rows = V.prices(spark, d).select(
        "date", "ticker", F.expr("volume * (open + close) / 2.0").alias("dollar_volume"), F.expr("(open + close) / 2.0").alias("average_price")
    )
    return rnd(rows)


_P7 = f"""SELECT date, ticker, {r('ln(nullif(volatility_21, 0))', 'volatility_21')}, {r('ln(adv)', 'log_avg_dollar_volume')}, {r('r126 - r21', 'momentum')} FROM
(SELECT date, ticker, {roll('stddev_samp', 'lr', 21)} * sqrt(252) AS volatility_21, {roll('avg', 'close * volume', 21)} AS adv,
  coalesce(p1 / p127 - 1, 0) AS r126, coalesce(p1 / p22 - 1, 0) AS r21 FROM
  (SELECT *, lag(close, 1) OVER w AS p1, lag(close, 22) OVER w AS p22, lag(close, 127) OVER w AS p127,
     ln(lag(close, 1) OVER w) - ln(lag(close, 2) OVER w) AS lr FROM prices WINDOW w AS (PARTITION BY ticker ORDER BY date)) a) b"""


@query("p07_log_and_momentum", S(_P7, "prices"))
def log_and_momentum(spark, d):
    rows = V.prices(spark, d)
    vol = T.volatility(rows, [21]).withColumn("volatility_21", F.ln("volatility_21"))
    rets = T.past_returns(rows, [21, 126])
    adv = rows.select("date", "ticker", C.rolling(F.col("close") * F.col("volume"), 21).alias("adv"))
    joined = vol.join(rets, ["date", "ticker"]).join(adv, ["date", "ticker"])
    return rnd(
        joined.select(
            "date", "ticker", "volatility_21", F.ln("adv").alias("log_avg_dollar_volume"),
            (F.col("ret_126B") - F.col("ret_21B")).alias("momentum"),
        )
    )


@query("f01_date_range", S(f"SELECT date, ticker, {rs('close')} FROM prices WHERE date BETWEEN DATE '1996-03-15' AND DATE '1999-06-30'", "prices"))
def date_range(spark, d):
    rows = V.prices(spark, d).where(F.col("date").between(F.lit("1996-03-15").cast("date"), F.lit("1999-06-30").cast("date")))
    return rnd(rows.select("date", "ticker", "close"))


@query("f02_membership_filter", S("SELECT date, ticker, round(close, 6) + 0 AS close FROM prices SEMI JOIN (SELECT dcm_security_id AS ticker FROM master WHERE Sector = 'ASIA') m USING (ticker)", "prices", "master"))
def membership_filter(spark, d):
    from panelwright.operators.joins import restrict_to

    asia = V.master(spark, d).where(F.col("Sector") == "ASIA")
    rows = restrict_to(V.prices(spark, d), asia, ("ticker", "dcm_security_id"))
    return rnd(rows.select("date", "ticker", "close"))


@query(
    "f04_infinite_to_null",
    S(
        """SELECT date, ticker, CASE WHEN momentum_score = 0 THEN NULL ELSE round(1 / momentum_score, 4) + 0 END AS as_null,
        CASE WHEN momentum_score = 0 THEN 0.0 ELSE round(1 / momentum_score, 4) + 0 END AS as_zero FROM scores""",
        "scores",
    ),
)
def infinite_to_null(spark, d):
    x = F.col("momentum_score")
    inverse = F.when(x == 0, F.lit(float("inf"))).otherwise(C.ratio(F.lit(1.0), x))
    rows = V.scores(spark, d).select("date", "ticker", inverse.alias("as_null"), inverse.alias("as_zero"))
    return rnd(C.finite(C.finite(rows, ["as_null"]), ["as_zero"], 0.0), 4)


@query("f05_null_to_constant", S(f"SELECT date, ticker, {r('coalesce(momentum_score, 0)', 'momentum_score')} FROM scores", "scores"))
def null_to_constant(spark, d):
    return rnd(V.scores(spark, d).select("date", "ticker", "momentum_score").fillna(0.0))


@query(
    "f06_null_to_median",
    S(f"SELECT date, ticker, {r('coalesce(future_ret_5B, quantile_cont(future_ret_5B, 0.5::DOUBLE) OVER (PARTITION BY date))', 'future_ret_5B')} FROM scores", "scores"),
)
def null_to_median(spark, d):
    return rnd(fill_median(V.scores(spark, d).select("date", "ticker", "future_ret_5B"), ["future_ret_5B"]))


@query(
    "f07_drop_empty_rows",
    S(f"SELECT date, ticker, {rs('momentum_score', 'future_ret_5B')} FROM scores WHERE momentum_score IS NOT NULL OR future_ret_5B IS NOT NULL", "scores"),
)
def drop_empty_rows(spark, d):
    rows = V.scores(spark, d).select("date", "ticker", "momentum_score", "future_ret_5B")
    return rnd(rows.dropna("all", subset=["momentum_score", "future_ret_5B"]))


@query(
    "f08_coerce_numeric",
    "SELECT event_id, round(TRY_CAST(regexp_extract(props, '[0-9]+') AS DOUBLE), 6) + 0 AS k, TRY_CAST(event_type AS DOUBLE) AS kind FROM events",
)
def coerce_numeric(spark, d):
    rows = V.table(spark, d, "events").select("event_id", F.regexp_extract("props", "[0-9]+", 0).alias("k"), F.col("event_type").alias("kind"))
    return rnd(C.numeric(rows, ["k", "kind"]))


@query(
    "f09_drop_first_rows",
    S(f"SELECT date, {rs(*V.SERIES.values(), digits=4)} FROM macro QUALIFY row_number() OVER (ORDER BY date) > 2", "macro"),
)
def drop_first_rows(spark, d):
    from panelwright.operators.macro import drop_head

    return rnd(drop_head(V.macro(spark, d), 2), 4)


@query("f10_drop_columns", S(f"SELECT date, {rs('GS10', 'USTRADE', 'CPFF', digits=4)} FROM macro", "macro"))
def drop_columns(spark, d):
    return rnd(V.macro(spark, d).drop("RPI", "VIXCLS", "CLAIMSx"), 4)


@query("f11_first_non_null", S(f"SELECT date, ticker, {r('coalesce(momentum_score, future_ret_5B)', 'x')} FROM scores", "scores"))
def first_non_null(spark, d):
    return rnd(V.scores(spark, d).select("date", "ticker", F.coalesce("momentum_score", "future_ret_5B").alias("x")))


# cross-sectional basics ----------------------------------------------------
@query(
    "a07_quantiles_per_date",
    S(
        f"""SELECT date, {r('quantile_cont(close, 0.005::DOUBLE)', 'q005', 8)}, {r('quantile_cont(close, 0.5::DOUBLE)', 'q500', 8)},
        {r('quantile_cont(close, 0.995::DOUBLE)', 'q995', 8)} FROM prices GROUP BY date""",
        "prices",
    ),
)
def quantiles_per_date(spark, d):
    q = quantiles(V.prices(spark, d), ["close"], [0.005, 0.5, 0.995])
    return rnd(q.select("date", *[F.col("q_close")[i].alias(n) for i, n in enumerate(("q005", "q500", "q995"))]), 8)


@query(
    "x01_winsorize",
    S(
        "SELECT date, ticker, "
        + ", ".join(
            r(
                f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, quantile_cont({c}, 0.05::DOUBLE) OVER (PARTITION BY date)),"
                f" quantile_cont({c}, 0.95::DOUBLE) OVER (PARTITION BY date)) END",
                c,
            )
            for c in ("momentum_score", "future_ret_5B")
        )
        + " FROM scores",
        "scores",
    ),
)
def winsorized(spark, d):
    rows = V.scores(spark, d).select("date", "ticker", "momentum_score", "future_ret_5B")
    return rnd(winsorize(rows, ["momentum_score", "future_ret_5B"], alpha=0.1))


def _clip_sql(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, quantile_cont({c}, 0.005::DOUBLE) OVER (PARTITION BY date)),"
        f" quantile_cont({c}, 0.995::DOUBLE) OVER (PARTITION BY date)) END AS {c}"
    )


def z_sql(c: str, part: str = "PARTITION BY date") -> str:
    return f"coalesce(({c} - avg({c}) OVER ({part})) / nullif(stddev_samp({c}) OVER ({part}), 0), 0)"


_XS = ("momentum_score", "calm_score", "size_score")


@query(
    "x02_standardize",
    S(
        f"""SELECT date, ticker, {", ".join(r(z_sql(c), c) for c in _XS)}, {r('future_ret_5B')}, {r(z_sql('future_ret_5B'), 'future_ret_5B_std')}
        FROM (SELECT date, ticker, {", ".join(_clip_sql(c) for c in (*_XS, 'future_ret_5B'))} FROM scores) c""",
        "scores",
    ),
)
def standardized(spark, d):
    return rnd(standardize(V.scores(spark, d), targets=["future_ret_5B"]))


@query(
    "x03_select_features",
    S(f"SELECT date, ticker, {r('momentum_score')}, {r('calm_score')} FROM scores", "scores"),
)
def select_features(spark, d):
    from panelwright.operators.crosssec import feature_columns

    rows = V.scores(spark, d).withColumn("close_std", F.lit(0.0))
    chosen = feature_columns(rows, targets=["future_ret_5B"], exclude=["size_score"], suffixes=["_std"])
    return rnd(rows.select("date", "ticker", *chosen))


@query("x04_qcut_per_date", S(f"SELECT date, ticker, {qcut_sql('volume')} AS volume_qt FROM prices", "prices"))
def qcut_per_date(spark, d):
    return qcut(V.prices(spark, d).select("date", "ticker", "volume"), "volume", 5, ["date"]).drop("volume")


@query("x04_qcut_global", S(f"SELECT date, ticker, {qcut_sql('volume', None, 5, 1)} AS volume_qt FROM prices", "prices"))
def qcut_global(spark, d):
    return qcut(V.prices(spark, d).select("date", "ticker", "volume"), "volume", 5, (), 1).drop("volume")


# set operations ------------------------------------------------------------
@query("union_all", S("SELECT date, ticker, 'F' AS src, CAST(NULL AS DOUBLE) AS extra FROM prices UNION ALL SELECT date, ticker, 'M', round(volume, 4) + 0 FROM months", "prices", "months"))
def union_all(spark, d):
    a = V.prices(spark, d).select("date", "ticker", F.lit("F").alias("src"))
    b = V.months(spark, d).select("date", "ticker", F.lit("M").alias("src"), F.col("volume").alias("extra"))
    return rnd(a.unionByName(b, allowMissingColumns=True), 4)


@query("union_distinct", "SELECT l_suppkey AS ticker, l_returnflag AS flag FROM lineitem WHERE l_linestatus = 'F' UNION SELECT l_suppkey, l_returnflag FROM lineitem WHERE l_discount > 0.05")
def union_distinct(spark, d):
    rows = V.table(spark, d, "lineitem")
    a, b = rows.where("l_linestatus = 'F'"), rows.where("l_discount > 0.05")
    cols = [F.col("l_suppkey").alias("ticker"), F.col("l_returnflag").alias("flag")]
    return a.select(*cols).union(b.select(*cols)).distinct()


@query("intersection", "SELECT CAST(l_shipdate AS DATE) AS date FROM lineitem INTERSECT SELECT CAST(o_orderdate AS DATE) FROM orders")
def intersection(spark, d):
    a = V.table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    return a.intersect(V.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date")))


@query("set_difference", "SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem WHERE CAST(l_shipdate AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)")
def set_difference(spark, d):
    a = V.table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
    return a.join(V.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date")).distinct(), "date", "left_anti")


@query("drop_duplicates", "SELECT DISTINCT l_suppkey, l_partkey, l_returnflag FROM lineitem")
def drop_duplicates(spark, d):
    return V.table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_returnflag").distinct()


@query("o01_sort_by_keys", S(f"SELECT date, ticker, {rs('close')} FROM months ORDER BY ticker, date", "months"))
def sort_by_keys(spark, d):
    return rnd(V.months(spark, d).select("date", "ticker", "close")).orderBy("ticker", "date")


# scalar functions ----------------------------------------------------------
@query(
    "fn_scalar_functions",
    S(
        f"""SELECT date, ticker, {r('ln(close)', 'log_close')}, {r('abs(open - close)', 'gap')}, {r('sqrt(volume)', 'root')},
        round_even(close * 10.0::DOUBLE, 0) / 10.0::DOUBLE + 0 AS rounded, CAST(sign(close - open) AS INTEGER) AS direction,
        round(least(greatest(close, 500.0), 2000.0), 6) + 0 AS clipped, open BETWEEN 500 AND 1500 AS inside,
        upper(replace('px_' || ticker, 'px', 'SPY')) AS label, strftime(date, '%Y-%m') AS ym, CAST(quarter(date) AS INTEGER) AS qtr,
        CAST(year(date) AS INTEGER) AS yr, CAST(last_day(date) AS DATE) AS month_end, CAST(date + 30 AS DATE) AS later
        FROM months""",
        "months",
    ),
)
def scalar_functions(spark, d):
    rows = V.months(spark, d)
    out = rows.select(
        "date", "ticker", F.ln("close").alias("log_close"), F.abs(F.col("open") - F.col("close")).alias("gap"), F.sqrt("volume").alias("root"),
        C.half_even("close", 1).alias("rounded"), F.signum(F.col("close") - F.col("open")).cast("int").alias("direction"),
        C.clip("close", F.lit(500.0), F.lit(2000.0)).alias("clipped"), F.col("open").between(500, 1500).alias("inside"),
        F.upper(F.replace(F.concat(F.lit("px_"), F.col("ticker").cast("string")), F.lit("px"), F.lit("SPY"))).alias("label"),
        F.date_format("date", "yyyy-MM").alias("ym"), F.quarter("date").alias("qtr"), F.year("date").alias("yr"),
        F.last_day("date").alias("month_end"), F.date_add("date", 30).alias("later"),
    )
    return rnd(out)


@query(
    "fn_array_map_json",
    S(
        """SELECT ticker, CAST(sum(round(close * volume)) AS BIGINT) AS dot, round(arg_max(close, date), 2) + 0 AS last_close,
        '{"ticker":' || ticker || ',"n":' || count(*) || '}' AS json FROM months GROUP BY ticker""",
        "months",
    ),
)
def array_map_json(spark, d):
    month = F.struct("date", F.struct("close", "volume").alias("bar"))
    grouped = V.months(spark, d).groupBy("ticker").agg(F.collect_list(month).alias("months"), F.count(F.lit(1)).alias("n"))  # one per month
    bars = F.map_from_entries("months")
    products = F.transform(F.map_values(bars), lambda b: F.round(b["close"] * b["volume"]).cast("long"))
    text = F.to_json(F.struct("ticker", "n"))
    back = F.from_json(text, "ticker bigint, n bigint")
    return rnd(
        grouped.select(
            "ticker",
            F.aggregate(products, F.lit(0).cast("long"), lambda a, x: a + x).alias("dot"),
            F.element_at(bars, F.array_max(F.map_keys(bars)))["close"].alias("last_close"),
            F.to_json(back).alias("json"),
        ),
        2,
    )


__all__ = ["Window", "z_sql"]
