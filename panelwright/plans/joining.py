"""Queries: joins, calendar, aggregates, sources, sinks, streams, lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from panelwright.functions import columns as C
from panelwright.operators import calendar as CAL
from panelwright.operators import indicators as T
from panelwright.operators import joins as J
from panelwright.operators import lookups as L
from panelwright.operators import picks as K
from panelwright.operators.crosssec import attach_macro, demean, group_means
from panelwright.operators.sizes import pieces
from panelwright.plans import views as V
from panelwright.plans.registry import query, r, rnd, rs
from panelwright.plans.technical import own_rows_sql
from panelwright.plans.views import over, roll
from panelwright.plans.views import with_views as S
from panelwright.session import scratch
from panelwright.sources import buckets as B
from panelwright.sources import readers as R
from panelwright.sources import writers as O
from panelwright.streaming import streams as ST

W = "WINDOW w AS (PARTITION BY ticker ORDER BY date)"
_EXT = "(TIMESTAMP '1970-01-01')"

# joins ---------------------------------------------------------------------
_WILLR = f"""LEFT JOIN (SELECT date, ticker, w5, {roll('avg', 'w5', 3)} AS m5 FROM
        (SELECT date, ticker, CASE WHEN hh = ll THEN 0.0 ELSE (hh - close) / (hh - ll) * -100 END AS w5 FROM
          (SELECT date, ticker, close, {roll('max', 'high', 5)} AS hh, {roll('min', 'low', 5)} AS ll FROM prep3) a
          WHERE hh IS NOT NULL AND ll IS NOT NULL AND close IS NOT NULL) b) y USING (date, ticker)"""


@query("j01_merge_feature_tables", S(own_rows_sql(f", {r('y.w5', 'WILLR_5')}, {r('y.m5', 'WILLR_5_MA_3')}", _WILLR), "prices", "prep3"))
def merge_feature_tables(spark, d):
    # the tables on own rows are one pass over the bars, and go along to the one on the grid
    own = [("volatility", {"lookbacks": [n]}) for n in (63, 21, 126)] + [("ppo", {"fast": a, "slow": b}) for a, b in ((12, 26), (3, 14), (21, 126))]
    own += [("past_returns", {"lags": [n]}) for n in (1, 2, 5, 10, 21, 63, 126, 252)]
    merged = reduce(lambda rows, one: T.OWN_ROWS[one[0]](rows, **one[1]), [("overnight_return", {}), *own], V.prices(spark, d))
    return rnd(T.with_willr(merged, 5))


_MERGED = [("volatility", {"lookbacks": [n]}) for n in (63, 21, 126)] + [("ppo", {"fast": a, "slow": b}) for a, b in ((12, 26), (3, 14), (21, 126))]
_MERGED += [("past_returns", {"lags": [n]}) for n in (1, 2, 5, 10, 21, 63, 126, 252)] + [("overnight_return", {}), ("willr", {"n": 5})]


def bucketed_features(spark, d, buckets=None):
    """Bars and sixteen feature tables of them, each stored in the same buckets by security; names in the catalog.

    Buckets are as many as the ticks ask for, so that none outgrows a task; a number given holds.
    """
    base = scratch(spark, "features")
    lie = pieces(V.ticks(spark, d))  # the partitions by security that bars come in
    buckets = buckets or lie
    bars = B.write_bucketed(V.prices(spark, d), "bars", base, buckets, aligned=buckets == lie)
    made = [T.indicators(spark.table(bars), [one]) for one in _MERGED]
    return [B.write_bucketed(df, f"feature_{i}", base, buckets, aligned=True) for i, df in enumerate(made)]


@query("j01_merge_bucketed", S(own_rows_sql(f", {r('y.w5', 'WILLR_5')}, {r('y.m5', 'WILLR_5_MA_3')}", _WILLR), "prices", "prep3"))
def merge_bucketed(spark, d):
    """The same sixteen tables, each loaded by itself into bucketed storage and merged from there."""
    names = bucketed_features(spark, d)
    return rnd(B.merge_bucketed(spark, [names[14], *names[:14], names[15]]))


@query("j02_inner_dimension_map", S(f"SELECT date, p.ticker, m.ticker AS name, {r('close')} FROM prices p JOIN master m ON m.dcm_security_id = p.ticker", "prices", "master"))
def inner_dimension_map(spark, d):
    side = V.master(spark, d).withColumnRenamed("ticker", "name")
    rows = V.prices(spark, d).select("date", "ticker", "close")
    return rnd(J.lookup(rows, side, ("ticker", "dcm_security_id"), "inner", ["name"]))


@query(
    "j03_left_dimension_default",
    S("SELECT date, p.ticker, coalesce(Sector, 'n/a') AS Sector FROM prices p LEFT JOIN master m ON m.dcm_security_id = p.ticker", "prices", "master"),
)
def left_dimension_default(spark, d):
    rows = V.prices(spark, d).select("date", "ticker")
    return J.lookup(rows, V.master(spark, d), ("ticker", "dcm_security_id"), "left", ["Sector"], "n/a")


@query("j05_macro_to_panel", S(f"SELECT m.date, ticker, {r('m.close', 'close')}, {r('RPI', 'RPI', 4)}, {r('GS10', 'GS10', 4)} FROM months m LEFT JOIN macro x ON x.date = m.date", "months", "macro"))
def macro_to_panel(spark, d):
    rows = attach_macro(V.months(spark, d).select("date", "ticker", "close"), V.macro(spark, d).select("date", "RPI", "GS10"))
    return rnd(rows, 4, close=6)


_ASOF_F = "f AS (SELECT dcm_security_id AS ticker, filing_date AS date, max(fq) AS fq, sum(assets) AS assets FROM filings GROUP BY 1, 2)"


def _filed(spark, d):
    """One row per security and filing day: the forms filed on a day count together."""
    keys = [F.col("dcm_security_id").alias("ticker"), F.col("filing_date").alias("date")]
    return V.filings(spark, d).groupBy(*keys).agg(F.max("fq").alias("fq"), F.sum("assets").alias("assets"))


@query(
    "j08_asof_backward",
    S(f"SELECT p.date, p.ticker, f.fq, {r('f.assets', 'assets', 2)} FROM prices p ASOF LEFT JOIN f ON p.ticker = f.ticker AND p.date >= f.date", "prices", "filings", extra=_ASOF_F),
)
def asof_backward(spark, d):
    return rnd(J.asof_join(V.prices(spark, d).select("date", "ticker"), _filed(spark, d), "date", ["ticker"]), 2)


@query(
    "j08_asof_tolerance",
    S(
        f"""SELECT p.date, p.ticker, CASE WHEN p.date - f.date <= 45 THEN f.fq END AS fq FROM prices p ASOF LEFT JOIN f ON p.ticker = f.ticker AND p.date >= f.date""",
        "prices", "filings", extra=_ASOF_F,
    ),
)
def asof_tolerance(spark, d):
    right = _filed(spark, d).select("ticker", "date", "fq")
    return J.asof_join(V.prices(spark, d).select("date", "ticker"), right, "date", ["ticker"], tolerance=45)


@query(
    "j08_asof_events",
    """SELECT l.event_id, l.user_id, r.event_id AS seen_id FROM (SELECT * FROM events WHERE event_type = 'purchase') l
    ASOF LEFT JOIN (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click') r ON l.user_id = r.user_id AND l.ts >= r.ts""",
)
def asof_events(spark, d):
    rows = V.table(spark, d, "events")
    left = rows.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = rows.where("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("seen_id"))
    # a busy user is cut into days, each starting from the last click of the days before
    return J.asof_join(left, right, "ts", ["user_id"], piece=F.to_date("ts")).select("event_id", "user_id", "seen_id")


@query("j10_semi_join_on_filter", S("SELECT date, ticker, round(close, 6) + 0 AS close FROM prices WHERE date > DATE '2000-01-01' AND ticker IN (SELECT ticker FROM prices WHERE volume > 90)", "prices"))
def semi_join_on_filter(spark, d):
    rows = V.prices(spark, d)
    late = rows.where(F.col("date") > F.lit("2000-01-01").cast("date")).select("date", "ticker", "close")
    return rnd(J.restrict_to(late, rows.where("volume > 90"), "ticker"))


@query(
    "j12_returns_keep_grid",
    S(f"SELECT s.date, s.ticker, {r('future_ret_5B')}, {r('m.close', 'close')} FROM scores s LEFT JOIN months m ON m.date = s.date AND m.ticker = s.ticker", "scores"),
)
def returns_keep_grid(spark, d):
    returns = V.scores(spark, d).select("date", "ticker", "future_ret_5B")
    return rnd(J.attach_returns(returns, V.months(spark, d).select("date", "ticker", "close")))


@query(
    "j13_common_keys",
    S(
        """SELECT date, ticker, round(volume, 4) + 0 AS volume FROM months WHERE date IN (SELECT date FROM macro INTERSECT SELECT date FROM membership)
        AND ticker IN (SELECT ticker FROM months INTERSECT SELECT dcm_security_id FROM membership WHERE "wt-r1g" > 0)""",
        "months", "macro", "membership",
    ),
)
def common_keys(spark, d):
    growth = V.membership(spark, d)
    named = growth.where(F.col("wt-r1g") > 0).select("date", F.col("dcm_security_id").alias("ticker"))
    panel, _, _, _ = J.common_keys(
        [V.months(spark, d).select("date", "ticker", "volume"), V.macro(spark, d), growth.select("date"), named]
    )
    return rnd(panel, 4)


_DAILY_RET = "ret AS (SELECT date, ticker, coalesce(close / lag(close) OVER w - 1, 0) AS ret FROM prices WINDOW w AS (PARTITION BY ticker ORDER BY date))"
_PORT = """port AS (SELECT r.date, sum(r.ret * coalesce(m."wt-r1", 0)) AS portfolio_ret FROM ret r
  LEFT JOIN membership m ON m.date = CAST(date_trunc('month', r.date) AS DATE) AND m.dcm_security_id = r.ticker GROUP BY r.date)"""


def _daily_returns(spark, d):
    return V.prices(spark, d).select("date", "ticker", F.coalesce(C.ratio("close", C.lag_n("close", 1)) - 1, F.lit(0.0)).alias("ret"))


def _weights(spark, d):
    return V.membership(spark, d).select("date", F.col("dcm_security_id").alias("ticker"), F.col("wt-r1").alias("weight"))


@query("j14_effective_weights", S(f"SELECT date, {r('portfolio_ret')} FROM port", "prices", "membership", extra=_DAILY_RET + ",\n" + _PORT))
def effective_weights(spark, d):
    return rnd(J.portfolio_returns(_daily_returns(spark, d), _weights(spark, d)))


@query(
    "j15_paths_after_strikes",
    S(
        f"""SELECT ticker, date AS strike, CAST(step AS INTEGER) AS step, {r('ahead[step + 1]', 'ret')} FROM
        (SELECT ticker, date, ahead, unnest(range(30)) AS step FROM own WHERE volume > 90)""",
        "prices",
        extra="""own AS (SELECT date, ticker, volume, list(ret) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 30 FOLLOWING) AS ahead FROM
  (SELECT date, ticker, volume, coalesce(close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1, 0) AS ret FROM prices))""",
    ),
)
def paths_after_strikes(spark, d):
    rows = _daily_returns(spark, d).withColumnRenamed("ret", "ret_1B")
    return rnd(J.paths_after(rows, V.prices(spark, d).where("volume > 90"), 30))


@query("j16_sector_cohort", S("SELECT date, ticker, round(close, 6) + 0 AS close FROM months WHERE ticker IN (SELECT dcm_security_id FROM master WHERE Sector IN (SELECT Sector FROM master WHERE dcm_security_id = 1))", "months", "master"))
def sector_cohort(spark, d):
    return rnd(L.sector_cohort(V.months(spark, d).select("date", "ticker", "close"), V.master(spark, d), 1))


@query(
    "j17_peer_means",
    S(
        f"""SELECT dcm_security_id, Sector, {r('(sum(balance) OVER p - balance) / nullif(count(balance) OVER p - 1, 0)', 'peer_balance')}, CAST(count(balance) OVER p - 1 AS BIGINT) AS n_peers
        FROM master WINDOW p AS (PARTITION BY Sector)""",
        "master",
    ),
)
def peer_means(spark, d):
    return rnd(L.peer_means(V.master(spark, d).select("dcm_security_id", "Sector", "balance"), "Sector", ["balance"]).drop("balance"))


@query("j18_map_with_fallback", S("SELECT date, coalesce(m.ticker, CAST(x.ticker AS VARCHAR)) AS ticker FROM months x LEFT JOIN master m ON m.dcm_security_id = x.ticker", "months", "master"))
def map_with_fallback(spark, d):
    rows = V.months(spark, d).select("date", "ticker")
    return J.replace_by(rows, "ticker", V.master(spark, d), "dcm_security_id", "ticker")


@query(
    "j19_fallback_table",
    S(
        """SELECT date, dcm_security_id AS ticker, 'growth' AS src FROM membership WHERE "wt-r1g" > 0 UNION ALL
        SELECT date, dcm_security_id, 'value' FROM membership WHERE "wt-r1v" > 0 AND dcm_security_id NOT IN (SELECT dcm_security_id FROM membership WHERE "wt-r1g" > 0)""",
        "membership",
    ),
)
def fallback_table(spark, d):
    rows = V.membership(spark, d)
    named = [F.col("date"), F.col("dcm_security_id").alias("ticker")]
    growth = rows.where(F.col("wt-r1g") > 0).select(*named, F.lit("growth").alias("src"))
    value = rows.where(F.col("wt-r1v") > 0).select(*named, F.lit("value").alias("src"))
    return J.with_fallback(growth, value, "ticker")


_MODEL_DAYS = ["1996-01-01", "1998-06-01", "2000-03-01"]


@query(
    "j20_model_segments",
    S(
        f"""SELECT date, ticker, model_date, {r('score')} FROM (SELECT date, ticker, m.model_date, momentum_score * m.k AS score FROM scores CROSS JOIN
        (VALUES (DATE '1996-01-01', 1.0::DOUBLE), (DATE '1998-06-01', 2.0::DOUBLE), (DATE '2000-03-01', 3.0::DOUBLE)) m(model_date, k)) p
        WHERE model_date = CASE WHEN date >= DATE '2000-03-01' THEN DATE '2000-03-01' WHEN date >= DATE '1998-06-01' THEN DATE '1998-06-01' ELSE DATE '1996-01-01' END""",
        "scores",
    ),
)
def model_segments(spark, d):
    models = spark.createDataFrame([(x, float(i + 1)) for i, x in enumerate(_MODEL_DAYS)], "model_date string, k double").withColumn("model_date", F.col("model_date").cast("date"))
    placed = J.in_force(V.scores(spark, d).select("date", "ticker", "momentum_score"), models)
    return rnd(placed.select("date", "ticker", "model_date", (F.col("momentum_score") * F.col("k")).alias("score")))


# calendar ------------------------------------------------------------------
_CAL = (
    "cal AS (SELECT date, is_open, CAST(sum(CASE WHEN is_open THEN 1 ELSE 0 END) OVER (ORDER BY date) AS INTEGER) AS seq FROM "
    "(SELECT CAST(x AS DATE) AS date, NOT " + CAL.closed_rule("CAST(x AS DATE)", "isodow(x)")
    + " AS is_open FROM generate_series(TIMESTAMP '1990-01-01', TIMESTAMP '2050-12-31', INTERVAL 1 DAY) g(x)) c), "
    "days AS (SELECT DISTINCT date FROM prices)"
)


@query("c01_exchange_holidays", S("SELECT days.date, is_open, seq FROM days JOIN cal ON cal.date = days.date", "prices", extra=_CAL))
def exchange_holidays(spark, d):
    days = V.ticks(spark, d).select("date").distinct()
    return days.join(F.broadcast(CAL.calendar(spark)), "date")


@query("c02_trading_days", S("SELECT p.date, CAST(count(*) AS BIGINT) AS n FROM prices p JOIN cal ON cal.date = p.date AND is_open GROUP BY p.date", "prices", extra=_CAL))
def trading_days(spark, d):
    rows = V.prices(spark, d)
    return CAL.on_days(rows, CAL.trading_days(CAL.calendar(spark)).select("date")).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


def _offset_sql(k: int) -> str:
    step = 0 if k > 0 else 1
    return f"(SELECT o.date FROM cal o WHERE o.is_open AND o.seq = c.seq + {k} + CASE WHEN c.is_open THEN 0 ELSE {step} END)"


@query(
    "c03_offset_days",
    S(f"SELECT c.date, {_offset_sql(1)} AS plus_1, {_offset_sql(0)} AS plus_0, {_offset_sql(-1)} AS minus_1, {_offset_sql(5)} AS plus_5 FROM cal c JOIN days ON days.date = c.date", "prices", extra=_CAL),
)
def offset_days(spark, d):
    cal = CAL.calendar(spark)
    out = V.ticks(spark, d).select("date").distinct()
    for k, name in ((1, "plus_1"), (0, "plus_0"), (-1, "minus_1"), (5, "plus_5")):
        out = CAL.offset_days(out, "date", cal, k, name)
    return out


@query(
    "c04_day_facts",
    S(
        f"""SELECT c.date, c.is_open, {_offset_sql(-1)} AS previous_day, {_offset_sql(0)} AS open_or_next,
        CASE WHEN c.is_open THEN c.date ELSE {_offset_sql(-1)} END AS open_or_previous FROM cal c JOIN days ON days.date = c.date""",
        "prices", extra=_CAL,
    ),
)
def day_facts(spark, d):
    return CAL.day_facts(V.ticks(spark, d).select("date").distinct(), "date", CAL.calendar(spark))


_RANGE = "date BETWEEN (SELECT min(date) FROM prices) AND (SELECT max(date) FROM prices)"


@query(
    "c05_month_end_sample",
    S(f"SELECT date, ticker, {rs('close')} FROM prices WHERE date IN (SELECT max(date) FROM cal WHERE is_open AND {_RANGE} GROUP BY date_trunc('month', date))", "prices", extra=_CAL),
)
def month_end_sample(spark, d):
    return rnd(CAL.sample_panel(V.prices(spark, d).select("date", "ticker", "close"), CAL.calendar(spark), "bme"))


@query(
    "c05_month_start_sample",
    S(f"SELECT date, ticker, {rs('close')} FROM prices WHERE date IN (SELECT min(date) FROM cal WHERE is_open AND {_RANGE} GROUP BY date_trunc('month', date))", "prices", extra=_CAL),
)
def month_start_sample(spark, d):
    return rnd(CAL.sample_panel(V.prices(spark, d).select("date", "ticker", "close"), CAL.calendar(spark), "bms"))


@query(
    "c06_weekly_sample",
    S(
        f"SELECT date, ticker, {rs('close')} FROM prices WHERE date IN (SELECT (SELECT min(o.date) FROM cal o WHERE o.is_open AND o.date >= c.date) FROM cal c WHERE isodow(c.date) = 1 AND {_RANGE.replace('date BETWEEN', 'c.date BETWEEN')})",
        "prices", extra=_CAL,
    ),
)
def weekly_sample(spark, d):
    return rnd(CAL.sample_panel(V.prices(spark, d).select("date", "ticker", "close"), CAL.calendar(spark), "w-mon"))


@query(
    "c07_quarter_end_sample",
    S(
        f"""SELECT date, ticker, {rs('close')} FROM prices WHERE date IN (SELECT (SELECT min(o.date) FROM cal o WHERE o.is_open AND o.date >= q.date) FROM
        (SELECT max(date) AS date FROM cal WHERE isodow(date) < 6 GROUP BY date_trunc('quarter', date)) q WHERE {_RANGE.replace('date BETWEEN', 'q.date BETWEEN')})""",
        "prices", extra=_CAL,
    ),
)
def quarter_end_sample(spark, d):
    return rnd(CAL.sample_panel(V.prices(spark, d).select("date", "ticker", "close"), CAL.calendar(spark), "bq"))


@query("c09_shift_panel", S(f"SELECT {_offset_sql(1)} AS date, p.ticker, round(p.close, 6) + 0 AS close FROM prices p JOIN cal c ON c.date = p.date", "prices", extra=_CAL))
def shift_panel(spark, d):
    return rnd(CAL.offset_days(V.prices(spark, d).select("date", "ticker", "close"), "date", CAL.calendar(spark), 1))


@query(
    "c10_intervals",
    S(
        f"""SELECT c.date AS entry_date, {_offset_sql(1)} AS exit_date, CAST(date_trunc('quarter', c.date) AS DATE) AS quarter_date, year(c.date) || '-Q' || quarter(c.date) AS this_quarter
        FROM cal c WHERE is_open AND {_RANGE.replace('date BETWEEN', 'c.date BETWEEN')}""",
        "prices", extra=_CAL,
    ),
)
def intervals(spark, d):
    start, end = CAL.range_of(V.ticks(spark, d))
    return CAL.intervals(CAL.calendar(spark), start, end)


@query(
    "c11_month_start_after_filing",
    S(
        """SELECT dcm_security_id, fq, dimension, CAST(m + CASE isodow(m) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS DATE) AS date,
        CAST(e - CASE isodow(e) WHEN 6 THEN 1 WHEN 7 THEN 2 ELSE 0 END AS DATE) AS month_last_weekday FROM
        (SELECT *, CAST(date_trunc('month', filing_date) + INTERVAL 1 MONTH AS DATE) AS m, last_day(filing_date) AS e FROM filings) f""",
        "filings",
    ),
)
def month_start_after_filing(spark, d):
    return V.filings(spark, d).select(
        "dcm_security_id", "fq", "dimension", CAL.next_month_start("filing_date").alias("date"), CAL.month_last_weekday("filing_date").alias("month_last_weekday")
    )


# aggregates ----------------------------------------------------------------
@query(
    "a01_consolidate_bars",
    """SELECT date, CAST(id AS BIGINT) AS ticker, round(avg(close), 5) + 0 AS close, round(avg(volume), 5) + 0 AS volume FROM
    (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date, l_suppkey AS id, l_extendedprice AS close, l_quantity AS volume FROM lineitem) x GROUP BY date, id""",
)
def consolidate_bars(spark, d):
    rows = V.table(spark, d, "lineitem").select(
        F.to_date("l_shipdate").alias("date"), F.concat(F.lit("T"), F.col("l_suppkey")).alias("ticker"), F.col("l_suppkey").alias("dcm_security_id"),
        F.col("l_extendedprice").alias("close"), F.col("l_quantity").alias("volume"),
    )
    return rnd(R.consolidate_bars(rows), 5)


@query("a02_mean_of_duplicates", S(f"SELECT date, ticker, {r('avg(px)', 'px', 7)} FROM ticks GROUP BY date, ticker", "ticks"))
def mean_of_duplicates(spark, d):
    return rnd(V.ticks(spark, d).groupBy("date", "ticker").agg(F.avg("px").alias("px")), 7)


@query(
    "a03_dominant_category",
    S("SELECT dcm_security_id, dimension, CAST(n AS BIGINT) AS n FROM (SELECT dcm_security_id, dimension, count(*) AS n FROM filings GROUP BY 1, 2) c QUALIFY row_number() OVER (PARTITION BY dcm_security_id ORDER BY n DESC, dimension) = 1", "filings"),
)
def dominant_category(spark, d):
    return K.dominant(V.filings(spark, d), ["dcm_security_id"], "dimension")


@query(
    "a04_last_values",
    S(
        """SELECT dcm_security_id, fq, max(filing_date) AS filing_date, arg_max(dimension, (filing_date, dimension)) AS dimension, round(arg_max(assets, (filing_date, dimension)), 2) + 0 AS assets,
        round(arg_max(capex, (filing_date, dimension)), 2) + 0 AS capex FROM (SELECT dcm_security_id, fq, filing_date, dimension, assets, CASE WHEN dimension = 'ARQ' THEN capex END AS capex FROM filings) f GROUP BY 1, 2""".replace(
            "arg_max(capex, (filing_date, dimension))", "arg_max(CASE WHEN capex IS NOT NULL THEN capex END, CASE WHEN capex IS NOT NULL THEN (filing_date, dimension) END)"
        ).replace("END), 2) + 0 AS capex", "END), 4) + 0 AS capex"),
        "filings",
    ),
)
def last_values(spark, d):
    rows = V.filings(spark, d).select("dcm_security_id", "fq", "filing_date", "dimension", "assets", F.when(F.col("dimension") == "ARQ", F.col("capex")).alias("capex"))
    return rnd(K.last_values(rows, ["dcm_security_id", "fq"], ["filing_date", "dimension"]), 2, capex=4)


@query("a05_group_demean", S(f"SELECT date, ticker, {r('bm - avg(bm) OVER (PARTITION BY date, Sector)', 'bm_ia_sector')} FROM features JOIN (SELECT dcm_security_id, Sector FROM master) m ON dcm_security_id = ticker", "features", "master"))
def group_demean(spark, d):
    rows = J.lookup(V.features(spark, d).select("date", "ticker", "bm"), V.master(spark, d), ("ticker", "dcm_security_id"), "inner", ["Sector"])
    return rnd(demean(rows, "bm", ["date", "Sector"], "bm_ia_sector").select("date", "ticker", "bm_ia_sector"))


def _group_sql(group: str) -> str:
    return S(f"SELECT date, {group}, {r('avg(bm)', 'bm')}, {r('avg(momentum)', 'momentum')} FROM features JOIN (SELECT dcm_security_id, {group} FROM master) m ON dcm_security_id = ticker GROUP BY 1, 2", "features", "master")


@query("a06_sector_average", _group_sql("Sector"))
def sector_average(spark, d):
    return rnd(group_means(V.features(spark, d), V.master(spark, d), "Sector", ["bm", "momentum"]))


@query("a06_industry_average", _group_sql("IndustryGroup"))
def industry_average(spark, d):
    return rnd(group_means(V.features(spark, d), V.master(spark, d), "IndustryGroup", ["bm", "momentum"]))


@query("a08_distinct_values", "SELECT DISTINCT l_suppkey AS ticker FROM lineitem")
def distinct_values(spark, d):
    return V.ticks(spark, d).select("ticker").distinct()


@query("a09_global_max_min", "SELECT CAST(max(l_shipdate) AS DATE) AS last_day, CAST(min(l_shipdate) AS DATE) AS first_day FROM lineitem")
def global_max_min(spark, d):
    return V.ticks(spark, d).agg(F.max("date").alias("last_day"), F.min("date").alias("first_day"))


_SOURCES = """SELECT ticker, source, CAST(n AS BIGINT) AS n FROM (SELECT dcm_security_id AS ticker, 'growth' AS source, 0 AS i, count(*) AS n FROM membership WHERE "wt-r1g" > 0 GROUP BY 1
  UNION ALL SELECT dcm_security_id, 'value', 1, count(*) FROM membership WHERE "wt-r1v" > 0 GROUP BY 1) c QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY n DESC, i) = 1"""


def _sources(spark, d):
    rows = V.membership(spark, d).withColumnRenamed("dcm_security_id", "ticker")
    return {"growth": rows.where(F.col("wt-r1g") > 0), "value": rows.where(F.col("wt-r1v") > 0)}


@query("a10_best_source", S(_SOURCES, "membership"))
def best_source(spark, d):
    return K.best_source(_sources(spark, d))


@query("i08_source_and_sector", S(f"SELECT b.ticker AS sec_id, m.ticker, source AS model_type, Sector AS sector FROM ({_SOURCES}) b JOIN master m ON m.dcm_security_id = b.ticker", "membership", "master"))
def source_and_sector(spark, d):
    best = K.best_source(_sources(spark, d)).withColumnRenamed("ticker", "sec_id")
    return J.lookup(best, V.master(spark, d), ("sec_id", "dcm_security_id"), "inner", ["ticker", "Sector"]).select(
        "sec_id", "ticker", F.col("source").alias("model_type"), F.col("Sector").alias("sector")
    )


@query("a12_sum_and_mean_by_date", S(f"SELECT date, {r('sum(volume)', 'sum_volume', 4)}, {r('avg(close)', 'mean_close', 8)} FROM months GROUP BY date", "months"))
def sum_and_mean_by_date(spark, d):
    return rnd(V.months(spark, d).groupBy("date").agg(F.sum("volume").alias("sum_volume"), F.avg("close").alias("mean_close")), 4, mean_close=8)


@query("a13_conditional_mean", S(f"SELECT date, {r('avg(CASE WHEN future_ret_5B > 0 THEN 1.0 ELSE 0.0 END)', 'up_share')} FROM scores GROUP BY date", "scores"))
def conditional_mean(spark, d):
    return rnd(V.scores(spark, d).groupBy("date").agg(F.avg(F.when(F.col("future_ret_5B") > 0, 1.0).otherwise(0.0)).alias("up_share")))


@query("a14_quarter_resample", S(f"SELECT CAST(date_trunc('quarter', date) AS DATE) AS quarter, ticker, {r('sum(volume)', 'volume', 4)}, {r('max(high)', 'high')} FROM prices GROUP BY 1, 2", "prices"))
def quarter_resample(spark, d):
    rows = V.prices(spark, d).groupBy(F.to_date(F.date_trunc("quarter", "date")).alias("quarter"), "ticker")
    return rnd(rows.agg(F.sum("volume").alias("volume"), F.max("high").alias("high")), 6, volume=4)


@query("a15_month_first_last_day", S("SELECT CAST(date_trunc('month', date) AS DATE) AS month, min(date) AS first_day, max(date) AS last_day FROM cal JOIN days USING (date) WHERE is_open GROUP BY 1", "prices", extra=_CAL))
def month_first_last_day(spark, d):
    days = CAL.on_days(V.ticks(spark, d).select("date").distinct(), CAL.trading_days(CAL.calendar(spark)).select("date"))
    return days.groupBy(F.trunc("date", "month").alias("month")).agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"))


@query("a17_mean_nulls_to_zero", S(f"SELECT date, ticker, {r('coalesce(avg(CASE WHEN vol > 25 THEN px END), 0)', 'px', 7)} FROM ticks GROUP BY 1, 2", "ticks"))
def mean_nulls_to_zero(spark, d):
    return rnd(V.ticks(spark, d).groupBy("date", "ticker").agg(F.avg(F.when(F.col("vol") > 25, F.col("px"))).alias("px")).fillna(0.0), 7)


@query("a18_benchmark_average", S(f"SELECT date, {r('avg(ret)', 'benchmark_ret')} FROM ret WHERE ticker = 1 GROUP BY date", "prices", extra=_DAILY_RET))
def benchmark_average(spark, d):
    return rnd(_daily_returns(spark, d).where("ticker = 1").groupBy("date").agg(F.avg("ret").alias("benchmark_ret")))


# top-k and sampling --------------------------------------------------------
@query("o02_top_by_signal", S("SELECT ticker, ensemble_qt FROM predictions WHERE date = DATE '1999-06-01' AND ensemble_qt = 4 ORDER BY future_ret_5B DESC NULLS LAST, ticker LIMIT 10", "predictions"))
def top_by_signal(spark, d):
    return L.top_by_signal(V.predictions(spark, d), "1999-06-01", 4).select("ticker", "ensemble_qt")


@query(
    "o02_top_per_date_and_signal",
    S("SELECT date, ensemble_qt, ticker, CAST(row_number() OVER (PARTITION BY date, ensemble_qt ORDER BY future_ret_5B DESC NULLS LAST, ticker) AS INTEGER) AS place FROM predictions WHERE ensemble_qt IS NOT NULL QUALIFY place <= 10", "predictions"),
)
def top_per_date_and_signal(spark, d):
    rows = V.predictions(spark, d).where(F.col("ensemble_qt").isNotNull())
    top = K.top_n(rows, ["date", "ensemble_qt"], [F.desc_nulls_last("future_ret_5B"), F.col("ticker")], 10, "place")
    return top.select("date", "ensemble_qt", "ticker", "place")


@query("o05_latest_rows", S(f"SELECT date, ticker, {rs('close')} FROM months WHERE date = (SELECT max(date) FROM months)", "months"))
def latest_rows(spark, d):
    return rnd(K.latest(V.months(spark, d).select("date", "ticker", "close")))


@query(
    "o06_half_sample",
    S("SELECT dcm_security_id, Sector FROM master QUALIFY row_number() OVER (PARTITION BY Sector ORDER BY md5(dcm_security_id || '-0')) <= floor(count(*) OVER (PARTITION BY Sector) * 0.5)", "master"),
)
def half_sample(spark, d):
    return K.stable_sample(V.master(spark, d).select("dcm_security_id", "Sector"), 0.5, "dcm_security_id", ["Sector"])


# lookups -------------------------------------------------------------------
@query("q01_ids_of_tickers", S("SELECT ticker, dcm_security_id FROM master WHERE ticker IN ('Supplier#000000001', 'Supplier#000000004')", "master"))
def ids_of_tickers(spark, d):
    return L.ids_of(V.master(spark, d), ["Supplier#000000001", "Supplier#000000004"])


@query("q01_table_form", S("SELECT DISTINCT p.ticker AS dcm_security_id, m.ticker FROM prices p JOIN master m ON m.dcm_security_id = p.ticker", "prices", "master"))
def ids_table_form(spark, d):
    ids = V.ticks(spark, d).select(F.col("ticker").alias("dcm_security_id")).distinct()
    return J.lookup(ids, V.master(spark, d), "dcm_security_id", "inner", ["ticker"])


@query("q02_sector_and_name", S("SELECT DISTINCT dcm_security_id, ticker, Sector, IndustryGroup FROM master WHERE dcm_security_id IN (3)", "master"))
def sector_and_name(spark, d):
    return L.describe(V.master(spark, d), 3, ["Sector", "IndustryGroup"])


@query("q03_full_master", S("SELECT dcm_security_id, ticker, IndustryGroup, Sector FROM master", "master"))
def full_master(spark, d):
    return R.security_master(V.master(spark, d), "balance")


@query("q04_returns_of_ids", S(f"SELECT date, ticker, {rs('ret')} FROM ret WHERE ticker IN (1, 3, 7)", "prices", extra=_DAILY_RET))
def returns_of_ids(spark, d):
    return rnd(L.rows_of(_daily_returns(spark, d), [1, 3, 7]))


@query("q05_latest_signal", S("SELECT ticker, ensemble_qt FROM predictions WHERE date = (SELECT max(date) FROM predictions)", "predictions"))
def latest_signal(spark, d):
    return L.latest_signals(V.predictions(spark, d))


@query("q06_attribution_rows", S(f"SELECT date, ticker, {rs('bm', 'momentum')} FROM attribution WHERE ticker IN (2, 5) AND (date < DATE '1998-01-01' OR momentum > 0)", "attribution"))
def attribution_rows(spark, d):
    rows = V.attribution(spark, d).select("date", "ticker", "bm", "momentum")
    early = rows.where(F.col("date") < F.lit("1998-01-01").cast("date"))
    return rnd(L.attribution_of(early, rows.where("momentum > 0"), [2, 5]))


@query("q07_panel_rows", S(f"SELECT date, {rs('bm', 'momentum')} FROM features WHERE ticker = 4", "features"))
def panel_rows(spark, d):
    return rnd(L.rows_of(V.features(spark, d), 4, ["date", "bm", "momentum"]))


@query("q08_tickers_on_a_day", S("SELECT DISTINCT ticker FROM ticks WHERE date = DATE '1998-07-07'", "ticks"))
def tickers_on_a_day(spark, d):
    return L.tickers_on(V.ticks(spark, d), "1998-07-07")


# sources -------------------------------------------------------------------
@query("src01_named_table_scan", "SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal, 2) + 0 AS s_acctbal FROM supplier")
def named_table_scan(spark, d):
    folder = scratch(spark, "scan")
    O.write_tables({"supplier": V.table(spark, d, "supplier")}, folder, "csv")
    schema = "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"
    return rnd(R.read_table(spark, f"{folder}/supplier", schema, "csv"), 2)


@query("src04_append_rows", S("SELECT dcm_security_id, ticker FROM master UNION ALL SELECT * FROM (VALUES (60856, NULL), (60562, NULL)) v(dcm_security_id, ticker)", "master"))
def append_rows(spark, d):
    return R.append_rows(V.master(spark, d).select("dcm_security_id", "ticker"), [{"dcm_security_id": 60856}, {"dcm_security_id": 60562}])


@query("src05_restrict_to_master", "SELECT ps.p_partkey, ps.p_brand FROM part ps WHERE p_partkey IN (SELECT s_suppkey FROM supplier)")
def restrict_to_master(spark, d):
    return J.restrict_to(V.table(spark, d, "part").select("p_partkey", "p_brand"), V.master(spark, d), ("p_partkey", "dcm_security_id"))


@query(
    "src06_transform_catalogue",
    "SELECT o_orderpriority AS series, CAST(1 + count(*) % 7 AS INTEGER) AS transform FROM orders GROUP BY 1 UNION ALL SELECT * FROM (VALUES ('XLE_close', 5), ('XLE_volume', 5), ('SPY_close', 5), ('SPY_volume', 5)) v(series, transform)",
)
def transform_catalogue(spark, d):
    raw = V.table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("series")).agg((1 + F.count(F.lit(1)) % 7).cast("int").alias("transform"))
    return R.transform_catalogue(raw, ["XLE", "SPY"])


@query(
    "src07_index_membership",
    S(
        """SELECT DISTINCT date, cusip, "wt-r1", coalesce("wt-r1g", 0) AS "wt-r1g", coalesce("wt-r1v", 0) AS "wt-r1v", dcm_security_id, m.ticker FROM membership JOIN (SELECT dcm_security_id, ticker FROM master) m USING (dcm_security_id)""",
        "membership", "master",
    ),
)
def index_membership(spark, d):
    rows = V.membership(spark, d)
    wide = rows.select(F.col("date").alias("Date"), F.col("cusip").alias("CUSIP"), F.col("wt-r1").alias("WT-R1"), F.col("wt-r1g").alias("WT-R1G"), F.col("wt-r1v").alias("WT-R1V"))
    narrow = J.lookup(rows.select("date", "cusip", "dcm_security_id"), V.master(spark, d), "dcm_security_id", "inner", ["ticker"])
    return R.index_membership(wide, narrow, V.master(spark, d).select("dcm_security_id"))


@query(
    "src08_filings_scan",
    S(f"SELECT f.dcm_security_id, fq, f.dimension, filing_date, {r('assets', 'assets', 2)} FROM filings f JOIN master m ON f.dcm_security_id = m.dcm_security_id WHERE filing_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' AND dimension IN ('ARQ', 'ART')", "filings", "master"),
)
def filings_scan(spark, d):
    raw = V.filings(spark, d).withColumn("ticker", F.concat(F.lit("Q"), F.col("dcm_security_id"))).drop("dcm_security_id")
    side = V.master(spark, d).select("dcm_security_id", F.concat(F.lit("Q"), F.col("dcm_security_id")).alias("quandl_ticker"))
    out = R.current_filings(raw, side, "1996-01-01", "2000-12-31", filed="filing_date")
    return rnd(out.select("dcm_security_id", "fq", "dimension", "filing_date", "assets"), 2)


@query("src09_daily_price_query", S(f"SELECT date, ticker, {rs('open', 'high', 'low', 'close', 'volume')} FROM prices WHERE date > DATE '1996-01-01' AND date < DATE '1999-01-01' AND ticker IN (SELECT dcm_security_id FROM master)", "prices", "master"))
def daily_price_query(spark, d):
    known = V.master(spark, d).select(F.col("dcm_security_id").alias("ticker"))
    return rnd(R.daily_prices(V.prices(spark, d), known, "1996-01-01", "1999-01-01"))


@query("src11_current_version", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS date, round(1 - l_discount, 4) + 0 AS split_factor FROM lineitem WHERE l_linestatus = 'O' AND CAST(l_shipdate AS DATE) >= DATE '1996-01-01' AND CAST(l_shipdate AS DATE) < DATE '1998-01-01'")
def current_version(spark, d):
    rows = V.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("date"), (1 - F.col("l_discount")).alias("split_factor"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("as_of_end"),
    )
    return rnd(R.current_version(rows, "1996-01-01", "1998-01-01").drop("as_of_end"), 4)


_SYM = ["F", "O"]


@query(
    "src12_assemble_symbols",
    "SELECT CAST(l_shipdate AS DATE) AS date, "
    + ", ".join(
        f"""round(arg_max(CASE WHEN l_linestatus = '{s}' THEN l_extendedprice END, CASE WHEN l_linestatus = '{s}' THEN row(l_orderkey, l_linenumber, l_partkey, l_extendedprice) END), 2) + 0 AS "{s}_close",
        round(arg_max(CASE WHEN l_linestatus = '{s}' THEN l_quantity END, CASE WHEN l_linestatus = '{s}' THEN row(l_orderkey, l_linenumber, l_partkey, l_extendedprice) END), 2) + 0 AS "{s}_volume" """
        for s in _SYM
    )
    + " FROM lineitem GROUP BY 1",
)
def assemble_symbols(spark, d):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    rows = V.table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("date"), F.col("l_linestatus").alias("symbol"), *order, F.col("l_extendedprice").alias("close"), F.col("l_quantity").alias("volume"))
    return rnd(R.assemble_symbols(rows, _SYM, order=order), 2)


_SERIES_SQL = (
    "SELECT date, " + ", ".join(f"round(last_value({s} IGNORE NULLS) OVER (ORDER BY date), 4) + 0 AS {s}" for s in V.SERIES.values())
    + " FROM (SELECT date, " + ", ".join(f"max(CASE WHEN series = '{s}' THEN value END) AS {s}" for s in V.SERIES.values())
    + " FROM macro_daily GROUP BY date) m WHERE NOT " + CAL.closed_rule("date", "isodow(date)")
)


@query("src13_assemble_series", S(_SERIES_SQL, "macro_daily"))
def assemble_series(spark, d):
    back = {v: f"SRC_{v}" for v in V.SERIES.values()}
    pairs = F.create_map(*[F.lit(x) for kv in back.items() for x in kv])
    rows = V.macro_daily(spark, d).withColumn("series", pairs[F.col("series")])
    out = R.assemble_series(rows, list(V.SERIES.values()), {v: k for k, v in back.items()}, CAL.calendar(spark), required=["RPI", "GS10"])
    return rnd(out, 4)


@query("src20_symbol_returns", S(f"SELECT date, ticker, {r('close')}, {r('ret_1B')} FROM (SELECT date, ticker, close, close / lag(close) OVER w - 1 AS ret_1B FROM prices {W}) x WHERE ticker = 7 AND ret_1B IS NOT NULL", "prices"))
def symbol_returns(spark, d):
    return rnd(R.symbol_returns(V.prices(spark, d).select("date", "ticker", "close"), 7))


# sinks ---------------------------------------------------------------------
@query("snk01_write_named_tables", S(f"SELECT date, ticker, {rs('close', 'volume')} FROM months", "months"))
def write_named_tables(spark, d):
    folder = scratch(spark, "out")
    O.write_tables({"months": V.months(spark, d), "macro": V.macro(spark, d)}, folder)
    return rnd(R.read_table(spark, f"{folder}/months").select("date", "ticker", "close", "volume"))


@query(
    "snk03_incremental_append",
    S(f"SELECT dcm_security_id, m.ticker, date, {r('p.close', 'close')} FROM prices p JOIN (SELECT dcm_security_id, ticker FROM master) m ON m.dcm_security_id = p.ticker", "prices", "master"),
)
def incremental_append(spark, d):
    target = scratch(spark, "append")
    side = V.master(spark, d).select("ticker", "dcm_security_id")
    rows = J.lookup(V.prices(spark, d).select("date", F.col("ticker").alias("id"), "close"), side.withColumnRenamed("dcm_security_id", "id"), "id", "inner", ["ticker"]).drop("id")
    first = rows.where(F.col("date") < F.lit("1999-01-01").cast("date"))
    O.append_new(spark, first, target, side)
    O.append_new(spark, rows, target, side)  # only rows after the mark
    O.append_new(spark, rows, target, side)  # nothing is new
    return rnd(spark.read.parquet(target))


@query("snk04_full_refresh", S(f"SELECT date, ticker, {rs('close', 'volume')} FROM months", "months"))
def full_refresh(spark, d):
    target = scratch(spark, "refresh")
    rows = V.months(spark, d).select("date", "ticker", "close", "volume")
    O.overwrite_table(rows.where("volume > 60").drop("volume"), target)  # an earlier state, with other rows and columns
    O.overwrite_table(rows, target)
    return rnd(spark.read.parquet(target))


@query(
    "snk03_repeatable_append",
    S(f"SELECT dcm_security_id, m.ticker, date, {r('p.close', 'close')} FROM prices p JOIN (SELECT dcm_security_id, ticker FROM master) m ON m.dcm_security_id = p.ticker", "prices", "master"),
)
def repeatable_append(spark, d):
    """The rows in three deliveries, one of them twice and one with the mark's own day in two parts."""
    target = scratch(spark, "days")
    side = V.master(spark, d).select("ticker", "dcm_security_id")
    rows = J.lookup(V.prices(spark, d).select("date", F.col("ticker").alias("id"), "close"), side.withColumnRenamed("dcm_security_id", "id"), "id", "inner", ["ticker"]).drop("id")
    mark = F.lit("1999-01-04").cast("date")
    early = rows.where((F.col("date") < mark) | ((F.col("date") == mark) & (F.col("close") < 1000)))
    for part in (early, early, rows, rows.where(F.col("date") >= mark)):
        O.append_days(spark, part, target, side, unit="month")
    return rnd(O.read_days(spark, target))


@query("snk06_sharded_csv", "SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name FROM supplier")
def sharded_csv(spark, d):
    folder = scratch(spark, "shards")
    O.write_tables({"supplier": V.table(spark, d, "supplier").select("s_suppkey", "s_name")}, folder, "csv", shards=4)
    return R.read_table(spark, f"{folder}/supplier/*.csv", "s_suppkey BIGINT, s_name STRING", "csv")


@query("snk02_multi_table_export", "SELECT r_name AS name, 'region' AS src FROM region UNION ALL SELECT n_name, 'nation' FROM nation UNION ALL SELECT s_name, 'supplier' FROM supplier")
def multi_table_export(spark, d):
    folder = scratch(spark, "export")
    names = {"region": "r_name", "nation": "n_name", "supplier": "s_name"}
    O.write_tables({t: V.table(spark, d, t).select(F.col(c).alias("name"), F.lit(t).alias("src")) for t, c in names.items()}, folder)
    return R.read_table(spark, [f"{folder}/{t}" for t in names])


@query("snk05_bulk_csv_load", "SELECT c_custkey, c_mktsegment, round(c_acctbal, 2) + 0 AS c_acctbal FROM customer")
def bulk_csv_load(spark, d):
    folder = scratch(spark, "bulk")
    rows = V.table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    O.write_tables({"part_a": rows.where("c_custkey % 2 = 0"), "part_b": rows.where("c_custkey % 2 = 1")}, folder, "csv", shards=2)
    loaded = R.read_table(spark, f"{folder}/part_*/*.csv", "c_custkey BIGINT, c_mktsegment STRING, c_acctbal DOUBLE", "csv")
    O.overwrite_table(loaded, f"{folder}/loaded")
    return rnd(R.read_table(spark, f"{folder}/loaded"), 2)


@query("c08_sampled_panels", S(f"SELECT date, ticker, 'monthly' AS freq FROM prices WHERE date IN (SELECT max(date) FROM cal WHERE is_open AND {_RANGE} GROUP BY date_trunc('month', date)) UNION ALL SELECT date, ticker, 'weekly' FROM prices WHERE date IN (SELECT (SELECT min(o.date) FROM cal o WHERE o.is_open AND o.date >= c.date) FROM cal c WHERE isodow(c.date) = 1 AND {_RANGE.replace('date BETWEEN', 'c.date BETWEEN')})", "prices", extra=_CAL))
def sampled_panels(spark, d):
    rows, cal = V.prices(spark, d).select("date", "ticker"), CAL.calendar(spark)
    monthly = CAL.sample_panel(rows, cal, "bme").withColumn("freq", F.lit("monthly"))
    return monthly.unionByName(CAL.sample_panel(rows, cal, "w-mon").withColumn("freq", F.lit("weekly")))


@query("snk07_nested_to_text", """SELECT s_suppkey, '{"s_name":"' || s_name || '","s_nationkey":"' || s_nationkey || '"}' AS json FROM supplier""")
def nested_to_text(spark, d):
    return O.as_json(V.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), ["s_name", "s_nationkey"])


# streams -------------------------------------------------------------------
def _stream(spark, d, name):
    schema = V.table(spark, d, name).schema
    return ST.read_files(spark, f"{d}/{name}*.parquet", schema)


_EVENT_BARS = """SELECT CAST(ts AS DATE) AS date, user_id AS ticker, round(arg_min(value, row(ts, event_id)), 6) + 0 AS open, round(max(value), 6) + 0 AS high, round(min(value), 6) + 0 AS low,
  round(arg_max(value, row(ts, event_id)), 6) + 0 AS close, CAST(count(*) AS BIGINT) AS n FROM events"""


@query("s02_stream_bars", f"{_EVENT_BARS} GROUP BY 1, 2")
def stream_bars(spark, d):
    target = scratch(spark, "bars")
    bars = ST.stream_bars(_stream(spark, d, "events"), order=["event_id"])
    ST.to_versions(bars, target, scratch(spark, "bars-state")).awaitTermination()
    return rnd(ST.newest(spark, target, ["date", "ticker"]))


@query("s02_batch_bars", f"{_EVENT_BARS} GROUP BY 1, 2")
def batch_bars(spark, d):
    return rnd(ST.stream_bars(V.table(spark, d, "events"), order=["event_id"]))


@query("s03_stream_append", S("SELECT event_id, user_id AS ticker, m.dcm_security_id, round(value, 6) + 0 AS value FROM events JOIN (SELECT dcm_security_id FROM master) m ON m.dcm_security_id = user_id", "master"))
def stream_append(spark, d):
    target = scratch(spark, "loaded")
    state = scratch(spark, "loaded-state")
    rows = _stream(spark, d, "events").select("event_id", F.col("user_id").alias("ticker"), "value")
    side = V.master(spark, d).select(F.col("dcm_security_id").alias("ticker"), "dcm_security_id")
    for _ in range(2):  # the second run finds nothing new
        ST.stream_append(rows, side, target, state).awaitTermination()
    return rnd(spark.read.parquet(target).select("event_id", "ticker", "dcm_security_id", "value"))


__all__ = ["over"]
