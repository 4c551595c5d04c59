"""Panel views over the star-schema tables, each with the SQL text of the same view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.functions.columns import ratio
from panelwright.operators.order_stats import avg_ranks, qcut
from panelwright.operators.sizes import pieces
from panelwright.session import durable
from panelwright.sources.readers import read_table

SQL: dict[str, tuple[tuple[str, ...], str]] = {}


def with_views(body: str, *names: str, recursive: bool = False, extra: str = "") -> str:
    """SQL statement whose WITH clause defines the named views and those they need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in SQL[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    parts = [f"{n} AS ({SQL[n][1]})" for n in ordered]
    if extra:
        parts.append(extra)
    if not parts:
        return body
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + body


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


# ticks ---------------------------------------------------------------------
SQL["ticks"] = (
    (),
    """SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS ticker,
       floor(l_extendedprice / l_quantity * 10000) / 10000 AS px, l_quantity AS vol,
       row(l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_discount) AS okey
FROM lineitem""",
)


def ticks(spark: SparkSession, d: str) -> DataFrame:
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount")
    return table(spark, d, "lineitem").select(
        F.to_date("l_shipdate").alias("date"),
        F.col("l_suppkey").alias("ticker"),
        (F.floor(ratio("l_extendedprice", "l_quantity") * 10000) / 10000).alias("px"),
        F.col("l_quantity").alias("vol"),
        order.alias("okey"),
    )


# prices --------------------------------------------------------------------
SQL["prices"] = (
    ("ticks",),
    """SELECT date, ticker, arg_min(px, okey) AS open, max(px) AS high, min(px) AS low,
       arg_max(px, okey) AS close, sum(vol) AS volume
FROM ticks GROUP BY date, ticker""",
)


def bars(tick_rows: DataFrame, *keys: str) -> DataFrame:
    """Open, high, low, close and volume per key; ticks are combined before the exchange, if they need one."""
    return tick_rows.groupBy(*keys).agg(
        F.min_by("px", "okey").alias("open"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        F.max_by("px", "okey").alias("close"),
        F.sum("vol").alias("volume"),
    )


def prices(spark: SparkSession, d: str) -> DataFrame:
    """Daily bars; ticks move once, to their security, and in its order serve the windows over it as they are.

    A security trades about once a day it trades at all, so combining its ticks of a day
    beforehand saves no rows, and sorts them twice more.
    """
    rows = ticks(spark, d)
    return bars(rows.repartition(pieces(rows), "ticker"), "ticker", "date").select("date", "ticker", "open", "high", "low", "close", "volume")


# months --------------------------------------------------------------------
SQL["months"] = (
    ("prices",),
    """SELECT CAST(date_trunc('month', date) AS DATE) AS date, ticker, arg_min(open, date) AS open,
       max(high) AS high, min(low) AS low, arg_max(close, date) AS close, sum(volume) AS volume
FROM prices GROUP BY 1, 2""",
)


def months(spark: SparkSession, d: str) -> DataFrame:
    """Monthly bars keyed by the first day of the month."""
    daily = prices(spark, d).withColumn("day", F.col("date")).withColumn("date", F.trunc("date", "month"))
    return daily.groupBy("date", "ticker").agg(
        F.min_by("open", "day").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "day").alias("close"),
        F.sum("volume").alias("volume"),
    )


# master --------------------------------------------------------------------
SQL["master"] = (
    (),
    """SELECT s_suppkey AS dcm_security_id, s_name AS ticker, n_name AS IndustryGroup, r_name AS Sector,
       s_acctbal AS balance
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)


def master(spark: SparkSession, d: str) -> DataFrame:
    s, n, g = (table(spark, d, t) for t in ("supplier", "nation", "region"))
    return (
        s.join(n, s.s_nationkey == n.n_nationkey)
        .join(g, n.n_regionkey == g.r_regionkey)
        .select(
            F.col("s_suppkey").alias("dcm_security_id"),
            F.col("s_name").alias("ticker"),
            F.col("n_name").alias("IndustryGroup"),
            F.col("r_name").alias("Sector"),
            F.col("s_acctbal").alias("balance"),
        )
    )


# filings -------------------------------------------------------------------
SQL["filings"] = (
    (),
    """SELECT dcm_security_id, fq, CAST(fq + INTERVAL 3 MONTH AS DATE) - 1 + 30 + CAST(dcm_security_id % 45 AS INTEGER) AS filing_date,
       dimension, assets, revenue, capex, inventory, shareswa
FROM (SELECT l_suppkey AS dcm_security_id, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS fq,
             CASE WHEN l_linestatus = 'F' THEN 'ARQ' ELSE 'ART' END AS dimension,
             round(sum(l_extendedprice), 2) AS assets, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue,
             round(sum(l_extendedprice * l_tax), 4) AS capex, sum(l_quantity) AS inventory,
             CAST(count(*) AS DOUBLE) AS shareswa
      FROM lineitem GROUP BY 1, 2, 3) q""",
)


def filings(spark: SparkSession, d: str) -> DataFrame:
    """Quarterly filings per security and dimension, with a filing day after quarter end."""
    grouped = (
        table(spark, d, "lineitem")
        .groupBy(
            F.col("l_suppkey").alias("dcm_security_id"),
            F.to_date(F.date_trunc("quarter", "l_shipdate")).alias("fq"),
            F.when(F.col("l_linestatus") == "F", "ARQ").otherwise("ART").alias("dimension"),
        )
        .agg(
            F.round(F.sum("l_extendedprice"), 2).alias("assets"),
            F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("revenue"),
            F.round(F.sum(F.col("l_extendedprice") * F.col("l_tax")), 4).alias("capex"),
            F.sum("l_quantity").alias("inventory"),
            F.count(F.lit(1)).cast("double").alias("shareswa"),
        )
    )
    filed = F.date_add(F.add_months("fq", 3), (29 + F.col("dcm_security_id") % 45).cast("int"))
    return grouped.select(
        "dcm_security_id", "fq", filed.alias("filing_date"), "dimension",
        "assets", "revenue", "capex", "inventory", "shareswa",
    )


# macro ---------------------------------------------------------------------
# Order priority -> macro series name.
SERIES = {
    "1-URGENT": "RPI",
    "2-HIGH": "GS10",
    "3-MEDIUM": "USTRADE",
    "4-NOT SPECIFIED": "VIXCLS",
    "5-LOW": "CPFF",
}

SQL["macro_daily"] = (
    (),
    "SELECT CAST(o_orderdate AS DATE) AS date, "
    + "CASE o_orderpriority "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SERIES.items())
    + " END AS series, avg(o_totalprice) AS value FROM orders GROUP BY 1, 2",
)


def macro_daily(spark: SparkSession, d: str) -> DataFrame:
    """Daily macro observations, long: date, series, value."""
    pairs = [F.lit(x) for kv in SERIES.items() for x in kv]
    return (
        table(spark, d, "orders")
        .groupBy(
            F.to_date("o_orderdate").alias("date"),
            F.create_map(*pairs)[F.col("o_orderpriority")].alias("series"),
        )
        .agg(F.avg("o_totalprice").alias("value"))
    )


SQL["macro"] = (
    (),
    "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, "
    + ", ".join(f"avg(CASE WHEN o_orderpriority = '{k}' THEN o_totalprice END) AS {v}" for k, v in SERIES.items())
    + " FROM orders GROUP BY 1",
)


def macro(spark: SparkSession, d: str) -> DataFrame:
    """Monthly macro table, wide."""
    return (
        table(spark, d, "orders")
        .groupBy(F.trunc("o_orderdate", "month").alias("date"))
        .agg(*[F.avg(F.when(F.col("o_orderpriority") == k, F.col("o_totalprice"))).alias(v) for k, v in SERIES.items()])
    )


# membership ----------------------------------------------------------------
SQL["membership"] = (
    (),
    """SELECT date, cusip, dcm_security_id, round(v / sum(v) OVER (PARTITION BY date), 9) AS "wt-r1",
       CASE WHEN g > 0 THEN round(g / sum(v) OVER (PARTITION BY date), 9) END AS "wt-r1g",
       CASE WHEN c > 0 THEN round(c / sum(v) OVER (PARTITION BY date), 9) END AS "wt-r1v"
FROM (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, 'C' || l_suppkey AS cusip, l_suppkey AS dcm_security_id,
             round(sum(l_extendedprice), 2) AS v,
             round(sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0 END), 2) AS g,
             round(sum(CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE 0 END), 2) AS c
      FROM lineitem GROUP BY 1, 2, 3) w""",
)


def membership(spark: SparkSession, d: str) -> DataFrame:
    """Monthly index weights: whole index, growth style, value style."""
    price, key = F.col("l_extendedprice"), F.col("l_suppkey")
    flag = F.col("l_returnflag")
    sums = durable(
        table(spark, d, "lineitem")
        .groupBy(
            F.trunc("l_shipdate", "month").alias("date"),
            F.concat(F.lit("C"), key.cast("string")).alias("cusip"),
            key.alias("dcm_security_id"),
        )
        .agg(
            F.round(F.sum(price), 2).alias("v"),
            F.round(F.sum(F.when(flag == "A", price).otherwise(0.0)), 2).alias("g"),
            F.round(F.sum(F.when(flag == "N", price).otherwise(0.0)), 2).alias("c"),
        )
    )
    months_total = sums.groupBy("date").agg(F.sum("v").alias("t"))
    rows = sums.join(F.broadcast(months_total), "date")

    def share(c: str):
        return F.round(ratio(c, "t"), 9)

    return rows.select(
        "date", "cusip", "dcm_security_id",
        share("v").alias("wt-r1"),
        F.when(F.col("g") > 0, share("g")).alias("wt-r1g"),
        F.when(F.col("c") > 0, share("c")).alias("wt-r1v"),
    )


# signals and predictions ---------------------------------------------------
SQL["scores"] = (
    ("months",),
    """SELECT date, ticker, close / lag(close) OVER w - 1 AS momentum_score, -ln(high / low) AS calm_score,
       ln(volume) AS size_score, lead(close) OVER w / close - 1 AS future_ret_5B
FROM months WINDOW w AS (PARTITION BY ticker ORDER BY date)""",
)


def scores(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("ticker").orderBy("date")
    return months(spark, d).select(
        "date",
        "ticker",
        (F.col("close") / F.lag("close").over(w) - 1).alias("momentum_score"),
        (-F.ln(F.col("high") / F.col("low"))).alias("calm_score"),
        F.ln("volume").alias("size_score"),
        (F.lead("close").over(w) / F.col("close") - 1).alias("future_ret_5B"),
    )


# Ensemble weights of the three score models.
ENSEMBLE = {"momentum_score": 0.5, "calm_score": 0.3, "size_score": 0.2}


def pct_rank_sql(x: str, part: str = "date") -> str:
    return (
        f"CASE WHEN {x} IS NOT NULL THEN (count({x}) OVER (PARTITION BY {part} ORDER BY {x} NULLS LAST) "
        f"- (count({x}) OVER (PARTITION BY {part}, {x}) - 1) / 2.0) / count({x}) OVER (PARTITION BY {part}) END"
    )


SQL["signals"] = (
    ("scores",),
    "SELECT date, ticker, momentum_rank, calm_rank, size_rank, future_ret_5B,"
    " round(0.5 * momentum_rank + 0.3 * calm_rank + 0.2 * size_rank, 9) AS ensemble FROM (SELECT date, ticker, future_ret_5B, "
    + ", ".join(f"{pct_rank_sql(c)} AS {c.replace('score', 'rank')}" for c in ENSEMBLE)
    + " FROM scores) s",
)


def signals(spark: SparkSession, d: str, rows: DataFrame | None = None) -> DataFrame:
    """Percent ranks of the three scores and their weighted sum, with the later return; ``rows`` are the scores, if a caller has them."""
    rows = durable(scores(spark, d) if rows is None else rows)
    ranks = avg_ranks(rows, list(ENSEMBLE), ["date", "ticker"], ["date"], pct=True)
    named = ranks.withColumnsRenamed({c: c.replace("score", "rank") for c in ENSEMBLE})
    blend = 0.5 * F.col("momentum_rank") + 0.3 * F.col("calm_rank") + 0.2 * F.col("size_rank")
    return named.withColumn("ensemble", F.round(blend, 9)).join(
        rows.select("date", "ticker", "future_ret_5B"), ["date", "ticker"]
    )


def qcut_sql(x: str, part: str | None = "date", q: int = 5, start: int = 0) -> str:
    """Right-closed quantile bucket with duplicate edges dropped."""
    probs = "[" + ", ".join(f"{round(i / q, 12)}::DOUBLE" for i in range(q + 1)) + "]"
    over = f"(PARTITION BY {part})" if part else "()"
    edges = f"quantile_cont({x}, {probs}) OVER {over}"
    flat = f"min({x}) OVER {over} = max({x}) OVER {over}"
    # rounded, so that an edge that is a value of the group equals that value
    cuts = f"list_distinct(list_transform({edges}, lambda e: round(e, 12)))"
    return (
        f"CASE WHEN {x} IS NULL OR {flat} THEN NULL ELSE CAST(greatest(len("
        f"list_filter({cuts}, lambda e: e < round({x}, 12))) - 1, 0) + {start} AS INTEGER) END"
    )


SQL["predictions"] = (
    ("signals",),
    f"SELECT date, ticker, ensemble, {qcut_sql('ensemble')} AS ensemble_qt, future_ret_5B FROM signals",
)


def predictions(spark: SparkSession, d: str, scored: DataFrame | None = None) -> DataFrame:
    rows = signals(spark, d, scored).select("date", "ticker", "ensemble", "future_ret_5B")
    return qcut(rows, "ensemble", 5, ["date"]).select("date", "ticker", "ensemble", "ensemble_qt", "future_ret_5B")


# features and attribution --------------------------------------------------
# Feature formulas over the monthly bar, valid in both engines.
FEATURES = {
    "log_mktcap": "ln(close * volume)",
    "revenue_yield": "volume / 100.0",
    "fcf_yield": "low / close",
    "amihud": "(high - low) / (close * volume) * 1000.0",
    "volatility_21": "high / low - 1.0",
    "VIXCLS": "(high - low) / open",
    "momentum": "close / open - 1.0",
    "bm": "1000.0 / close",
    "rel_to_high": "close / high",
    "PPO_12_26": "close / ((open + close) / 2.0) - 1.0",
    "divyield": "open / high",
    "overnight_return": "open / low - 1.0",
    "maxret": "high / open - 1.0",
    "RPI": "ln(volume + 1.0)",
}
# Coefficients of the linear model behind the attribution.
COEFFICIENTS = {
    "log_mktcap": 0.04, "revenue_yield": -0.01, "fcf_yield": 0.3, "amihud": -0.05, "volatility_21": -0.02,
    "VIXCLS": 0.015, "momentum": 0.06, "bm": 0.02, "rel_to_high": 0.12, "PPO_12_26": -0.07, "divyield": 0.05,
    "overnight_return": -0.03, "maxret": 0.025, "RPI": 0.033,
}

SQL["features"] = (
    ("months",),
    "SELECT date, ticker, " + ", ".join(f"{e} AS {n}" for n, e in FEATURES.items()) + " FROM months",
)


def features(spark: SparkSession, d: str) -> DataFrame:
    return months(spark, d).select("date", "ticker", *[F.expr(e).alias(n) for n, e in FEATURES.items()])


SQL["attribution"] = (
    ("features",),
    "SELECT date, ticker, "
    + ", ".join(f"{COEFFICIENTS[n]} * ({n} - avg({n}) OVER ()) AS {n}" for n in FEATURES)
    + " FROM features",
)


def attribution(spark: SparkSession, d: str) -> DataFrame:
    """Contribution of each feature to the linear score."""
    from panelwright.operators.models import linear_attribution

    return linear_attribution(features(spark, d), COEFFICIENTS).select("date", "ticker", *FEATURES)

# SQL-only helpers ----------------------------------------------------------
SQL["grid"] = (
    ("prices",),
    """SELECT d.date, t.ticker, p.open, p.high, p.low, p.close, p.volume
FROM (SELECT DISTINCT date FROM prices) d CROSS JOIN (SELECT DISTINCT ticker FROM prices) t
LEFT JOIN prices p ON p.date = d.date AND p.ticker = t.ticker""",
)


def over(n: int | None = None, by: str = "ticker", order: str = "date", shift: int = 0) -> str:
    """OVER clause of the last n rows (all earlier rows if None), ``shift`` rows back."""
    start = "UNBOUNDED" if n is None else str(n - 1 + shift)
    end = f"{shift} PRECEDING" if shift else "CURRENT ROW"
    return f"OVER (PARTITION BY {by} ORDER BY {order} ROWS BETWEEN {start} PRECEDING AND {end})"


def roll(fn: str, x: str, n: int, need: int | None = None, **kw) -> str:
    """Gated rolling aggregate."""
    fn_call = f"{fn}({x})" if "{" not in fn else fn.format(x=x)
    return f"CASE WHEN count({x}) {over(n, **kw)} >= {n if need is None else need} THEN {fn_call} {over(n, **kw)} END"


def fill(x: str, limit: int | None = None, **kw) -> str:
    return f"last_value({x} IGNORE NULLS) {over(None if limit is None else limit + 1, **kw)}"


def cents(x: str, scale: str = "100.0::DOUBLE") -> str:
    return f"round_even(({x}) * {scale}, 0) / {scale}"


SQL["prep3"] = (
    ("grid",),
    "SELECT date, ticker, " + ", ".join(f"{cents(fill(c, 3, shift=1))} AS {c}" for c in ("high", "low", "close")) + " FROM grid",
)
SQL["prepall"] = (
    ("grid",),
    "SELECT date, ticker, " + ", ".join(f"{cents(fill(c, None, shift=1))} AS {c}" for c in ("high", "low", "close")) + " FROM grid",
)
