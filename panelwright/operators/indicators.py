"""Technical indicators in window form: one exchange by security, chained windows on top.

The oscillators run on the dense (date x security) grid, gaps filled for at most
three rows, moved down one row and rounded to two places, unless noted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.columns import (
    KEY,
    TIME,
    clip,
    ffill,
    half_even,
    lag_n,
    pct_change,
    ratio,
    rolled,
    rolling,
    rolling_moments,
)
from panelwright.operators.grid import densify
from panelwright.operators.order_stats import avg_rank, clean, winsorize, with_quantiles
from panelwright.operators.sizes import CALENDAR_DAYS, attach


def prepared(
    prices: DataFrame,
    cols: Sequence[str],
    fill_limit: int | None = 3,
    shift: int = 1,
    digits: int | None = 2,
    grid: bool = True,
    others: Sequence[str] = (),
) -> DataFrame:
    """Price columns on the grid (or the security's own rows): filled, shifted, rounded.

    ``fill_limit`` 0 leaves gaps open, None fills without limit; ``others`` of the own rows stay as they are.
    """
    frame = densify(prices, cols=cols, lead_in=False) if grid else prices.select(TIME, KEY, *others, *cols)
    if fill_limit == 0:
        moved = {c: lag_n(c, shift) if shift else F.col(c) for c in cols}
    else:
        moved = {c: ffill(c, fill_limit, shift=shift) for c in cols}
    if digits is not None:
        moved = {c: half_even(x, digits) for c, x in moved.items()}
    return frame.withColumns(moved)


def _only_new(prices: DataFrame, add: Callable[..., DataFrame], **params) -> DataFrame:
    """The keys and the columns that ``add`` makes; it keeps every row."""
    rows = prices.select(TIME, KEY, *[c for c in ("open", "high", "low", "close", "volume") if c in prices.columns])
    made = add(rows, **params)
    return made.select(TIME, KEY, *[c for c in made.columns if c not in rows.columns])


def smoothed(df: DataFrame, c: str, n: int, out: str) -> DataFrame:
    """Moving average over the non-null rows of a security."""
    return df.where(F.col(c).isNotNull()).withColumn(out, rolling(c, n))


def add_volatility(df: DataFrame, lookbacks: Sequence[int] = (63, 21, 126), price: str = "close") -> DataFrame:
    shift = 0 if price == "open" else 1
    logs = df.withColumn("_x", F.ln(price)).withColumn("_r", lag_n("_x", shift) - lag_n("_x", shift + 1))
    deviations = rolled(logs, {f"volatility_{n}": ("_r", n, "std") for n in lookbacks})
    return deviations.withColumns({f"volatility_{n}": F.col(f"volatility_{n}") * F.sqrt(F.lit(252.0)) for n in lookbacks}).drop("_x", "_r")


def volatility(prices: DataFrame, lookbacks: Sequence[int] = (63, 21, 126), price: str = "close") -> DataFrame:
    """Annualised deviation of log returns over the security's own rows, moved down one row."""
    return _only_new(prices, add_volatility, lookbacks=lookbacks, price=price)


def _williams(base: DataFrame, n: int, name: str, *others: str) -> DataFrame:
    ranged = rolled(base, {"_hh": ("high", n, "max"), "_ll": ("low", n, "min")})
    span = F.col("_hh") - F.col("_ll")
    value = F.when(span == 0, 0.0).otherwise((F.col("_hh") - F.col("close")) / F.nullif(span, F.lit(0.0)) * -100.0)
    return ranged.select(TIME, KEY, *others, F.when(F.col("close").isNotNull(), value).alias(name))


def willr(prices: DataFrame, n: int = 14, smooth: int = 3, **prep) -> DataFrame:
    """Williams %R and its moving average."""
    name = f"WILLR_{n}"
    rows = _williams(prepared(prices, ["high", "low", "close"], **prep), n, name)
    return smoothed(rows, name, smooth, f"{name}_MA_{smooth}")


def with_willr(prices: DataFrame, n: int = 14, smooth: int = 3, **prep) -> DataFrame:
    """All rows of ``prices``, the columns beside the prices, and what :func:`willr` has for a row.

    The other columns go over the grid in one struct, so that the two tables need no join;
    one row per (date, security).  A row without a day or security has no value.
    """
    used, name = ["high", "low", "close"], f"WILLR_{n}"
    others = [c for c in prices.columns if c not in (TIME, KEY, "open", "volume", *used)]
    dated = [F.when(F.col(TIME).isNotNull(), F.col(c)).alias(c) for c in used]
    rows = prices.select(TIME, KEY, F.struct(*others).alias("_row"), *dated)
    grid = densify(rows, cols=["_row", *used], lead_in=False, undated=True)
    values = _williams(prepared(grid, used, grid=False, others=["_row"], **prep), n, name, "_row")
    # rows of the grid stay, so the mean is of the last values and not of the last rows
    back = [F.expr(f"lag({name}, {k}) IGNORE NULLS OVER (PARTITION BY {KEY} ORDER BY {TIME})") for k in range(smooth - 1, 0, -1)]
    mean = reduce(Column.__add__, [*back, F.col(name)], F.lit(0.0)) / float(smooth)
    smooth_name = f"{name}_MA_{smooth}"
    made = values.withColumn(smooth_name, mean).where(F.col("_row").isNotNull())
    return made.select(TIME, KEY, "_row.*", *[F.when(F.col(KEY).isNotNull(), F.col(c)).alias(c) for c in (name, smooth_name)])


def _raw_stochastic(base: DataFrame, high: str, low: str, close: str, n: int, out: str) -> DataFrame:
    ranged = rolled(base, {"_hh": (high, n, "max"), "_ll": (low, n, "min")})
    span = F.col("_hh") - F.col("_ll")
    value = F.when(span == 0, 0.0).otherwise((F.col(close) - F.col("_ll")) / F.nullif(span / 100.0, F.lit(0.0)))
    return ranged.withColumn(out, F.when(F.col(close).isNotNull(), value)).drop("_hh", "_ll")


def stochf(prices: DataFrame, fastk: int = 5, fastd: int = 3, **prep) -> DataFrame:
    """Fast stochastic; both lines start where the slower one does."""
    base = prepared(prices, ["high", "low", "close"], **prep)
    k, d = f"FASTK_{fastk}_{fastd}", f"FASTD_{fastk}_{fastd}"
    raw = _raw_stochastic(base, "high", "low", "close", fastk, k)
    lines = raw.withColumn(d, rolling(k, fastd))
    return lines.where(F.col(d).isNotNull()).select(TIME, KEY, k, d)


def stoch(prices: DataFrame, fastk: int = 5, slowk: int = 3, slowd: int = 3, **prep) -> DataFrame:
    """Slow stochastic."""
    base = prepared(prices, ["high", "low", "close"], **prep)
    k, d = f"SLOWK_{fastk}_{slowd}_{slowk}", f"SLOWD_{fastk}_{slowd}_{slowk}"
    raw = _raw_stochastic(base, "high", "low", "close", fastk, "_fast")
    slow = raw.withColumn(k, rolling("_fast", slowk))
    lines = slow.withColumn(d, rolling(k, slowd))
    return lines.where(F.col(d).isNotNull()).select(TIME, KEY, k, d)


def add_ppo(df: DataFrame, fast: int = 12, slow: int = 26, sign: float = -1.0, price: str = "close", limit: int | None = 3) -> DataFrame:
    shift = 0 if price == "open" else 1
    filled = df.withColumn("_x", F.col(price)).withColumn("_x", ffill("_x", limit))
    quick, slowly = min(fast, slow), max(fast, slow)
    parts = rolled(filled, {"_f": ("_x", quick, "avg"), "_s": ("_x", slowly, "avg")})
    value = F.when(F.col("_s") == 0, 0.0).otherwise((F.col("_f") - F.col("_s")) / F.nullif("_s", F.lit(0.0)) * 100.0)
    return parts.withColumn("_p", sign * value).withColumn(f"PPO_{fast}_{slow}", lag_n("_p", shift)).drop("_x", "_f", "_s", "_p")


def ppo(prices: DataFrame, fast: int = 12, slow: int = 26, sign: float = -1.0, price: str = "close", limit: int | None = 3) -> DataFrame:
    """Percentage price oscillator of two simple averages over the security's own rows."""
    return _only_new(prices, add_ppo, fast=fast, slow=slow, sign=sign, price=price, limit=limit)


def ultosc(prices: DataFrame, n: Sequence[int] = (7, 14, 28), smooth: int = 3, **prep) -> DataFrame:
    """Ultimate oscillator and its moving average."""
    base = prepared(prices, ["high", "low", "close"], **prep)
    prev = base.withColumn("_pc", lag_n("close", 1))
    whole = F.col("high").isNotNull() & F.col("low").isNotNull() & F.col("close").isNotNull() & F.col("_pc").isNotNull()
    low_true = F.least("low", "_pc")
    spread = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("_pc") - F.col("high")), F.abs(F.col("_pc") - F.col("low")))
    parts = prev.withColumns({"_bp": F.when(whole, F.col("close") - low_true), "_tr": F.when(whole, spread)})
    short, mid, long = sorted(n)
    sums = rolled(parts, {f"_{k}{m}": (f"_{k}", m, "sum") for m in (short, mid, long) for k in ("bp", "tr")})

    def term(m: int):
        return F.coalesce(ratio(f"_bp{m}", f"_tr{m}"), F.lit(0.0))

    name = "ULTOSC_" + "_".join(str(m) for m in n)
    value = 100.0 * (4.0 * term(short) + 2.0 * term(mid) + term(long)) / 7.0
    rows = sums.select(TIME, KEY, F.when(F.col(f"_tr{long}").isNotNull(), value).alias(name))
    return smoothed(rows, name, smooth, f"{name}_MA_{smooth}")


def dollar_volume(prices: DataFrame, n: int = 21) -> DataFrame:
    """Average price and dollar volume over n grid rows, filled without limit, moved down one row."""
    daily = prices.select(
        TIME, KEY, F.expr("(open + close) / 2.0").alias("_p"), F.expr("volume * (open + close) / 2.0").alias("_d")
    )
    grid = densify(daily).withColumns({"_p": ffill("_p"), "_d": ffill("_d")})
    means = rolled(grid, {"_pm": ("_p", n, "avg"), "_dm": ("_d", n, "avg")})
    return means.select(TIME, KEY, lag_n("_pm", 1).alias("avg_price"), lag_n("_dm", 1).alias("avg_dollar_volume"))


def add_overnight_return(df: DataFrame) -> DataFrame:
    rows = df.withColumns({"_o": half_even("open", 3), "_c": half_even("close", 3)}).withColumn("_pc", ffill("_c", None, shift=1))
    return rows.withColumn("overnight_return", ratio(F.coalesce("_o", "_pc"), "_pc") - 1).drop("_o", "_c", "_pc")


def overnight_return(prices: DataFrame) -> DataFrame:
    """Open against the previous close; a missing open counts as that close."""
    return _only_new(prices, add_overnight_return)


def add_past_returns(df: DataFrame, lags: Sequence[int] = (1, 2, 5, 10, 21, 63, 126, 252), price: str = "close") -> DataFrame:
    shift = 0 if price == "open" else 1
    now = lag_n(price, shift) if shift else F.col(price)
    return df.withColumns({f"ret_{k}B": F.coalesce(ratio(now, lag_n(price, shift + k)) - 1, F.lit(0.0)) for k in lags})


def past_returns(prices: DataFrame, lags: Sequence[int] = (1, 2, 5, 10, 21, 63, 126, 252), price: str = "close") -> DataFrame:
    """Returns over the security's own rows up to the row before; missing as 0."""
    return _only_new(prices, add_past_returns, lags=lags, price=price)


def future_returns(
    prices: DataFrame, periods: Sequence[int] = (1, 5, 10, 21, 42), alpha: float | None = 0.01, price: str = "close"
) -> DataFrame:
    """Return over the next k grid rows, winsorized per date.

    The change pads first, so a security without prices goes on returning 0.
    """
    grid = densify(prices, cols=[price], lead_in=False).withColumn("_x", ffill(price))
    names = [f"future_ret_{k}B" for k in periods]
    rows = grid.select(
        TIME, KEY, *[(ratio(lag_n("_x", -k), "_x") - 1).alias(n) for k, n in zip(periods, names)]
    ).dropna("all", subset=names)
    return winsorize(rows, names, [TIME], alpha) if alpha else rows


def log_returns(prices: DataFrame, price: str = "close", pad: bool = False) -> DataFrame:
    """Log return between neighbouring grid days."""
    grid = densify(prices, cols=[price])
    if pad:
        grid = grid.withColumn(price, ffill(price))
    return grid.withColumn("_x", F.ln(price)).withColumn("r", F.col("_x") - lag_n("_x", 1)).select(TIME, KEY, "r")


def _with_benchmark(rows: DataFrame, col: str, benchmark) -> DataFrame:
    side = rows.where(F.col(KEY) == benchmark).select(TIME, F.col(col).alias("_b"))
    return attach(rows, side, [TIME], max_rows=CALENDAR_DAYS)


def _rounded(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits) + F.lit(0.0)


def beta(
    prices: DataFrame, benchmark, n: int = 63, price: str = "close", denominator: str = "own",
    name: str | None = None, pad: bool = False, digits: int | None = None,
) -> DataFrame:
    """Rolling covariance with a benchmark over a variance, moved down one row, and its rank per date.

    ``digits`` rounds before ranking, so that noise in the last digits makes no order.  The variance is the security's own by default; ``denominator='benchmark'`` gives the textbook form.
    """
    name = name or str(benchmark)
    both = _with_benchmark(log_returns(prices, price, pad), "r", benchmark)
    moments = rolling_moments(both, "r", "_b", n)
    raw = moments.withColumn("_beta", ratio("cov", "var_a" if denominator == "own" else "var_b"))
    moved = raw.select(TIME, KEY, _rounded(lag_n("_beta", 1), digits).alias(f"{name}_beta"))
    return avg_rank(moved, f"{name}_beta", f"{name}_beta_rank")


def correlation(prices: DataFrame, benchmark, n: int = 63, price: str = "close", name: str | None = None, pad: bool = False, digits: int | None = None) -> DataFrame:
    """Rolling correlation of rolling-standardized log returns with a benchmark, and its rank per date; ``digits`` as in :func:`beta`."""
    name = name or str(benchmark)
    filled = log_returns(prices, price, pad).withColumn("r", F.coalesce("r", F.lit(0.0)))
    scored = rolled(filled, {"_m": ("r", n, "avg"), "_s": ("r", n, "std")}).withColumn("z", ratio(F.col("r") - F.col("_m"), "_s"))
    both = _with_benchmark(scored.select(TIME, KEY, "z"), "z", benchmark)
    moments = rolling_moments(both, "z", "_b", n)
    raw = moments.withColumn("_corr", ratio("cov", F.sqrt(F.greatest(F.col("var_a") * F.col("var_b"), F.lit(0.0)))))
    moved = raw.select(TIME, KEY, _rounded(lag_n("_corr", 1), digits).alias(f"{name}_correl"))
    return avg_rank(moved, f"{name}_correl", f"{name}_correl_rank")


def sampled_returns(
    prices: DataFrame, dates: DataFrame, universe: DataFrame | None = None, lead: int = 0, price: str = "close"
) -> DataFrame:
    """Returns between sampling days, clipped at 0.5 / 99.5 % per date, missing as 0."""
    grid = densify(prices, cols=[price]).withColumn("_x", ffill(price))
    sampled = grid.join(F.broadcast(dates.select(TIME)), TIME, "left_semi")
    # after sampling the fill has reached every later row, so neighbouring rows give the change
    change = sampled.select(TIME, KEY, (ratio("_x", lag_n("_x", 1)) - 1).alias("ret"))
    framed = with_quantiles(change, ["ret"], [0.005, 0.995])
    bounded = framed.select(
        TIME, KEY,
        clip(
            clean("ret"),
            F.coalesce(F.element_at("q_ret", 1), F.lit(-0.999999999)),
            F.coalesce(F.element_at("q_ret", 2), F.lit(2.0)),
        ).alias("ret"),
    )
    if universe is not None:
        from panelwright.operators.grid import with_universe

        bounded = with_universe(bounded, universe)
    whole = bounded.withColumn("ret", F.coalesce("ret", F.lit(0.0)))
    if lead:
        whole = whole.withColumn("ret", F.coalesce(lag_n("ret", -lead), F.lit(0.0)))
    return whole


def liquidity(prices: DataFrame, shares: DataFrame | str | None = None, pad_limit: int | None = None) -> DataFrame:
    """Volatility, maximum, dollar volume, distance to high, illiquidity and idle days, moved down one row.

    The 252-row high is that of the closing price.  ``shares``, a table (date, ticker,
    shares) or a column of the prices, adds the 252-row change of the share count.
    """
    rows = prices.select(TIME, KEY, "close", "volume", *([F.col(shares).alias("shares")] if isinstance(shares, str) else []))
    if isinstance(shares, DataFrame):
        rows = rows.join(shares.select(TIME, KEY, "shares"), [TIME, KEY], "left")
    grid = densify(rows)
    dolvol = F.col("close") * F.col("volume")
    held = {"_ret": ratio(ffill("close"), ffill("close", shift=1)) - 1, "dolvol": lag_n(dolvol, 1), "_close": lag_n("close", 1)}
    if shares is not None:
        held["chcsho"] = ratio(ffill("shares", shift=1), ffill("shares", shift=253)) - 1
    grid = grid.withColumns(held).withColumns(
        {
            "_idle": F.when(F.coalesce(F.col("volume") == 0, F.lit(False)), 1.0).otherwise(0.0),
            "_ill": ratio(F.abs("_ret"), dolvol),
        }
    )
    grid = rolled(
        grid,
        {
            "_high": ("close", 252, "max"),
            "retvol": ("_ret", 21, "std"),
            "maxret": ("_ret", 21, "max"),
            "amihud": ("_ill", 21, "avg"),
            "zerodays": ("_idle", 21, "sum"),
        },
        shift=1,
    )
    feats = ["retvol", "maxret", "dolvol", "rel_to_high", "amihud", "zerodays", *(["chcsho"] if shares is not None else [])]
    # where 21 rows are there, idle days are counted; no other column but dollar volume has a value before
    held = grid.where(F.col("zerodays").isNotNull() | F.col("dolvol").isNotNull())
    kept = held.withColumn("rel_to_high", ratio("_close", "_high")).select(TIME, KEY, *feats)
    return kept.withColumn("amihud", -F.ln(F.col("amihud") + 1e-12))


INDICATORS: dict[str, Callable[..., DataFrame]] = {
    "volatility": volatility,
    "willr": willr,
    "stoch": stoch,
    "stochf": stochf,
    "ppo": ppo,
    "ultosc": ultosc,
    "dollar_volume": dollar_volume,
    "overnight_return": overnight_return,
    "past_returns": past_returns,
    "future_returns": future_returns,
}


# these add columns to a security's own rows and keep every row
OWN_ROWS: dict[str, Callable[..., DataFrame]] = {
    "volatility": add_volatility,
    "ppo": add_ppo,
    "overnight_return": add_overnight_return,
    "past_returns": add_past_returns,
}


def indicators(prices: DataFrame, configs: Sequence[tuple[str, dict]]) -> DataFrame:
    """Several indicators or configurations, by name, aligned on (date, security).

    All that work on the security's own rows come from one frame, so their windows
    share one exchange and one sort; those on the grid or on smoothed rows are joined.
    """
    from panelwright.operators.recursive import RECURSIVE

    known = {**INDICATORS, **RECURSIVE}
    own, made = prices, {}
    for i, (name, params) in enumerate(configs):
        if name in OWN_ROWS:
            wider = OWN_ROWS[name](own, **params)
            made[i] = [c for c in wider.columns if c not in own.columns]
            own = wider
    tables = [own.select(TIME, KEY, *[c for names in made.values() for c in names])] if made else []
    for i, (name, params) in enumerate(configs):
        if i not in made:
            table = known[name](prices, **params)
            made[i] = [c for c in table.columns if c not in (TIME, KEY)]
            tables.append(table)
    whole = reduce(lambda a, b: a.join(b, [TIME, KEY], "full"), tables)
    return whole.select(TIME, KEY, *[c for i in range(len(configs)) for c in made[i]])


__all__ = [
    "INDICATORS", "beta", "correlation", "dollar_volume", "future_returns", "indicators", "liquidity",
    "log_returns", "overnight_return", "past_returns", "ppo", "prepared", "sampled_returns", "smoothed",
    "stoch", "stochf", "ultosc", "volatility", "willr", "with_willr", "pct_change",
]
