"""Indicators defined by recursion in time: one Arrow group per security, numpy inside.

A group holds at most one row per calendar day, so its size is bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.columns import KEY, TIME, ffill, lag_n, rolling
from panelwright.operators.indicators import prepared, smoothed


def per_group(df: DataFrame, fn: Callable[[pd.DataFrame], dict[str, np.ndarray]], outputs: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``fn`` over the time-ordered rows of each security, adding double columns."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"`{TIME}` {kinds[TIME]}", f"`{KEY}` {kinds[KEY]}", *[f"`{o}` double" for o in outputs]])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(TIME)
        return pd.DataFrame({TIME: pdf[TIME], KEY: pdf[KEY], **fn(pdf)})

    return df.select(TIME, KEY, *cols).groupBy(KEY).applyInPandas(run, schema)


def _after_gap(x: np.ndarray) -> int:
    """Index of the first value; leading gaps are skipped."""
    present = np.flatnonzero(~np.isnan(x))
    return int(present[0]) if len(present) else len(x)


def _smoothed(seed: float, x: np.ndarray, alpha: float, skip: bool = False) -> np.ndarray:
    """Exponential mean that starts at ``seed``; a gap ends it, or with ``skip`` leaves it as it was."""
    path = np.append(seed, x)
    mean = pd.Series(path).ewm(alpha=alpha, adjust=False, ignore_na=skip).mean().to_numpy()
    return mean if skip else np.where(np.logical_or.accumulate(np.isnan(path)), np.nan, mean)


def wilder_rsi(x: np.ndarray, n: int) -> np.ndarray:
    """Relative strength with Wilder smoothing, started from the mean of the first n changes."""
    out = np.full(len(x), np.nan)
    s = _after_gap(x)
    if len(x) - s <= n:
        return out
    change = np.diff(x[s:])
    up, down = np.where(change > 0, change, 0.0), np.where(change < 0, -change, 0.0)
    up[np.isnan(change)] = down[np.isnan(change)] = np.nan
    gain = _smoothed(up[:n].mean(), up[n:], 1.0 / n)
    both = gain + _smoothed(down[:n].mean(), down[n:], 1.0 / n)
    out[s + n :] = np.where(both == 0, 0.0, 100.0 * np.divide(gain, both, out=np.full(len(both), np.nan), where=both != 0))
    return out


def seeded_ema(x: np.ndarray, n: int) -> np.ndarray:
    """Exponential mean started from the plain mean of the first n values."""
    out = np.full(len(x), np.nan)
    s = _after_gap(x)
    if len(x) - s < n:
        return out
    out[s + n - 1 :] = _smoothed(x[s : s + n].mean(), x[s + n :], 2.0 / (n + 1))
    return out


def wilder_adx(high: np.ndarray, low: np.ndarray, close: np.ndarray, n: int) -> np.ndarray:
    """Average directional index with Wilder sums; first value at row 2n - 1."""
    out = np.full(len(close), np.nan)
    s = max(_after_gap(high), _after_gap(low), _after_gap(close))
    h, lo, c = high[s:], low[s:], close[s:]
    if len(c) < 2 * n:
        return out
    rise, fall = np.diff(h), -np.diff(lo)
    plus = np.where((rise > 0) & (rise > fall), rise, 0.0)
    minus = np.where((fall > 0) & (rise < fall), fall, 0.0)
    spread = np.maximum(h[1:] - lo[1:], np.maximum(np.abs(h[1:] - c[:-1]), np.abs(lo[1:] - c[:-1])))
    gap = np.isnan(rise) | np.isnan(fall) | np.isnan(spread)
    plus[gap] = minus[gap] = spread[gap] = np.nan
    # a Wilder sum is n times an exponential mean; from row n - 1 on
    p, m, t = (_smoothed(v[: n - 1].sum() / n, v[n - 1 :], 1.0 / n)[1:] for v in (plus, minus, spread))
    defined = (t != 0) & (p + m != 0) & ~np.isnan(t)
    dx = np.divide(100.0 * np.abs(m - p), m + p, out=np.full(len(p), np.nan), where=defined)
    adx = _smoothed(np.nansum(dx[:n]) / n, dx[n:], 1.0 / n, skip=True)
    out[s + 2 * n - 1 :] = np.where(np.isnan(t[n - 1 :]), np.nan, adx)
    return out


def ewm(df: DataFrame, col: str, span: int, adjust: bool = True, out: str | None = None) -> DataFrame:
    """Exponentially weighted mean, null until ``span`` values are there."""
    name = out or f"{col}_ewm_{span}"

    def run(pdf: pd.DataFrame) -> dict[str, np.ndarray]:
        return {name: pdf[col].astype(float).ewm(span=span, min_periods=span, adjust=adjust).mean().to_numpy()}

    return _nulls(per_group(df, run, [name], [col]), [name])


def _nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in cols})


def stochrsi(prices: DataFrame, timeperiod: int = 14, fastk: int = 5, fastd: int = 3, price: str = "close", **prep) -> DataFrame:
    """Fast stochastic of the relative strength index."""
    prep.setdefault("shift", 0 if price == "open" else 1)
    base = prepared(prices, [price], **prep)
    rsi = _nulls(per_group(base, lambda g: {"rsi": wilder_rsi(g[price].to_numpy(float), timeperiod)}, ["rsi"], [price]), ["rsi"])
    ranged = rsi.withColumns({"_hh": rolling("rsi", fastk, "max"), "_ll": rolling("rsi", fastk, "min")})
    span = F.col("_hh") - F.col("_ll")
    tag = f"{timeperiod}_{fastk}_{fastd}"
    k, d = f"STOCHRSI_FASTK_{tag}", f"STOCHRSI_FASTD_{tag}"
    fast = F.when(span == 0, 0.0).otherwise((F.col("rsi") - F.col("_ll")) / F.nullif(span / 100.0, F.lit(0.0)))
    lines = ranged.withColumn(k, F.when(F.col("rsi").isNotNull(), fast)).withColumn(d, rolling(k, fastd))
    return lines.where(F.col(d).isNotNull()).select(TIME, KEY, k, d)


def adx(prices: DataFrame, n: int = 14, smooth: int = 3, **prep) -> DataFrame:
    """Average directional index (gaps not filled) and its moving average."""
    prep.setdefault("fill_limit", 0)
    base = prepared(prices, ["high", "low", "close"], **prep)
    name = f"ADX_{n}"

    def run(g: pd.DataFrame) -> dict[str, np.ndarray]:
        return {name: wilder_adx(*[g[c].to_numpy(float) for c in ("high", "low", "close")], n)}

    rows = _nulls(per_group(base, run, [name], ["high", "low", "close"]), [name])
    return smoothed(rows, name, smooth, f"{name}_MA_{smooth}")


def macd(prices: DataFrame, fast: int = 12, slow: int = 26, smooth: int = 3, price: str = "close") -> DataFrame:
    """Difference of two exponential means over the security's own rows, its average and their gap."""
    shift = 0 if price == "open" else 1

    def run(g: pd.DataFrame) -> dict[str, np.ndarray]:
        x = g[price].astype(float).ffill()
        quick, slowly = (x.ewm(span=n, min_periods=n, adjust=True).mean() for n in (fast, slow))
        return {"macd": (quick - slowly).shift(shift).to_numpy()}

    rows = _nulls(per_group(prices, run, ["macd"], [price]), ["macd"])
    lined = rows.withColumn("macd_centerline", rolling("macd", smooth))
    return lined.withColumn("macd_diff", F.col("macd") - F.col("macd_centerline"))


def trix(prices: DataFrame, n: int = 30, price: str = "close", limit: int | None = 3) -> DataFrame:
    """One-row change, in percent, of a triple exponential mean over the security's own rows."""
    shift = 0 if price == "open" else 1
    name = f"TRIX_{n}"
    filled = prices.select(TIME, KEY, ffill(price, limit).alias("_x"))

    def run(g: pd.DataFrame) -> dict[str, np.ndarray]:
        triple = seeded_ema(seeded_ema(seeded_ema(g["_x"].to_numpy(float), n), n), n)
        rate = np.full(len(triple), np.nan)
        rate[1:] = np.divide(triple[1:], triple[:-1], out=np.ones(len(triple) - 1), where=triple[:-1] != 0) - 1
        return {name: rate * 100.0}

    rows = _nulls(per_group(filled, run, [name], ["_x"]), [name])
    return rows.select(TIME, KEY, lag_n(name, shift).alias(name))


RECURSIVE: dict[str, Callable[..., DataFrame]] = {"stochrsi": stochrsi, "adx": adx, "macd": macd, "trix": trix}
