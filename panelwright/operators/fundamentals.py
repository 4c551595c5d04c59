"""Filings to features: cleaning, as-of carrying with staleness limits, ratios and growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.columns import KEY, TIME, carry, diff, ffill, lag_n, pct_change, ratio, rolling
from panelwright.operators.calendar import next_month_start
from panelwright.operators.crosssec import demean
from panelwright.operators.grid import densify
from panelwright.operators.picks import dominant, first_by, last_values

ID = "dcm_security_id"


def clean_filings(raw: DataFrame, filed: str = "filing_date", period: str = "fq") -> DataFrame:
    """One filing per (security, day, period), the quarterly form first, and the latest per month.

    ``date`` is the first weekday of the month after filing.
    """
    dated = raw.withColumn(TIME, next_month_start(filed))
    one = first_by(dated, [ID, filed, period], [F.col("dimension")])
    return first_by(one, [ID, TIME], [F.desc(filed), F.desc(period)])


def last_per_quarter(filings: DataFrame) -> DataFrame:
    """Last non-null values per (security, quarter) in filing order."""
    return last_values(filings.drop(TIME), [ID, "fq"], ["filing_date"])


def weekdays(df: DataFrame, start: str, end=None) -> DataFrame:
    """Weekdays from the first day of a frame to its last (or a given day)."""
    last = df.agg(F.max(start)).scalar() if end is None else end
    span = df.agg(F.min(start).alias("a")).select(F.explode(F.sequence("a", last)).alias(TIME))
    return span.where(F.weekday(TIME) < 5)


def filings_asof(
    filings: DataFrame,
    grid: DataFrame,
    fields: Sequence[str],
    limits: dict[str, int] = {"ARQ": 126, "ART": 400},
    lag: int = 1,
    by_month: bool = False,
) -> DataFrame:
    """Filed values known on each grid day, each field carried on its own.

    A security uses the form it files most.  Quarterly filers count from the
    filing day (filings off the grid are lost), trailing filers from the month
    start; values appear ``lag`` grid rows later and live for ``limits`` rows.
    On the month grid both start at the month start.  Input: cleaned filings, so
    that a security has one row per filing day and per month.
    """
    main = dominant(filings, [ID], "dimension").select(ID, F.col("dimension").alias("_main"))
    placed = filings.join(main, ID)
    at = F.col(TIME) if by_month else F.when(F.col("_main") == "ARQ", F.col("filing_date")).otherwise(F.col(TIME))
    rows = placed.select(at.alias(TIME), ID, "_main", *fields)
    # the form is a fact of the security, so the dense grid splits into the two groups without a join
    out = None
    for form, limit in limits.items():
        cells = densify(rows.where(F.col("_main") == form).drop("_main"), grid, ID, lead_in=False)
        carried = carry(cells, fields, limit, ID, TIME, lag)
        part = carried.dropna("all", subset=list(fields)).withColumn("form", F.lit(form))
        out = part if out is None else out.unionByName(part)
    return out


def filled_on(df: DataFrame, grid: DataFrame, cols: Sequence[str], limit: int = 5, key: str = ID) -> DataFrame:
    """Columns put on a grid and filled for at most ``limit`` rows."""
    cells = densify(df, grid, key, cols=cols, lead_in=False)
    return cells.withColumns({c: ffill(c, limit, key) for c in cols}).dropna("all", subset=list(cols))


def market_cap(df: DataFrame, shares: str = "sharesbas", close: str = "close", factor: str = "sharefactor") -> DataFrame:
    return df.withColumn("marketcap", F.col(shares) * F.col(close) * F.col(factor))


# Ratio name -> (numerator, denominator).
RATIOS = {
    "debt2equity": ("debt", "equity"),
    "fcf_yield": ("fcf", "marketcap"),
    "gp2assets": ("gp", "assets"),
    "turnover": ("volume", "shareswa"),
    "capex_yield": ("capex", "marketcap"),
    "current_to_total_assets": ("assetsc", "assets"),
    "inventory_to_revenue": ("inventory", "revenue"),
    "ncf_yield": ("ncf", "marketcap"),
    "ncfdiv_yield": ("ncfdiv", "marketcap"),
    "ncfcommon_yield": ("ncfcommon", "marketcap"),
    "ncfdebt_yield": ("ncfdebt", "marketcap"),
    "retearn_to_liabilitiesc": ("retearn", "liabilitiesc"),
    "retearn_to_total_assets": ("retearn", "assets"),
    "rnd_to_revenue": ("rnd", "revenue"),
    "investments_yield": ("investments", "assets"),
    "ncff_yield": ("ncff", "assets"),
    "revenue_yield": ("revenue", "assets"),
    "ncfi_yield": ("ncfi", "assets"),
    "ebitda_to_ev": ("ebitda", "ev"),
}


def fundamental_ratios(df: DataFrame, sector: DataFrame, sector_col: str = "GICS_Sector", group_col: str = "GICS_IndustryGroup") -> DataFrame:
    """Logs, yields and ratios of the fields a frame has, and book-to-market against sector and group."""
    side = sector.select(F.col(ID), F.col(sector_col), F.col(group_col))
    rows = df.join(side, ID, "left").fillna("n/a", [sector_col, group_col])
    have = set(df.columns)
    made = {name: ratio(a, b) for name, (a, b) in RATIOS.items() if {a, b} <= have}
    if "marketcap" in have:
        made["log_mktcap"] = F.ln("marketcap")
    if {"close", "volume"} <= have:
        made["log_dollar_volume"] = F.ln(F.col("close") * F.col("volume"))
    if {"ncfdiv", "ncfcommon", "ncfdebt", "marketcap"} <= have:
        made["sharey"] = ratio(F.col("ncfdiv") + F.col("ncfcommon") + F.col("ncfdebt"), "marketcap")
    if {"sharesbas", "sharefactor"} <= have:
        made["shares"] = F.col("sharesbas") * F.col("sharefactor")
    if "pb" in have:
        made["bm"] = ratio(F.lit(1.0), "pb")
    rows = rows.withColumns(made)
    if "pb" in have:
        rows = demean(rows, "bm", [TIME, sector_col], "bm_ia_sector")
        rows = demean(rows, "bm", [TIME, group_col], "bm_ia_indgrp")
    return rows


def fundamental_growth(quarterly: DataFrame, keys: tuple[str, str] = (ID, "fq")) -> DataFrame:
    """Four-quarter and one-quarter growth on the grid of all quarters.

    ``future_*`` is the growth of the quarter before, as the shift goes that way.
    """
    by, time = keys
    grid = densify(quarterly.select(by, time, "assets", "revenue", "capex", "inventory", "shareswa"), by=by, time=time)

    def growth(c: str, k: int, shift: int = 0):
        return ratio(lag_n(c, shift, by, time) if shift else F.col(c), lag_n(c, k + shift, by, time)) - 1

    mean_assets = rolling("assets", 4, "avg", 1, by, time)
    out = grid.select(
        by, time,
        growth("assets", 4).alias("asset_growth"),
        growth("revenue", 4).alias("revenue_growth"),
        growth("shareswa", 4).alias("shareswa_growth"),
        ratio(diff("capex", 4, 1, by, time), mean_assets).alias("delta_capex"),
        ratio(diff("inventory", 4, 1, by, time), mean_assets).alias("delta_inventory"),
        growth("revenue", 1).alias("revenue_growth_qoq"),
        growth("revenue", 1, 1).alias("future_revenue_growth_qoq"),
        growth("assets", 1).alias("asset_growth_qoq"),
        growth("assets", 1, 1).alias("future_asset_growth_qoq"),
    )
    return out.dropna("all", subset=[c for c in out.columns if c not in keys])


def turnover_vol(daily: DataFrame, n: int = 21, key: str = KEY) -> DataFrame:
    """Deviation of turnover over n grid rows, moved down one row."""
    grid = densify(daily, by=key, cols=["turnover"], lead_in=False)
    moved = grid.select(TIME, key, rolling("turnover", n, "std", by=key, shift=1).alias("std_turn"))
    return moved.where(F.col("std_turn").isNotNull())


def raw_prices(prices: DataFrame, factors: DataFrame, shift: int = 1) -> DataFrame:
    """Unadjusted close (missing factor as 1), moved down one row of the security."""
    joined = prices.select(TIME, KEY, "close").join(factors.select(TIME, KEY, "split_div_factor"), [TIME, KEY], "left")
    raw = joined.withColumn("_raw", F.col("close") * F.coalesce("split_div_factor", F.lit(1.0)))
    return raw.select(TIME, KEY, lag_n("_raw", shift).alias("raw_close_price")) if shift else raw.select(
        TIME, KEY, F.col("_raw").alias("raw_close_price")
    )


__all__ = [
    "clean_filings", "filings_asof", "filled_on", "fundamental_growth", "fundamental_ratios", "last_per_quarter",
    "market_cap", "pct_change", "raw_prices", "turnover_vol", "weekdays", "Window",
]
