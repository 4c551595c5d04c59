"""Cross-sectional transforms: standardize, neutralize, populations, folds, activity."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.columns import KEY, TIME, clip, ratio
from panelwright.operators.grid import densify, numbered_days, with_universe
from panelwright.operators.joins import asof_join
from panelwright.operators.order_stats import fill_median, winsorize, with_quantiles
from panelwright.operators.sizes import CALENDAR_DAYS, attach, bounded_by_dates
from panelwright.session import durable


def with_moments(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (TIME,)) -> DataFrame:
    """Rows with ``m_<col>`` (mean) and ``s_<col>`` (sample deviation) of their group."""
    keys = list(by) or ["_all"]
    frame = df if by else df.withColumn("_all", F.lit(0))
    stats = frame.groupBy(*keys).agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]
    )
    return attach(frame, stats, keys, max_rows=bounded_by_dates(keys), width=16 * len(cols)).drop("_all")


def zscore(c: str) -> Column:
    """Standard score; a constant or single-row group and a missing value give 0."""
    return F.coalesce(ratio(F.col(c) - F.col(f"m_{c}"), f"s_{c}"), F.lit(0.0))


def feature_columns(
    df: DataFrame, targets: Sequence[str] = (), exclude: Sequence[str] = (), suffixes: Sequence[str] = (),
    keys: Sequence[str] = (TIME, KEY),
) -> list[str]:
    """All columns but keys, targets, exclusions and those with an excluded suffix."""
    skip = {*targets, *exclude, *keys}
    return [c for c in df.columns if c not in skip and not c.endswith(tuple(suffixes) or ("\0",))]


def standardize(
    df: DataFrame,
    features: Sequence[str] | bool = True,
    targets: Sequence[str] = (),
    exclude: Sequence[str] = (),
    suffixes: Sequence[str] = (),
    by: Sequence[str] = (TIME,),
    alpha: float = 0.01,
) -> DataFrame:
    """Clip each column at its tails, then score it within the date.

    Targets stay clipped under their own name and get a scored ``<name>_std``;
    excluded columns pass through.
    """
    if features is True:
        features = feature_columns(df, targets, exclude, suffixes)
    features, targets = list(features), [t for t in targets if t in df.columns]
    clipped = winsorize(df, [*features, *targets], by, alpha)
    scored = with_moments(clipped, [*features, *targets], by)
    out = scored.withColumns({**{f"{t}_std": zscore(t) for t in targets}})
    out = out.withColumns({c: zscore(c) for c in features})
    return out.drop(*[f"{p}_{c}" for p in "ms" for c in [*features, *targets]])


def standardize_all(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Score columns over the whole history."""
    scored = with_moments(df, cols, ())
    out = scored.withColumns({c: ratio(F.col(c) - F.col(f"m_{c}"), f"s_{c}") for c in cols})
    return out.drop(*[f"{p}_{c}" for p in "ms" for c in cols])


def demean(df: DataFrame, col: str, by: Sequence[str], out: str) -> DataFrame:
    """Value minus the mean of its group."""
    means = df.groupBy(*by).agg(F.avg(col).alias("_mean"))
    return attach(df, means, by, max_rows=bounded_by_dates(by)).withColumn(out, F.col(col) - F.col("_mean")).drop("_mean")


def neutralize(
    df: DataFrame,
    factors: Sequence[str],
    exclude: Sequence[str] = (),
    by: str = TIME,
    keys: Sequence[str] = (TIME, KEY),
) -> DataFrame:
    """Residual of every remaining column after a regression with intercept on the factors, per date.

    Missing values take the date's median first; a factor without any value on a
    date is left out of that date's regression.  The normal equations need only
    sums of products, which are added up before the exchange; one small system
    per date is solved, and the residual is a plain column expression.
    """
    factors = [f for f in factors if f in df.columns]
    responses = [
        c for c in df.columns
        if c not in factors and c not in exclude and c not in keys and not c.startswith("future_")
        and c not in ("Sector", "IndustryGroup")
    ]
    filled = durable(fill_median(df, [*factors, *responses], [by]))
    means = filled.groupBy(by).agg(*[F.avg(c).alias(f"m_{c}") for c in [*factors, *responses]])
    days = bounded_by_dates([by])
    centred = attach(filled, means, [by], max_rows=days, width=8 * (len(factors) + len(responses)))

    def dev(c: str) -> Column:
        away = F.col(c) - F.col(f"m_{c}")
        return F.coalesce(away, F.lit(0.0)) if c in factors else away

    k = len(factors)
    gram = [F.sum(dev(factors[i]) * dev(factors[j])).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]
    cross = [F.sum(dev(f) * dev(y)).alias(f"c{i}_{j}") for i, f in enumerate(factors) for j, y in enumerate(responses)]
    sums = centred.groupBy(by).agg(*gram, *cross)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    m = len(responses)

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            a = np.zeros((len(pdf), k, k))
            for i, j in pairs:
                a[:, i, j] = a[:, j, i] = pdf[f"g{i}_{j}"].to_numpy(float)
            b = np.zeros((len(pdf), k, m))
            for i in range(k):
                for j in range(m):
                    b[:, i, j] = pdf[f"c{i}_{j}"].to_numpy(float)
            ok = np.isfinite(a).all(axis=(1, 2))
            a[~ok] = 0.0
            # scale to unit diagonal before the pseudo-inverse, so that mixed units keep their rank
            d = np.sqrt(np.einsum("nii->ni", a))
            inv = np.divide(1.0, d, out=np.zeros_like(d), where=d > 0)
            scaled = a * inv[:, :, None] * inv[:, None, :]
            beta = inv[:, :, None] * (np.linalg.pinv(scaled, hermitian=True) @ (b * inv[:, :, None]))
            yield pd.DataFrame({by: pdf[by], "beta": [x.ravel() for x in beta]})

    kind = df.schema[by].dataType.simpleString()
    betas = sums.mapInPandas(solve, f"`{by}` {kind}, beta array<double>")
    solved = attach(centred, betas, [by], max_rows=days, width=8 * k * m)
    residuals = {}
    for j, y in enumerate(responses):
        fit = F.lit(0.0)
        for i, f in enumerate(factors):
            fit = fit + F.col("beta")[i * m + j] * dev(f)
        residuals[y] = dev(y) - fit
    return solved.withColumns(residuals).select(*df.columns)


def factor_target(df: DataFrame, ret: str = "future_return_bme", factor: str = "f_t") -> DataFrame:
    """Return after the factor, in percent, and its score within the date (not clipped)."""
    scaled = df.withColumn("future_return_RF", F.col(ret) * F.col(factor)).withColumn(
        "future_return_RF_100", F.col("future_return_RF") * 100.0
    )
    scored = with_moments(scaled, ["future_return_RF_100"])
    return scored.withColumn("future_return_RF_100_std", zscore("future_return_RF_100")).drop(
        "m_future_return_RF_100", "s_future_return_RF_100"
    )


def fill_membership(
    membership: DataFrame, days: DataFrame, weights: Sequence[str] = ("wt-r1", "wt-r1g", "wt-r1v"),
    limit: int = 5, key: str = "cusip",
) -> DataFrame:
    """Index weights on the union of their own days and ``days``.

    A member stays at most ``limit`` days after its last whole-index weight; its
    other columns are then filled without limit.
    """
    timeline = membership.select(TIME).union(days.select(TIME)).distinct()
    others = [c for c in membership.columns if c not in (key, TIME)]
    grid = densify(membership, timeline, key, lead_in=False, reach=limit)  # rows further on would not be kept
    near = Window.partitionBy(key).orderBy(TIME).rowsBetween(-limit, 0)
    kept = grid.withColumn("_in", F.last(weights[0], ignorenulls=True).over(near)).where(F.col("_in").isNotNull())
    far = Window.partitionBy(key).orderBy(TIME).rowsBetween(Window.unboundedPreceding, 0)
    return kept.select(TIME, key, *[F.last(c, ignorenulls=True).over(far).alias(c) for c in others])


def universe(
    df: DataFrame, membership: DataFrame, caps: DataFrame | str, default_cap: float = 2e9,
    weights: Sequence[str] = ("wt-r1", "wt-r1g", "wt-r1v"), limit: int = 5,
) -> DataFrame:
    """Panel with index weights (missing as 0) and market cap (missing as the default).

    ``caps`` is a table (date, ticker, marketcap) or a column of the panel.
    """
    filled = fill_membership(membership, df, weights, limit)
    side = filled.select(TIME, F.col("dcm_security_id").alias(KEY), *weights)
    if isinstance(caps, str):
        own_cols = [c for c in df.columns if c != caps]
        joined = df.select(*own_cols, F.col(caps).alias("marketcap")).join(side, [TIME, KEY], "left").fillna(0.0, list(weights))
        return joined.select(*own_cols, *weights, "marketcap").fillna(default_cap, ["marketcap"])
    joined = df.join(side, [TIME, KEY], "left").fillna(0.0, list(weights))
    return joined.join(caps.select(TIME, KEY, "marketcap"), [TIME, KEY], "left").fillna(default_cap, ["marketcap"])


# Population -> (weight column, needs a large cap).
MODES = {
    "growth": ("wt-r1g", False),
    "value": ("wt-r1v", False),
    "largecap_growth": ("wt-r1g", True),
    "largecap_value": ("wt-r1v", True),
}


def split_population(
    univ: DataFrame,
    modes: Sequence[str] = tuple(MODES),
    largecap_quantile: float = 0.25,
    carry_after: str = "2023-03-06",
) -> DataFrame:
    """Populations by style weight and size, one row per (mode, date, security).

    Rows after ``carry_after`` also belong to a population their security was in before.
    """
    framed = durable(with_quantiles(univ, ["marketcap"], [1 - largecap_quantile]))
    large = F.col("marketcap") > F.element_at("q_marketcap", 1)

    def inside(mode: str) -> Column:
        weight, needs_large = MODES[mode]
        return (F.col(weight) > 0) & large if needs_large else F.col(weight) > 0

    # a row for each security and its days meets what the security was in before; rows open to the modes they belong to after that
    modes = list(modes)
    held = framed.withColumn("_in", F.array(*[F.coalesce(inside(m), F.lit(False)) for m in modes]))
    seen = held.groupBy(KEY).agg(F.array(*[F.max(F.col("_in")[i]) for i in range(len(modes))]).alias("_seen"))
    late = F.coalesce(F.col(TIME) > F.lit(carry_after).cast("date"), F.lit(False))
    belongs = [F.col("_in")[i] | (late & F.coalesce(F.col("_seen")[i], F.lit(False))) for i in range(len(modes))]
    tags = F.filter(F.array(*[F.when(x, F.lit(m)) for m, x in zip(modes, belongs)]), lambda m: m.isNotNull())
    kept = held.join(seen, KEY, "left").select(*univ.columns, F.explode(tags).alias("mode"))
    return kept.dropDuplicates(["mode", TIME, KEY])


def price_cap_floor(
    df: DataFrame, raw_prices: DataFrame, caps: DataFrame, price_limit: float, cap_limit: float, default_cap: float = 2e9
) -> DataFrame:
    """Rows whose raw price and market cap reach the limits; an unknown cap takes the default."""
    joined = df.join(raw_prices.select(TIME, KEY, "raw_close_price"), [TIME, KEY], "left").join(
        caps.select(TIME, KEY, F.col("marketcap").alias("_cap")), [TIME, KEY], "left"
    )
    cap = F.coalesce("_cap", F.lit(default_cap))
    return joined.where((cap >= cap_limit) & (F.col("raw_close_price") >= price_limit)).select(*df.columns)


def fold_by_cuts(df: DataFrame, cuts: Sequence[str], right: bool = True, out: str = "fold_id", time: str = TIME) -> DataFrame:
    """Number of cut days passed: intervals (a, b] by default, [a, b) with ``right=False``."""
    days = [F.lit(c).cast("date") for c in sorted(cuts)]
    passed = [F.when(F.col(time) > c if right else F.col(time) >= c, 1).otherwise(0) for c in days]
    fold = sum(passed[1:], passed[0])
    return df.withColumn(out, fold.cast("int"))


def insample(df: DataFrame, year: int, month: int, n_dates: int = 106, folds: int = 5) -> DataFrame:
    """The n dates ending at the first date of a month, in equal-width time bins ``fold_id``."""
    days = numbered_days(df)
    wanted = (F.year(TIME) == year) & (F.month(TIME) == month)
    last = days.where(wanted).agg(F.min("_seq")).scalar()
    first_from = last - n_dates
    kept = days.where((F.col("_seq") <= last) & (F.col("_seq") > first_from))
    span = Window.partitionBy(F.lit(0))
    low = F.unix_date(F.min(TIME).over(span))
    high = F.unix_date(F.max(TIME).over(span))
    place = F.ceil(ratio((F.unix_date(TIME) - low) * folds, high - low)) - 1
    binned = kept.select(TIME, F.greatest(F.coalesce(place, F.lit(0)), F.lit(0)).cast("int").alias("fold_id"))
    return df.drop("fold_id").join(F.broadcast(binned), TIME)


def activity(
    df: DataFrame, tickers: DataFrame, ref_col: str, start: str | None = None, end: str | None = None, eps: float = 0.0
) -> DataFrame:
    """1 where a security has a reference return different from 0 (beyond ``eps``), else 0."""
    rows = df.join(tickers.select(KEY).distinct(), KEY, "left_semi").select(TIME, KEY, ref_col)
    grid = with_universe(densify(rows), tickers)
    on = F.coalesce(F.abs(ref_col) > eps, F.lit(False))
    out = grid.select(TIME, KEY, F.when(on, 1).otherwise(0).alias("is_active"))
    if start is not None:
        out = out.where(F.col(TIME) >= F.lit(start).cast("date"))
    if end is not None:
        out = out.where(F.col(TIME) <= F.lit(end).cast("date"))
    return out


def activity_weights(active: DataFrame) -> DataFrame:
    """Per security 1 / active dates and active dates / dates, infinities as 0."""
    days = active.agg(F.countDistinct(TIME)).scalar()
    return active.groupBy(KEY).agg(F.sum("is_active").alias("n_active")).select(
        KEY,
        "n_active",
        F.coalesce(ratio(F.lit(1.0), "n_active"), F.lit(0.0)).alias("per_moment"),
        F.coalesce(ratio("n_active", days), F.lit(0.0)).alias("per_company"),
    )


def group_means(df: DataFrame, master: DataFrame, group: str, cols: Sequence[str], id_col: str = "dcm_security_id") -> DataFrame:
    """Mean of columns per (date, group of the security)."""
    side = master.select(F.col(id_col).alias(KEY), F.col(group))
    joined = df.join(side, KEY, "left")
    return joined.groupBy(TIME, F.coalesce(F.col(group), F.lit("nan")).alias(group)).agg(*[F.avg(c).alias(c) for c in cols])


def spread_groups(df: DataFrame, group: str, values: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Group averages as columns ``<col>_<group without spaces>``, one row per date."""
    picks = [
        F.max(F.when(F.col(group) == v, F.col(c))).alias(f"{c}_{v.replace(' ', '')}") for v in values for c in cols
    ]
    return df.groupBy(TIME).agg(*picks)


def attach_group_means(
    df: DataFrame, means: DataFrame, master: DataFrame, group: str, cols: Sequence[str], suffix: str = "_indgrp",
    id_col: str = "dcm_security_id",
) -> DataFrame:
    """Group averages attached to the members as ``<col><suffix>``."""
    side = master.select(F.col(id_col).alias(KEY), F.col(group))
    renamed = means.select(TIME, group, *[F.col(c).alias(f"{c}{suffix}") for c in cols])
    return df.join(side, KEY, "left").join(renamed, [TIME, group], "left")


def attach_macro(df: DataFrame, macro: DataFrame) -> DataFrame:
    """Date-level macro table joined to the panel; rows of one day count as one, of each column the greatest value."""
    cols = [c for c in macro.columns if c != TIME]
    macro = macro.groupBy(TIME).agg(*[F.max(c).alias(c) for c in cols]) if cols else macro.distinct()
    return attach(df, macro, [TIME], max_rows=CALENDAR_DAYS, width=8 * len(macro.columns))


def attach_factors(df: DataFrame, factors: DataFrame, asof: bool = False) -> DataFrame:
    """Factor series joined by date, exactly or as of the date; then filled forward and missing as 0."""
    cols = [c for c in factors.columns if c != TIME]
    if not asof:
        return attach_macro(df, factors).fillna(0.0, cols)
    filled = factors.select(
        TIME,
        *[F.last(c, ignorenulls=True).over(Window.orderBy(TIME).rowsBetween(Window.unboundedPreceding, 0)).alias(c) for c in cols],
    )
    return asof_join(df, filled, TIME).fillna(0.0, cols)


__all__ = [name for name in dir() if not name.startswith("_")]
