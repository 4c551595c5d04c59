"""Linear fits from sums of products: one pass over the rows for all folds, windows and penalties.

A group's moments are the sums of all products of (1, features, target).  They add up, so
the training rows of a fold are the total less the fold, and a window of dates is a sum
over date-level rows.  Least squares solves the centred moments; lasso and elastic net
run coordinate descent on them.  What is solved is as small as the features' number
squared and never grows with the rows.

Penalties count as in Spark ML: features and target are divided by their sample deviation
and the penalty by the target's; ``reg`` and ``alpha`` are its regParam and
elasticNetParam.  A feature without spread gets no weight.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.columns import KEY, TIME
from panelwright.operators.sizes import CALENDAR_DAYS, attach, require_day

ROUNDS, TOLERANCE = 10_000, 1e-13


def _names(p: int) -> list[str]:
    return [f"_s{i}_{j}" for i in range(p + 2) for j in range(i, p + 2)]


def moments(df: DataFrame, features: Sequence[str], target: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per group: sums of all products of (1, features, target), nulls as zero."""
    parts = [F.lit(1.0), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in (*features, target)]]
    sums = [F.sum(parts[i] * parts[j]).alias(f"_s{i}_{j}") for i in range(len(parts)) for j in range(i, len(parts))]
    return df.groupBy(*by).agg(*sums)


def _matrix(row: np.ndarray, p: int) -> np.ndarray:
    out = np.zeros((p + 2, p + 2))
    out[np.triu_indices(p + 2)] = row
    return out + np.triu(out, 1).T


def solve(m: np.ndarray, reg: float = 0.0, alpha: float = 1.0) -> np.ndarray:
    """Intercept and coefficients from a moment matrix; nan where there are no rows."""
    n = m[0, 0]
    if n < 1:
        return np.full(len(m) - 1, np.nan)
    mean = m[0, 1:] / n
    spread = m[1:, 1:] - n * np.outer(mean, mean)
    size = np.sqrt(np.maximum(np.diag(spread), 0) / max(n - 1, 1))
    size[np.diag(spread) <= 1e-12 * np.diag(m)[1:]] = 0  # rounding, not spread
    used = np.flatnonzero(size[:-1] > 0)
    b = np.zeros(len(mean) - 1)
    if len(used) and size[-1] > 0:
        scaled = spread[np.ix_([*used, -1], [*used, -1])] / np.outer(size[[*used, -1]], size[[*used, -1]]) / n
        g, c = scaled[:-1, :-1], scaled[:-1, -1]
        b[used] = (np.linalg.lstsq(g, c, rcond=1e-12)[0] if reg == 0 else _descend(g, c, reg / size[-1], alpha)) * size[-1] / size[used]
    return np.append(mean[-1] - b @ mean[:-1], b)


def _descend(g: np.ndarray, c: np.ndarray, reg: float, alpha: float) -> np.ndarray:
    b, least, ridge = np.zeros(len(c)), reg * alpha, reg * (1 - alpha)
    for _ in range(ROUNDS):
        moved = 0.0
        for j in range(len(c)):
            left = c[j] - g[j] @ b + g[j, j] * b[j]
            new = np.sign(left) * max(abs(left) - least, 0) / (g[j, j] + ridge)
            moved, b[j] = max(moved, abs(new - b[j])), new
        if moved < TOLERANCE:
            break
    return b


def r2(m: np.ndarray, b: np.ndarray) -> float:
    """R2 of coefficients on the rows a moment matrix was summed over."""
    total = m[-1, -1] - m[0, -1] ** 2 / m[0, 0] if m[0, 0] else 0.0
    with_target = np.append(b, -1.0)
    return float(1 - with_target @ m @ with_target / total) if total > 0 else float("nan")


def _solved(p: int, keep: Sequence[str], grid: Sequence[tuple[str, float, float]], held: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                m = _matrix(np.array([row[s] for s in _names(p)], float), p)
                for name, reg, alpha in grid:
                    b = solve(m, reg, alpha)
                    score = {"r2": r2(_matrix(np.array([row[f"{s}_own"] for s in _names(p)], float), p), b)} if held else {}
                    out.append({k: row[k] for k in keep} | {"algo": name, "reg": reg, "intercept": b[0], "weights": b[1:].tolist()} | score)
            yield pd.DataFrame(out, columns=[*keep, "algo", "reg", "intercept", "weights", *(["r2"] if held else [])])

    return run


def fits(sums: DataFrame, features: Sequence[str], keep: Sequence[str], grid: Sequence[tuple[str, float, float]], held: bool = False) -> DataFrame:
    """(keep, algo, reg, intercept, weights) for every row of moments and every (algo, reg, alpha)."""
    kinds = ", ".join(f"`{k}` {sums.schema[k].dataType.simpleString()}" for k in keep)
    schema = ", ".join(x for x in (kinds, "algo string, reg double, intercept double, weights array<double>", "r2 double" if held else "") if x)
    return sums.mapInPandas(_solved(len(features), keep, grid, held), schema)


def cross_validate(df: DataFrame, features: Sequence[str], target: str, fold_col: str, grid: Sequence[tuple[str, float, float]]) -> DataFrame:
    """One row per fold and (algo, reg, alpha): the fit on all other folds and its R2 on the fold."""
    names = _names(len(features))
    each = moments(df, features, target, [fold_col])  # one row a fold
    whole = each.agg(F.struct(*[F.sum(s).alias(s) for s in names]).alias("all")).scalar()
    both = each.withColumn("_all", whole)
    other = both.select(fold_col, *[(F.col(f"_all.{s}") - F.col(s)).alias(s) for s in names], *[F.col(s).alias(f"{s}_own") for s in names])
    return fits(other, features, [fold_col], grid, held=True)


def best_fit(df: DataFrame, features: Sequence[str], target: str, fold_col: str, grid: Sequence[tuple[str, float, float]]) -> DataFrame:
    """For each algo the fit on all rows with the penalty of the highest mean R2 over folds (ties: the smallest)."""
    tried = cross_validate(df, features, target, fold_col, grid).groupBy("algo", "reg").agg(F.avg("r2").alias("mean_r2"))
    first = tried.groupBy("algo").agg(F.min_by("reg", F.struct((-F.col("mean_r2")).alias("worst"), "reg")).alias("reg"))
    return fits(moments(df, features, target), features, [], grid).join(first, ["algo", "reg"])


def rolling_moments(df: DataFrame, features: Sequence[str], target: str, n_dates: int = 106) -> DataFrame:
    """One row per date: moments of its last ``n_dates`` dates, itself included."""
    require_day(df, TIME)
    upto = Window.orderBy(TIME).rowsBetween(1 - n_dates, 0)  # a row for each calendar day at most
    return moments(df, features, target, [TIME]).select(TIME, *[F.sum(s).over(upto).alias(s) for s in _names(len(features))])


def rolling_fits(df: DataFrame, features: Sequence[str], target: str, grid: Sequence[tuple[str, float, float]], n_dates: int = 106, periods: DataFrame | None = None) -> DataFrame:
    """(model_date, algo, ...): a fit for each month, or each month of ``periods``, on the dates up to its first date."""
    month = F.trunc(TIME, "month").alias("model_date")
    starts = df.groupBy(month).agg(F.min(TIME).alias(TIME))
    if periods is not None:
        starts = starts.join(periods.select("model_date").distinct(), "model_date", "left_semi")
    sums = rolling_moments(df, features, target, n_dates)
    return fits(attach(starts, sums, [TIME], "inner", max_rows=CALENDAR_DAYS, width=8 * len(sums.columns)).drop(TIME), features, ["model_date"], grid)


def score_with(features: Sequence[str], intercept: Column, weights: Column) -> Column:
    """Prediction of a linear fit; null features count as zero."""
    parts = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.get(weights, F.lit(i)) for i, c in enumerate(features)]
    return sum(parts, intercept)


def predict_rolling(df: DataFrame, fitted: DataFrame, features: Sequence[str], algos: Sequence[str]) -> DataFrame:
    """Each row scored by the fits of the last model date at or before its month (rows before the first by the first)."""
    wide = fitted.groupBy("model_date").agg(*[F.first(F.when(F.col("algo") == a, F.struct("intercept", "weights")), True).alias(a) for a in algos])
    # the fit in force in each month: a month has one row, so this is a calendar, not data
    months = df.select(F.trunc(TIME, "month").alias("_month")).distinct()
    both = months.select("_month", F.lit(None).cast("date").alias("model_date")).unionByName(wide.select(F.col("model_date").alias("_month"), "model_date"))
    upto = Window.orderBy("_month", F.col("model_date").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    first = wide.agg(F.min("model_date")).scalar()
    placed = both.withColumn("_use", F.coalesce(F.last("model_date", True).over(upto), first)).where(F.col("model_date").isNull())
    held = placed.select("_month", F.col("_use").alias("model_date")).join(wide, "model_date")
    rows = df.withColumn("_month", F.trunc(TIME, "month"))
    joined = attach(rows, held, ["_month"], max_rows=CALENDAR_DAYS // 28, width=16 * len(algos) * (len(features) + 2))
    return joined.select(TIME, KEY, "model_date", *[score_with(features, F.col(f"{a}.intercept"), F.col(f"{a}.weights")).alias(a) for a in algos])
