"""Macro tables: one row per day, so ordered windows over the whole table stay small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.columns import TIME, finite, ratio
from panelwright.operators.joins import asof_days


def _series(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != TIME]


def rolling_all(df: DataFrame, n: int = 5) -> DataFrame:
    """Moving average of every column over n rows."""
    w = Window.orderBy(TIME).rowsBetween(-(n - 1), 0)
    return df.select(TIME, *[F.when(F.count(c).over(w) == n, F.avg(c).over(w)).alias(c) for c in _series(df)])


def _coded(c: str, code: int):
    w = Window.orderBy(TIME)
    x, one, two = F.col(c), F.lag(c, 1).over(w), F.lag(c, 2).over(w)
    if code == 2:
        return x - one
    if code == 3:
        return (x - one) - (one - two)
    if code == 4:
        return F.ln(x)
    if code == 5:
        return F.ln(x) - F.ln(one)
    if code == 6:
        return (F.ln(x) - F.ln(one)) - (F.ln(one) - F.ln(two))
    if code == 7:
        return (ratio(x, one) - 1) - (ratio(one, two) - 1)
    return x


def drop_head(df: DataFrame, k: int, time: str = TIME) -> DataFrame:
    """All rows of a date-level table but its first k."""
    return df.withColumn("_rn", F.row_number().over(Window.orderBy(time))).where(F.col("_rn") > k).drop("_rn")


def at_dates(df: DataFrame, dates: DataFrame, lag: int = 0, lag_unit: str = "month") -> DataFrame:
    """Rows of the sampling days filled forward; the lag counts rows before (day) or after (month) sampling."""
    w = Window.orderBy(TIME)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    cols = _series(df)
    if lag and lag_unit == "day":
        df = df.select(TIME, *[F.lag(c, lag).over(w).alias(c) for c in cols])
    kept = df.join(F.broadcast(dates.select(TIME)), TIME, "left_semi")
    kept = kept.select(TIME, *[F.last(c, ignorenulls=True).over(upto).alias(c) for c in cols])
    if lag and lag_unit != "day":
        kept = kept.select(TIME, *[F.lag(c, lag).over(w).alias(c) for c in cols])
    return kept


def transform_macro(
    macro: DataFrame, etf: DataFrame, codes: dict[str, int], dates: DataFrame, lag: int = 0, lag_unit: str = "month", head: int = 2
) -> DataFrame:
    """Sampled macro and symbol series transformed by their catalogue code, without the first rows."""
    def coded(df: DataFrame) -> DataFrame:
        rows = at_dates(df, dates, lag, lag_unit)
        return rows.select(TIME, *[_coded(c, codes.get(c, 1)).alias(c) for c in _series(df)])

    left, right = coded(macro), coded(etf)
    return drop_head(left.join(right, TIME), head)


def to_weeks(monthly: DataFrame, weeks: DataFrame) -> DataFrame:
    """Latest monthly row at or before each week."""
    return asof_days(weeks, monthly).drop("_at")


def macro_columns(
    econ: DataFrame, spread: DataFrame, drop: Sequence[str] = (), start: str | None = None
) -> DataFrame:
    """Macro table with the group averages, unwanted columns dropped, infinities and gaps as 0."""
    rows = econ if start is None else econ.where(F.col(TIME) >= F.lit(start).cast("date"))
    joined = rows.join(spread, TIME, "left").drop(*drop)
    cols = [c for c in joined.columns if c != TIME]
    return finite(joined, cols, 0.0).fillna(0.0, cols)
