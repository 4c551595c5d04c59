"""Dense (date x security) grids and reshaping, without a cross join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.columns import KEY, TIME, own
from panelwright.operators.sizes import require_day


def numbered_days(df: DataFrame, time: str = TIME) -> DataFrame:
    """Distinct days with their position; at most one row per calendar day."""
    require_day(df, time)
    order = Window.orderBy(time)
    days = df.select(time).where(F.col(time).isNotNull()).distinct()
    return days.select(
        time,
        F.row_number().over(order).alias("_seq"),
        F.count(F.lit(1)).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .cast("int")
        .alias("_last"),
    )


def densify(
    df: DataFrame,
    dates: DataFrame | None = None,
    by: str = KEY,
    time: str = TIME,
    lead_in: bool = True,
    cols: Sequence[str] | None = None,
    undated: bool = False,
    reach: int | None = None,
) -> DataFrame:
    """Every security on every day of the grid, missing values as null.

    Each row opens the cells up to the next row of its security, so the grid is
    produced by one pass over the securities and stays partitioned by them for
    the windows that follow.  Input: one row per (date, security); repeated rows
    are all kept, and add no empty cells.  Rows off a given grid are dropped.  ``lead_in=False`` leaves out the empty cells before
    the first row of a security.  ``undated`` keeps rows without a day of the grid, their day null.
    ``reach`` opens no more than so many empty cells after a row, for fills that go no further.
    """
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in (by, time)]
    days = numbered_days(dates if dates is not None else df, time)
    # days are in the order of their numbers, and bars come in it; of an undated frame only the days of the grid have one
    w = own(by, "_seq" if undated and dates is not None else time)
    placed = (
        df.select(by, time, *cols)
        .join(F.broadcast(days), time, "left" if undated else "inner")
        .withColumn("_first", F.lag("_seq").over(w).isNull() if lead_in else F.lit(False))
        .withColumn("_upto", F.greatest(F.coalesce(F.lead("_seq").over(w) - 1, F.col("_last")), "_seq"))
    )
    if reach is not None:
        placed = placed.withColumn("_upto", F.least("_upto", F.col("_seq") + F.lit(reach)))
    start = F.when(F.col("_first"), F.lit(1)).otherwise(F.col("_seq"))
    opened = F.sequence(start, F.col("_upto"))
    if undated:
        opened = F.when(F.col("_seq").isNull(), F.array(F.lit(None).cast("int"))).otherwise(opened)
    cells = placed.withColumn("_cell", F.explode(opened))
    present = F.col("_cell").eqNullSafe(F.col("_seq"))
    filled = cells.select(by, "_cell", *[F.when(present, F.col(c)).alias(c) for c in cols])
    back = days.select(F.col("_seq").alias("_cell"), time)
    return filled.join(F.broadcast(back), "_cell", "left" if undated else "inner").select(time, by, *cols)


def with_universe(grid: DataFrame, universe: DataFrame, by: str = KEY, time: str = TIME) -> DataFrame:
    """Add the securities of ``universe`` that the grid lacks, empty on every day of the grid."""
    missing = universe.select(by).distinct().join(grid.select(by).distinct(), by, "left_anti")
    days = grid.agg(F.collect_set(time).alias("d")).scalar()  # calendar days only
    empty = missing.select(by, F.explode(days).alias(time))
    return grid.unionByName(empty, allowMissingColumns=True)


def melt(df: DataFrame, keys: Sequence[str], cols: Sequence[str], name: str = "feature", value: str = "value") -> DataFrame:
    """Wide to long, one row per key and column."""
    return df.unpivot([*keys], list(cols), name, value)


def stacked(df: DataFrame, keys: Sequence[str], cols: Sequence[str], name: str = "feature", value: str = "value") -> DataFrame:
    """Wide to long without the empty cells."""
    return melt(df, keys, cols, name, value).where(F.col(value).isNotNull())


def widen(df: DataFrame, key: str | Sequence[str], name: str, values: Sequence, value: str) -> DataFrame:
    """Long to wide over a given list of column names; duplicates are averaged."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).pivot(name, list(values)).agg(F.avg(value))
