"""Joins against small tables, broadcast only behind a proven bound on their size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CALENDAR_DAYS = 22_280  # 1990-01-01 .. 2050-12-31
BROADCAST_BYTES = 128 * 1024 * 1024
ROW_OVERHEAD = 64  # bytes a row of a hash relation takes beside its values
_DAYS = ("date", "month", "fq")
_BOUNDED = {
    "date": CALENDAR_DAYS,
    "month": CALENDAR_DAYS // 30 + 1,
    "fq": CALENDAR_DAYS // 90 + 1,
    "_all": 1,
    "mode": 4,
}


def require_day(df: DataFrame, col: str) -> None:
    """Only a calendar day bounds a table of distinct times; finer times could fill one task."""
    kind = df.schema[col].dataType.simpleString()
    if kind != "date":
        raise ValueError(f"column {col} must be a date, not {kind}: cast it to days or give keys to split by")


def day_like(df: DataFrame, key: str) -> bool:
    """False for a key that is a time, or is named as one, without being a date."""
    kind = df.schema[key].dataType.simpleString()
    return kind == "date" or not (key in _DAYS or kind.startswith("timestamp"))


PIECE = 400_000  # rows of a scan whose days are filled in, or whose windows are wide, in one task


def pieces(scan: DataFrame) -> int:
    """Partitions for rows of a scan that grow after their exchange: in proportion to the rows, the session's parallelism at least.

    Given to ``repartition`` as a number, it is not lowered by the size of the rows before they grow.
    """
    return max(scan.sparkSession.sparkContext.defaultParallelism, -(-scan.count() // PIECE))


def bounded_by_dates(keys: Sequence[str]) -> int | None:
    """Largest number of key combinations, or None if a key has no fixed domain."""
    rows = 1
    for key in keys:
        if key not in _BOUNDED:
            return None
        rows *= _BOUNDED[key]
    return rows


def attach(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_rows: int | None = None,
    width: int | None = None,
) -> DataFrame:
    """Join; the right side is broadcast when ``max_rows`` proves it fits, else Spark chooses.

    Keys that are times prove nothing unless they are calendar days by their type.

    The statistics of a whole table (key ``_all``) are one row, attached as a scalar subquery.
    """
    if list(on) == ["_all"]:
        cols = [c for c in right.columns if c != "_all"]
        whole = right.select(F.struct(*cols).alias("_stats")).scalar()
        return left.withColumn("_stats", whole).select(*left.columns, *[F.col(f"_stats.`{c}`").alias(c) for c in cols])
    if max_rows is not None and all(day_like(right, key) for key in on):
        row_bytes = (width or 16 * len(right.columns)) + ROW_OVERHEAD
        if max_rows * row_bytes <= BROADCAST_BYTES:
            right = F.broadcast(right)
    return left.join(right, list(on), how)
