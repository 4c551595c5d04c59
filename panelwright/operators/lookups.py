"""Parameterised lookups over the security master, signals and attributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.columns import KEY, TIME, ratio
from panelwright.operators.picks import latest

ID = "dcm_security_id"


def _listed(values) -> list:
    if isinstance(values, (str, int)):
        return [values]
    if isinstance(values, (list, tuple)):
        return list(values)
    raise TypeError(f"expected one value or a list, got {type(values).__name__}")


def ids_of(master: DataFrame, tickers: str | Sequence[str]) -> DataFrame:
    return master.where(F.col("ticker").isin(_listed(tickers))).select("ticker", ID)


def tickers_of(master: DataFrame, ids: int | Sequence[int]) -> DataFrame:
    return master.where(F.col(ID).isin(_listed(ids))).select(ID, "ticker")


def describe(master: DataFrame, ids: int | Sequence[int], cols: Sequence[str] = ("Sector",)) -> DataFrame:
    return master.where(F.col(ID).isin(_listed(ids))).select(ID, "ticker", *cols).distinct()


def rows_of(df: DataFrame, ids: int | Sequence[int], cols: Sequence[str] | None = None, key: str = KEY) -> DataFrame:
    kept = df.where(F.col(key).isin(_listed(ids)))
    return kept.select(*cols) if cols else kept


def latest_signals(signals: DataFrame, ids: int | Sequence[int] | None = None, bucket: str = "ensemble_qt") -> DataFrame:
    kept = signals if ids is None else rows_of(signals, ids)
    return latest(kept).select(KEY, bucket)


def peers(master: DataFrame, ids: int | Sequence[int], include_self: bool = True, group: str = "Sector") -> DataFrame:
    """Securities in the group of each asked security."""
    asked = master.where(F.col(ID).isin(_listed(ids))).select(F.col(ID).alias("asked_id"), group)
    members = master.join(F.broadcast(asked), group)  # one row per asked id
    return members if include_self else members.where(F.col(ID) != F.col("asked_id"))


def peer_means(df: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    """Mean of each column over the other members of the group, without forming pairs."""
    sums = df.groupBy(group).agg(
        *[F.sum(c).alias(f"_s_{c}") for c in cols], *[F.count(c).alias(f"_n_{c}") for c in cols]
    )
    joined = df.join(sums, group)
    out = joined
    for c in cols:
        present = F.col(c).isNotNull().cast("int")
        rest = ratio(F.col(f"_s_{c}") - F.coalesce(F.col(c), F.lit(0.0)), F.col(f"_n_{c}") - present)
        out = out.withColumn(f"peer_{c}", rest).withColumn("n_peers", F.col(f"_n_{c}") - present)
    return out.drop(*[f"_{p}_{c}" for p in "sn" for c in cols])


def sector_cohort(df: DataFrame, master: DataFrame, ids: int | Sequence[int]) -> DataFrame:
    """Rows of all securities whose sector is the sector of one of the given ids."""
    sectors = master.where(F.col(ID).isin(_listed(ids))).select("Sector").distinct()
    members = master.join(sectors, "Sector", "left_semi").select(F.col(ID).alias(KEY))
    return df.join(members, KEY, "left_semi")


def attribution_of(first: DataFrame, second: DataFrame, ids: int | Sequence[int], distinct: bool = True) -> DataFrame:
    """Rows of the ids in two attribution tables."""
    both = rows_of(first, ids).unionByName(rows_of(second, ids))
    return both.distinct() if distinct else both


def tickers_on(df: DataFrame, day: str, key: str = KEY, time: str = TIME) -> DataFrame:
    return df.where(F.to_date(time) == F.lit(day).cast("date")).select(key).distinct()


def top_by_signal(signals: DataFrame, day: str, signal: int, n: int = 10, ret: str = "future_ret_5B") -> DataFrame:
    """The n rows with the best later return on a date among one signal."""
    rows = signals.where((F.col(TIME) == F.lit(day).cast("date")) & (F.col("ensemble_qt") == signal))
    return rows.orderBy(F.desc_nulls_last(ret), KEY).limit(n)
