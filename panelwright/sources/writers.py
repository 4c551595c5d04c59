"""Sinks: named tables, appends behind a high-water mark, full refresh, nested rows as JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators.joins import lookup


def write_tables(
    tables: dict[str, DataFrame],
    base: str,
    format: str = "parquet",
    shards: int | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """One folder per named table; ``shards`` fixes the number of files."""
    for name, df in tables.items():
        out = df.repartition(shards) if shards else df
        writer = out.write.mode("overwrite").format(format)
        if format == "csv":
            writer = writer.option("header", "true")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(f"{base}/{name}")


def overwrite_table(df: DataFrame, target: str, format: str = "parquet") -> None:
    df.write.mode("overwrite").format(format).save(target)


def new_rows(df: DataFrame, written: DataFrame | None, master: DataFrame, mark: str = "date") -> DataFrame:
    """Rows after the high-water mark of a target, with known ids."""
    known = lookup(df.where(F.col("ticker").isNotNull()), master, "ticker", "inner", ["dcm_security_id"])
    if written is None:
        return known
    high = written.agg(F.max(mark)).scalar()
    return known.where(high.isNull() | (F.col(mark) > high))


def append_new(
    spark: SparkSession, df: DataFrame, target: str, master: DataFrame, mark: str = "date"
) -> None:
    """Append the rows a Parquet target does not hold yet."""
    try:
        written = spark.read.parquet(target)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        written = None  # no target yet
    new_rows(df, written, master, mark).write.mode("append").parquet(target)


PART = "_part"


def read_days(spark: SparkSession, target: str) -> DataFrame:
    """A table that :func:`append_days` keeps."""
    return spark.read.parquet(target).drop(PART)


def append_days(spark: SparkSession, df: DataFrame, target: str, master: DataFrame, mark: str = "date", unit: str = "day") -> None:
    """Append by whole days (or another ``unit`` of date_trunc), so that a delivery can be written again.

    Rows before the day of the high-water mark are known; that day and later ones are
    written anew, from what the table holds of them and the delivered rows it lacks (a row
    delivered n times is there n times).  A repeated delivery thus changes nothing, and
    late rows of the mark's own day get in.  Days are replaced when the job commits, all or
    none of them as far as the store's committer can; a failed one can simply run again.
    """
    known = lookup(df.where(F.col("ticker").isNotNull()), master, "ticker", "inner", ["dcm_security_id"]).withColumn(PART, F.to_date(F.date_trunc(unit, mark)))
    fresh = known
    try:
        held = spark.read.parquet(target).select(*known.columns)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise  # no target yet, or one without a day
    else:
        high = held.agg(F.max(PART)).scalar()
        late = known.where(high.isNull() | (F.col(PART) >= high))
        there = held.where(F.col(PART) >= high)
        fresh = there.unionByName(late.exceptAll(there))
    # a day may be large, so its rows are not forced into one task; Spark splits and merges to files of even size
    fresh.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(target)


def as_json(df: DataFrame, cols: Sequence[str] | None = None, out: str = "json") -> DataFrame:
    """Row as nested text: every leaf value is written as a string."""
    cols = list(cols or df.columns)
    text = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in cols]))
    return df.select(*[c for c in df.columns if c not in cols], text.alias(out))
