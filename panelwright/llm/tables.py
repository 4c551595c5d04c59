"""Tables by name, columns that travel beside an operator's own, written steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.session import durable

LAST_ID = 2**63 - 1


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame) -> DataFrame:
    """A small step's rows, written once below spark.checkpoint.dir; later reads don't depend on executors."""
    return durable(df)


def rest(df: DataFrame, *but: str) -> Column:
    """All columns but some as one struct, so that no name of the caller can clash with an operator's own."""
    names = [c for c in df.columns if c not in but]
    return F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(None).cast("int").alias("none"))


def put_back(df: DataFrame, columns: list[str], struct: str, new: dict[str, Column]) -> list[Column]:
    """The caller's columns in order, those in ``new`` replaced."""
    return [new[c].alias(c) if c in new else df[struct][c].alias(c) for c in columns]
