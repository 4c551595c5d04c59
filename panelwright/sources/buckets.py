"""Tables stored bucketed and sorted by security, so that merges and windows over them need no exchange."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from panelwright.functions.columns import KEY, TIME
from panelwright.operators.joins import merge_panel

CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def write_bucketed(df: DataFrame, name: str, base: str, buckets: int, key: str = KEY, order: Sequence[str] = (TIME,), aligned: bool = False) -> str:
    """Save a table in ``buckets`` files by ``key``, each sorted by (key, order); returns its catalog name.

    ``aligned`` rows come from tables with the same buckets, by steps that keep a
    security's rows together, and so are in their buckets already.  The name gets a suffix
    of its own, so two loads never write to one table.
    """
    table = f"{re.sub(r'[^0-9a-zA-Z]', '_', name)}_{uuid.uuid4().hex}"
    dealt = df if aligned else df.repartition(buckets, key)
    stored = dealt.write.bucketBy(buckets, key).sortBy(key, *order).option("compression", "zstd")
    stored.option("path", f"{base}/{table}").format("parquet").saveAsTable(table)
    return table


def _merging(spark: SparkSession) -> SparkSession:
    """The session, or a new one beside it with the same settings, in which tables bucketed by a part of the join keys meet as they lie."""
    if spark.conf.get(CO_PARTITION) == "false":
        return spark
    beside = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if beside.conf.isModifiable(key):
            beside.conf.set(key, value)
    beside.conf.set(CO_PARTITION, "false")
    beside.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return beside


def merge_bucketed(spark: SparkSession, tables: Sequence[str], on: Sequence[str] = (TIME, KEY)) -> DataFrame:
    """Left-join bucketed feature tables onto the first; with the same buckets everywhere no row moves.

    Rows meet by day and security inside their bucket, which Spark accepts without an
    exchange where ``spark.sql.requireAllClusterKeysForCoPartition`` is off, as in
    ``build_session``; elsewhere the merge is planned in a session beside the caller's.
    """
    session = _merging(spark)
    first, *others = (session.table(t) for t in tables)
    stored = sorted(on, key=lambda c: c != KEY)  # rows lie in this order, so that sorting them again costs little
    merged = merge_panel(first, others, stored)
    return merged.select(*on, *[c for c in merged.columns if c not in on])
