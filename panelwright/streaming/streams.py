"""Incremental forms: bars from ticks, appends, metrics of updated prediction files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from panelwright.operators.joins import lookup
from panelwright.operators.strategy import METRICS, run_metrics
from panelwright.session import durable
from panelwright.streaming.partials import PARTIALS, Store, update_metrics


def read_files(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", per_trigger: int | None = None) -> DataFrame:
    """File source; every new file under the path becomes input once."""
    reader = spark.readStream.schema(schema).format(format)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(path)


def stream_bars(
    ticks: DataFrame, watermark: str = "1 day", time: str = "ts", key: str = "user_id", value: str = "value", order: Sequence[str] = ()
) -> DataFrame:
    """Daily bars of a tick stream; a day is final once the watermark passes its end.

    The state holds one bar per key and open day.  :func:`to_files` writes final days
    only; :func:`to_versions` writes open days too and anew when they change.
    """
    at = F.struct(time, *order)
    return (
        ticks.withColumn(time, F.col(time).cast("timestamp"))
        .withWatermark(time, watermark)
        .groupBy(F.window(time, "1 day").alias("day"), F.col(key))
        .agg(
            F.min_by(value, at).alias("open"),
            F.max(value).alias("high"),
            F.min(value).alias("low"),
            F.max_by(value, at).alias("close"),
            F.count(F.lit(1)).alias("n"),
        )
        .select(F.to_date("day.start").alias("date"), F.col(key).alias("ticker"), "open", "high", "low", "close", "n")
    )


def to_files(df: DataFrame, target: str, checkpoint: str, format: str = "parquet", mode: str = "append") -> StreamingQuery:
    """Write what is available and stop; the checkpoint makes every input row count once."""
    return (
        df.writeStream.format(format)
        .outputMode(mode)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def to_versions(df: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write every changed row of an aggregate with its batch; a repeated batch overwrites its own rows."""

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        df.writeStream.outputMode("update").foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def newest(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """The last version of each key that :func:`to_versions` has written."""
    rows = spark.read.parquet(target)
    cols = [c for c in rows.columns if c not in (*keys, "batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), "batch").alias("_last"))
    return last.select(*keys, *[F.col(f"_last.`{c}`").alias(c) for c in cols])


def stream_append(ticks: DataFrame, master: DataFrame, target: str, checkpoint: str, key: str = "ticker") -> StreamingQuery:
    """Incremental load: rows without a key dropped, ids joined, appended once."""
    known = lookup(ticks.where(F.col(key).isNotNull()), master, key, "inner", ["dcm_security_id"])
    return to_files(known, target, checkpoint)


def stream_metrics(
    predictions: DataFrame, table: str, target: str, checkpoint: str, names: Sequence[str] | None = None
) -> StreamingQuery:
    """Strategy metrics of all rows so far whenever rows are added to ``table``.

    ``predictions`` is the stream of that table's files.  Metrics with a partial form add
    a batch's own rows to what is kept below ``target``; others, such as metrics added by
    the caller, read the whole table.  A repeated batch overwrites its own rows.
    """
    schema, chosen = predictions.schema, list(names or sorted(METRICS))
    kept, others = ([n for n in chosen if (n in PARTIALS) == has] for has in (True, False))

    def score(batch: DataFrame, batch_id: int) -> None:
        spark, out = batch.sparkSession, []
        if kept:
            out.append(update_metrics(durable(batch), Store(spark, f"{target}/_kept", batch_id), kept))
        if others:
            out.append(run_metrics(spark.read.schema(schema).parquet(table), others))
        made = reduce(DataFrame.unionByName, out).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        made.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        predictions.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
