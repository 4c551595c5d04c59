"""Keep-first / keep-last, top-n, latest, sampling, running totals and runs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.columns import KEY, TIME
from panelwright.operators.order_stats import hex_chunk_of, value_ranks
from panelwright.operators.sizes import attach, bounded_by_dates


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """First n rows per group; Spark limits each partition before the exchange."""
    if not by:
        return df.orderBy(*order).limit(n)
    rn = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    kept = df.withColumn(rank or "_rn", rn).where(F.col(rank or "_rn") <= n)
    return kept if rank else kept.drop("_rn")


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_n(df, keys, order, 1)


def last_values(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last non-null value of every column per group under an order."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    at = F.struct(*order)
    picks = [F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in rest]
    ends = [F.max(at)[c].alias(c) for c in order if c not in keys]
    return df.groupBy(*keys).agg(*ends, *picks)


def latest(df: DataFrame, by: Sequence[str] = (), time: str = TIME) -> DataFrame:
    """Rows on the last day of the whole frame or of each group."""
    if not by:
        return df.where(F.col(time) == df.agg(F.max(time)).scalar())
    last = df.groupBy(*by).agg(F.max(time).alias(time))
    return df.join(last, [*by, time], "left_semi")


def dominant(df: DataFrame, by: Sequence[str], category: str) -> DataFrame:
    """Most frequent category per group, ties to the first in order."""
    counts = df.groupBy(*by, category).agg(F.count(F.lit(1)).alias("n"))
    return top_n(counts, by, [F.desc("n"), F.col(category)], 1).select(*by, category, "n")


def best_source(sources: dict[str, DataFrame], key: str = KEY) -> DataFrame:
    """Per key the source with most rows; ties go to the first source given."""
    parts = [
        df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).select(key, F.lit(name).alias("source"), F.lit(i).alias("_i"), "n")
        for i, (name, df) in enumerate(sources.items())
    ]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return top_n(counts, [key], [F.desc("n"), F.col("_i")], 1).select(key, "source", "n")


def stable_sample(df: DataFrame, frac: float, id_col: str, by: Sequence[str] = (), seed: int = 0) -> DataFrame:
    """floor(n x frac) rows per group in the order of a hash of the id: repeatable, without replacement.

    Rows that share an id are ordered by a hash of the whole row, and equal rows are
    counted, so that the number of rows is exact.
    """
    keys = list(by) or ["_all"]
    frame = df if by else df.withColumn("_all", F.lit(0))
    of_id, of_row = F.md5(F.concat_ws("-", F.col(id_col).cast("string"), F.lit(str(seed)))), F.hex(F.xxhash64(*df.columns))
    marked = frame.withColumn("_h", F.concat(of_id, F.lpad(of_row, 16, "0")))
    ranks = value_ranks(marked.select(*keys, "_h"), "_h", keys, hex_chunk_of)
    left = F.floor(F.col("total") * F.lit(float(frac))) - F.col("before")
    chosen = ranks.where(left > 0).select(*keys, "_h", F.least("n", left).alias("_take"))
    rows = marked.dropDuplicates([*keys, "_h"]).join(chosen, [*keys, "_h"])
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_take").cast("int")))).drop("_copy", "_take", "_h", "_all")


def top_with_other(
    df: DataFrame, by: Sequence[str], label: str, value: str, n: int = 9, size: str | None = None
) -> DataFrame:
    """The n largest labels per group (by ``size``, default |value|) and one row summing the others."""
    weight = F.abs(value) if size is None else F.col(size)
    order = Window.partitionBy(*by).orderBy(F.desc(weight), label)
    ranked = df.withColumn("_rk", F.row_number().over(order))
    others = F.count(F.when(F.col("_rk") > n, 1)).over(Window.partitionBy(*by))
    name = F.when(F.col("_rk") <= n, F.col(label)).otherwise(
        F.concat(others.cast("string"), F.lit(" other features"))
    )
    return (
        ranked.withColumn(label, name)
        .groupBy(*by, label)
        .agg(F.sum(value).alias(value), F.min("_rk").cast("int").alias("rank"))
    )


def running_total(
    df: DataFrame, value: str, chunk: Sequence[str], order: Sequence[str], out: str, by: Sequence[str] = ()
) -> DataFrame:
    """Running sum over the whole order, ``chunk`` being leading columns of that order.

    Sums per chunk are added up first (one row per chunk), then each chunk runs
    on its own from the total before it, so no task sees the whole order.
    """
    by, chunk = list(by), list(chunk)
    before = Window.partitionBy(*by).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*by, *chunk)
        .agg(F.sum(value).alias("_sum"))
        .select(*by, *chunk, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*by, *chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = attach(df, offsets, [*by, *chunk], max_rows=bounded_by_dates([*by, *chunk]))
    return joined.withColumn(out, F.col("_before") + F.sum(value).over(inside)).drop("_before")


def _summaries(hits: Sequence[str]):
    """Of each key's consecutive rows in a partition: rows, and for every mark its leading, trailing and longest run."""

    def of(mark: np.ndarray) -> tuple[int, int, int]:
        miss = np.flatnonzero(~mark)
        if not len(miss):
            return len(mark), len(mark), len(mark)
        return int(miss[0]), int(len(mark) - 1 - miss[-1]), int(max(miss[0], len(mark) - 1 - miss[-1], (np.diff(miss) - 1).max(initial=0)))

    def merged(a: list, b: list) -> list:
        n, m, out = a[0], b[0], [a[0] + b[0]]
        for (lead, trail, best), (lead2, trail2, best2) in zip(a[1:], b[1:]):
            out.append((n + lead2 if lead == n else lead, trail + m if trail2 == m else trail2, max(best, best2, trail + lead2)))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(first: pa.RecordBatch, found: list) -> pa.RecordBatch:
            numbers = {"_n": found[0]} | {f"_{k}{i}": x for i, three in enumerate(found[1:]) for k, x in zip(("lead", "trail", "best"), three)}
            return pa.RecordBatch.from_pydict({c: first.column(c) for c in first.schema.names} | {k: pa.array([x], pa.int64()) for k, x in numbers.items()})

        open_key, first, found = None, None, []
        for batch in batches:
            key, marks = batch.column("_key").to_numpy(), [batch.column(h).to_numpy(zero_copy_only=False) for h in hits]
            keys = batch.select([c for c in batch.schema.names if c not in ("_key", *hits)])
            ready = []
            starts = np.append(0, np.flatnonzero(key[1:] != key[:-1]) + 1) if len(key) else np.empty(0, np.int64)
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(key)]):
                here = [end - start, *(of(m[start:end]) for m in marks)]
                if key[start] == open_key:
                    found = merged(found, here)
                    continue
                if open_key is not None:
                    ready.append(row(first, found))
                open_key, first, found = key[start], keys.slice(start, 1), here
            if ready:
                yield pa.Table.from_batches(ready).combine_chunks().to_batches()[0]
        if open_key is not None:
            yield row(first, found)

    return run


def run_summaries(
    df: DataFrame, marks: dict[str, Column], by: Sequence[str] = (), order: Sequence[str] = (TIME, KEY)
) -> DataFrame:
    """For each group its rows ``_n`` and, for mark i, its leading, trailing and longest run ``_lead<i>``, ``_trail<i>``, ``_best<i>``.

    Rows are cut by range of (by, order) into pieces of like size, whatever one day holds;
    the pieces of a group, one for each partition it meets, are merged in order.
    """
    by, names = list(by), list(marks)
    hits = [F.coalesce(marks[m], F.lit(False)).alias(f"_hit{i}") for i, m in enumerate(names)]
    rows = df.select(*by, *[F.col(c).alias(f"_by{i}") for i, c in enumerate(order)], F.xxhash64(F.lit(0), *by).alias("_key"), *hits)
    sorting = [*by, *[f"_by{i}" for i in range(len(order))]]
    dealt = rows.repartitionByRange(*sorting).sortWithinPartitions(*sorting).select(*by, F.spark_partition_id().alias("_piece"), "_key", *[f"_hit{i}" for i in range(len(names))])
    schema = T.StructType([*dealt.select(*by, "_piece").schema.fields, *[T.StructField(c, T.LongType()) for c in run_fields(len(names))]])
    pieces = dealt.mapInArrow(_summaries([f"_hit{i}" for i in range(len(names))]), schema)
    return merge_runs(pieces, len(names), "_piece", by)


def run_fields(marks: int) -> list[str]:
    return ["_n", *[f"_{k}{i}" for i in range(marks) for k in ("lead", "trail", "best")]]


def merge_runs(pieces: DataFrame, marks: int, place: str, by: Sequence[str] = ()) -> DataFrame:
    """One summary of a group's pieces, neighbours in the order of ``place``; a group must have few pieces."""
    longs = run_fields(marks)
    listed = pieces.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(place, *longs))).alias("_pieces"))

    def step(a: Column, p: Column) -> Column:
        out = [(a["_n"] + p["_n"]).alias("_n")]
        for i in range(marks):
            lead, trail, best = f"_lead{i}", f"_trail{i}", f"_best{i}"
            out += [
                F.when(a[lead] == a["_n"], a["_n"] + p[lead]).otherwise(a[lead]).alias(lead),
                F.when(p[lead] == p["_n"], a[trail] + p["_n"]).otherwise(p[trail]).alias(trail),
                F.greatest(a[best], a[trail] + p[lead], p[best]).alias(best),
            ]
        return F.struct(*out)

    start = F.struct(*[F.lit(0).cast("long").alias(c) for c in longs])
    return listed.withColumn("_all", F.aggregate(F.coalesce("_pieces", F.array()), start, step)).select(*by, "_all.*")


def longest_runs(
    df: DataFrame, marks: dict[str, Column], by: Sequence[str] = (), order: Sequence[str] = (TIME, KEY)
) -> DataFrame:
    """For each group and named mark the longest unbroken stretch of marked rows, in ``order``."""
    found = run_summaries(df, marks, by, order)
    return found.select(*by, *[F.col(f"_best{i}").alias(m) for i, m in enumerate(marks)])


def longest_run(
    df: DataFrame, col: str, sign: int, by: Sequence[str] = (), chunk: Sequence[str] = (TIME,), order: Sequence[str] = (KEY,)
) -> DataFrame:
    """Longest unbroken stretch of rows with a given sign, in (chunk, order) order."""
    return longest_runs(df, {"run": F.signum(F.col(col)) == sign}, by, [*chunk, *order])
