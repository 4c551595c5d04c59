"""Exact ranks and quantiles of groups of any size.

A date, or the whole table, can hold more values than one task should sort or
buffer.  A fixed increasing function cuts the number line into chunks (160 per
power of two), so a first pass only counts rows per group and chunk.  Ranks add
the count of the chunks below to a rank inside the chunk; quantiles go back
only for the rows of the chunks that hold the wanted positions.  Equal values
are counted together before they are ordered, so a frequent value costs no more
than a rare one.

Groups by day are many and hold a row a security, so their chunks are wider (8 per power
of two): the rows that a task has of a day share chunks, and few counts move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.columns import clip
from panelwright.operators.sizes import attach, bounded_by_dates, day_like
from panelwright.session import durable

CHUNKS_PER_E = 230.0  # about 160 chunks per power of two
DAY_CHUNKS_PER_E = 11.5  # about 8
_SHIFT = 200_000  # ln of a double stays within +-746
CUTS = 4096
_ALL = "_all"


def _grouped(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    if by:
        return df, list(by)
    return df.withColumn(_ALL, F.lit(0)), [_ALL]


def clean(c: str | Column) -> Column:
    """Double with NaN read as missing and -0.0 as 0.0."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.nanvl(x, F.lit(None).cast("double")) + F.lit(0.0)


def _by_day(df: DataFrame, by: Sequence[str]) -> bool:
    """Whether the groups are calendar days, of which there are boundedly many."""
    return list(by) != [_ALL] and bounded_by_dates(by) is not None and all(day_like(df, k) for k in by)


def chunk_of(value: Column, per_e: float = CHUNKS_PER_E) -> Column:
    """Increasing step function of a double: its place on a logarithmic scale."""
    size = F.abs(value)
    step = F.floor(F.ln(F.least(size, F.lit(1.7e308))) * per_e) + _SHIFT
    return F.when(value == 0, 0).when(value > 0, step).otherwise(-step).cast("int")


def hex_chunk_of(value: Column) -> Column:
    """Increasing step function of a hexadecimal digest."""
    return F.conv(F.substring(value, 1, 3), 16, 10).cast("int")


def cut_of(value: Column, low: Column, high: Column) -> Column:
    """Place of a double among ``CUTS`` equal parts of [low, high]; increasing."""
    span = high / 2 - low / 2  # halves, as the difference of large values may overflow
    place = F.floor((value / 2 - low / 2) / F.nullif(span, F.lit(0.0)) * CUTS)
    return F.coalesce(F.least(F.greatest(place, F.lit(0)), F.lit(CUTS)), F.lit(0)).cast("int")


def _running(counts: DataFrame, keys: Sequence[str], first: str, cut=None) -> DataFrame:
    """Distinct values (keys, chunk, value, n) with the rows of their chunk up to each, itself included, as ``upto``.

    ``first`` names the least and greatest value of the chunk, columns ``_low`` and ``_high``.
    With ``cut`` only the values of one part of a chunk are ordered together.
    """
    if cut is None:
        return counts.withColumn("upto", F.sum("n").over(Window.partitionBy(*keys, "chunk").orderBy(first).rowsBetween(Window.unboundedPreceding, 0)))
    placed = counts.withColumn("_cut", cut(F.col(first), F.col("_low"), F.col("_high")))
    parts = placed.groupBy(*keys, "chunk", "_cut").agg(F.sum("n").alias("_part_n"))
    lower = Window.partitionBy(*keys, "chunk").orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*keys, "chunk", "_cut", F.coalesce(F.sum("_part_n").over(lower), F.lit(0)).alias("_part_before"))  # at most CUTS + 1 rows a chunk
    inside = Window.partitionBy(*keys, "chunk", "_cut").orderBy(first).rowsBetween(Window.unboundedPreceding, 0)
    joined = placed.join(parts, [*keys, "chunk", "_cut"])
    return joined.withColumn("upto", F.col("_part_before") + F.sum("n").over(inside)).drop("_part_before", "_cut")


def _chunk_counts(rows: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Rows per group and chunk with the number of rows in lower chunks and in the group, and the chunk's ends."""
    group = Window.partitionBy(*by)
    lower = group.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.groupBy(*by, "chunk")
        .agg(F.count(F.lit(1)).alias("chunk_n"), F.min(value).alias("_low"), F.max(value).alias("_high"))
        .select(
            *by,
            "chunk",
            "chunk_n",
            "_low",
            "_high",
            F.coalesce(F.sum("chunk_n").over(lower), F.lit(0)).alias("chunk_before"),
            F.sum("chunk_n").over(group).alias("total"),
        )
    )


def value_ranks(df: DataFrame, value: str, by: Sequence[str], chunk=chunk_of, cut=None) -> DataFrame:
    """One row per group and distinct value: ``n`` copies, ``before`` smaller rows, ``total`` rows."""
    by = list(by)
    rows = df.where(F.col(value).isNotNull()).select(*by, value, chunk(F.col(value)).alias("chunk"))
    counts = rows.groupBy(*by, "chunk", value).agg(F.count(F.lit(1)).alias("n"))
    placed = _running(counts.join(_chunk_counts(rows, by, value), [*by, "chunk"]), by, value, cut)
    return placed.select(*by, value, "n", (F.col("chunk_before") + F.col("upto") - F.col("n")).alias("before"), "total")


def _long(df: DataFrame, cols: Sequence[str], by: Sequence[str], per_e: float) -> DataFrame:
    """One row per value, with the place of its column in ``cols`` as ``feature`` and its chunk."""
    if len(cols) == 1:
        long = df.select(*by, F.lit(0).alias("feature"), clean(cols[0]).alias("value"))
    else:
        pairs = F.array(*[F.struct(F.lit(i).alias("feature"), clean(c).alias("value")) for i, c in enumerate(cols)])
        long = df.select(*by, F.explode(pairs).alias("pair")).select(*by, "pair.feature", "pair.value")
    return long.where(F.col("value").isNotNull()).withColumn("chunk", chunk_of(F.col("value"), per_e))


def quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ("date",), spread: bool = False
) -> DataFrame:
    """Exact, linearly interpolated: one row per group, array column ``q_<col>`` in the order of ``probs``."""
    frame, by_ = _grouped(df, by)
    daily = _by_day(frame, by_)
    per_e = DAY_CHUNKS_PER_E if daily else CHUNKS_PER_E
    long, keys = _long(frame, cols, by_, per_e), [*by_, "feature"]

    def position(p: float, total: Column) -> tuple[Column, Column, Column]:
        exact = (total - 1) * F.lit(float(p))
        whole = F.rint(exact)  # a position that misses a whole number by rounding is that number
        at = F.when(F.abs(exact - whole) < 1e-9, whole).otherwise(exact)
        lower = F.floor(at)
        return lower, F.least(lower + 1, total - 1), at - lower

    wanted = F.array_distinct(F.array(*[x for p in probs for x in position(p, F.col("total"))[:2]]))
    here = F.filter(
        wanted, lambda i: (i >= F.col("chunk_before")) & (i < F.col("chunk_before") + F.col("chunk_n"))
    )
    targets = (
        _chunk_counts(long, keys)
        .select(*keys, "chunk", "chunk_before", "total", "_low", "_high", here.alias("wanted"))
        .where(F.size("wanted") > 0)
    )
    bound = bounded_by_dates(by_)
    found_rows = attach(
        long, targets, [*keys, "chunk"], "inner", max_rows=bound and bound * len(cols) * 2 * len(probs), width=64
    )
    counts = found_rows.groupBy(*keys, "chunk", "value").agg(
        F.count(F.lit(1)).alias("n"),
        F.first("wanted").alias("wanted"),
        F.first("chunk_before").alias("chunk_before"),
        F.first("total").alias("total"),
        F.first("_low").alias("_low"),
        F.first("_high").alias("_high"),
    )
    ranked = _running(counts, keys, "value", cut_of if spread else None).withColumn("_end", F.col("chunk_before") + F.col("upto"))
    hits = F.filter("wanted", lambda i: (i >= F.col("_end") - F.col("n")) & (i < F.col("_end")))
    entries = ranked.select(*keys, "total", "value", F.explode(hits).alias("index"))

    aggs = []
    for i in range(len(cols)):
        mine = F.col("feature") == i
        # at most two positions per probability
        aggs += [
            F.map_from_entries(F.collect_list(F.when(mine, F.struct("index", "value")))).alias(f"_v{i}"),
            F.max(F.when(mine, F.col("total"))).alias(f"_t{i}"),
        ]
    packed = entries.groupBy(*by_).agg(*aggs)

    def edge(i: int, p: float) -> Column:
        lower, upper, part = position(p, F.col(f"_t{i}"))
        low, high = F.col(f"_v{i}")[lower], F.col(f"_v{i}")[upper]
        return low + (high - low) * part

    out = packed.select(*by_, *[F.array(*[edge(i, p) for p in probs]).alias(f"q_{c}") for i, c in enumerate(cols)])
    return out if by else out.drop(_ALL)


def with_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ("date",), spread: bool = False
) -> DataFrame:
    """Rows with the ``q_<col>`` arrays of their group attached.

    The rows are written once for the passes that count, select and attach.  Writing the
    ranked columns only, and making the rows a second time to attach to, took half as long
    again.
    """
    frame, keys = _grouped(durable(df), by)
    stats = quantiles(frame, cols, probs, keys, spread)
    out = attach(frame, stats, keys, max_rows=bounded_by_dates(keys), width=8 * len(cols) * (len(probs) + 1))
    return out if by else out.drop(_ALL)


def avg_rank(
    df: DataFrame, value: str, out: str, by: Sequence[str] = ("date",), pct: bool = False, spread: bool = False
) -> DataFrame:
    """Rank within a group, ties sharing their average; ``pct`` divides by the non-null count."""
    frame, keys = _grouped(durable(df), by)
    if not spread and _by_day(frame, keys):
        return _day_rank(frame, value, out, keys, pct)
    ranks = value_ranks(frame.select(*keys, clean(value).alias("_v")), "_v", keys, cut=cut_of if spread else None)
    place = F.col("before") + (F.col("n") + 1) / F.lit(2.0)
    if pct:
        place = place / F.col("total")
    ranks = ranks.select(*keys, "_v", place.alias(out))
    joined = frame.withColumn("_v", clean(value)).join(ranks, [*keys, "_v"], "left").drop("_v")
    return joined if by else joined.drop(_ALL)


def _day_rank(frame: DataFrame, value: str, out: str, keys: Sequence[str], pct: bool) -> DataFrame:
    """:func:`avg_rank` of groups by day: rows move once, to their chunk, and are ranked there as they are."""
    present = clean(value).isNotNull()
    chunked = frame.where(present).withColumn("chunk", chunk_of(clean(value), DAY_CHUNKS_PER_E))
    rows = chunked.repartition(*keys, "chunk").withColumn("_v", clean(value))  # made here, so that it does not move
    inside = Window.partitionBy(*keys, "chunk").orderBy("_v")
    placed = rows.select(
        *frame.columns, "chunk", F.rank().over(inside).alias("_first"),
        F.count(F.lit(1)).over(inside.rangeBetween(Window.unboundedPreceding, 0)).alias("_upto"),
    )
    counts = _chunk_counts(chunked.select(*keys, clean(value).alias("_v"), "chunk"), keys, "_v").select(*keys, "chunk", "chunk_before", "total")
    place = F.col("chunk_before") + (F.col("_first") + F.col("_upto")) / F.lit(2.0)
    if pct:
        place = place / F.col("total")
    # days that are null stand apart, as they match no other
    ranked = placed.join(counts, [*keys, "chunk"], "left").select(*frame.columns, place.alias(out))
    return ranked.unionByName(frame.where(~present).withColumn(out, F.lit(None).cast("double")))


def avg_ranks(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str], by: Sequence[str] = ("date",), pct: bool = False
) -> DataFrame:
    """Average-tie ranks of several columns at once; ``keys`` identify a row and include ``by``."""
    by, keys = list(by), list(keys)
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), clean(c).alias("value")) for c in cols])
    long = durable(df).select(*keys, F.explode(pairs).alias("pair")).select(*keys, "pair.feature", "pair.value")
    ranks = value_ranks(long, "value", [*by, "feature"])
    place = F.col("before") + (F.col("n") + 1) / F.lit(2.0)
    if pct:
        place = place / F.col("total")
    joined = long.join(ranks.select(*by, "feature", "value", place.alias("place")), [*by, "feature", "value"], "left")
    return joined.groupBy(*keys).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("place"))).alias(c) for c in cols]
    )


def bucket_of(value: Column, edges: Column, start: int = 0) -> Column:
    """Right-closed bucket of a value among increasing edges (last edge is the maximum)."""
    cuts = F.array_distinct(edges)
    inner = F.filter(cuts, lambda e: e < value)
    place = F.greatest(F.size(inner) - 1, F.lit(0)) + start
    flat = F.element_at(edges, 1) == F.element_at(edges, -1)
    return F.when(value.isNotNull() & ~flat, place).cast("int")


def qcut(
    df: DataFrame, value: str, q: int = 5, by: Sequence[str] = (), start: int = 0, out: str | None = None, spread: bool = False
) -> DataFrame:
    """Quantile bucket with right-closed edges and duplicate edges dropped; null for a constant group."""
    probs = [round(i / q, 12) for i in range(q + 1)]
    framed = with_quantiles(df, [value], probs, by, spread)
    bucket = bucket_of(clean(value), F.col(f"q_{value}"), start)
    return framed.withColumn(out or f"{value}_qt", bucket).drop(f"q_{value}")


def winsorize(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("date",), alpha: float = 0.01, spread: bool = False
) -> DataFrame:
    """Clip each column at its alpha/2 and 1 - alpha/2 quantiles within the group."""
    cols = list(cols)
    framed = with_quantiles(df, cols, [alpha / 2, 1 - alpha / 2], by, spread)
    clipped = {
        c: clip(clean(c), F.element_at(f"q_{c}", 1), F.element_at(f"q_{c}", 2)) for c in cols
    }
    return framed.withColumns(clipped).drop(*[f"q_{c}" for c in cols])


def fill_median(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("date",)) -> DataFrame:
    cols = list(cols)
    framed = with_quantiles(df, cols, [0.5], by)
    filled = {c: F.coalesce(clean(c), F.element_at(f"q_{c}", 1)) for c in cols}
    return framed.withColumns(filled).drop(*[f"q_{c}" for c in cols])
