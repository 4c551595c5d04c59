"""Strategy metrics kept from batch to batch.

A metric with a partial form adds up what a batch's own rows give with what is kept of
earlier batches, and never reads the whole table again:

* ``return_summary`` keeps sums and counts of the end buckets, one row per date;
* ``accuracy`` and ``volatility`` keep one row;
* ``runs`` keeps a mergeable summary per month, and the signs by month; a batch reads
  the signs of its own months again, as late rows may fall between earlier ones;
* ``return_quantiles`` keeps counts per band of values, and values with their counts by
  band; a batch reads the bands that hold a wanted position.

Every batch writes below its own number and reads lower numbers only, so a batch that is
run again replaces what it wrote and counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.functions.columns import KEY, TIME
from panelwright.operators import strategy as G
from panelwright.operators.order_stats import chunk_of, clean
from panelwright.operators.picks import merge_runs, run_summaries

RET = "future_ret_5B"
BAND = 200  # chunks of values in a band: a factor of about 2.4
UNDATED = -1


class Store:
    """What is kept below a folder, as seen by one batch."""

    def __init__(self, spark: SparkSession, path: str, batch_id: int):
        self.spark, self.path, self.batch_id = spark, path, batch_id

    def carry(self, name: str, own: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """A small table after this batch: ``merge(before, own)``, or ``own`` in the first batch."""
        at = f"{self.path}/{name}/{{}}"
        now = own
        if self.batch_id:
            before = self.spark.read.schema(own.schema).parquet(at.format(self.batch_id - 1))
            now = merge(before, own)
        now.write.mode("overwrite").parquet(at.format(self.batch_id))
        return self.spark.read.schema(own.schema).parquet(at.format(self.batch_id))

    def add(self, name: str, own: DataFrame, part: str) -> DataFrame:
        """The rows of all batches so far, in folders by ``part``; this batch's are written anew."""
        own.hint("rebalance", part).write.mode("overwrite").partitionBy(part).parquet(f"{self.path}/{name}/batch={self.batch_id}")
        kept = self.spark.read.schema(own.withColumn("batch", F.lit(0).cast("long")).schema).parquet(f"{self.path}/{name}")
        return kept.where(F.col("batch") <= self.batch_id).drop("batch")


def _summed(keys: Sequence[str] = ()) -> Callable[[DataFrame, DataFrame], DataFrame]:
    def merge(before: DataFrame, own: DataFrame) -> DataFrame:
        sums = [F.sum(c).alias(c) for c in own.columns if c not in keys]
        return before.unionByName(own).groupBy(*keys).agg(*sums).select(*own.columns)

    return merge


def _return_summary(batch: DataFrame, store: Store, bucket: str = "ensemble_qt", q: int = 5) -> DataFrame:
    ends = {i: F.when(F.col(bucket) == i, F.col(RET).cast("double")) for i in (0, q - 1)}
    sums = [F.coalesce(F.sum(x), F.lit(0.0)).alias(f"sum{i}") for i, x in ends.items()]
    own = batch.groupBy(TIME).agg(*sums, *[F.count(x).alias(f"n{i}") for i, x in ends.items()])
    days = store.carry("days", own, _summed([TIME]))
    low, top = (F.try_divide(F.col(f"sum{i}"), F.col(f"n{i}")) for i in ends)
    return G.return_summary(days.select(TIME, (top - low).alias("long_short")))


def _accuracy(batch: DataFrame, store: Store) -> DataFrame:
    own = G.METRICS["accuracy"][1](batch).fillna(0)
    kept = store.carry("accuracy", own, _summed())
    some = F.col("number_of_predictions") > 0
    return kept.withColumn("correct_predictions", F.when(some, F.col("correct_predictions")))


def _volatility(batch: DataFrame, store: Store) -> DataFrame:
    n, zero = F.count(RET), F.lit(0.0)
    own = batch.agg(n.alias("n"), F.coalesce(F.avg(RET), zero).alias("mean"), F.coalesce(F.var_pop(RET) * n, zero).alias("squares"))

    def merge(before: DataFrame, own: DataFrame) -> DataFrame:
        n, mean = F.col("n"), F.col("mean")
        both = before.unionByName(own).agg(F.sum("n").alias("n"), F.sum(n * mean).alias("_sum"), F.sum(F.col("squares") + n * mean * mean).alias("_all"))
        centre = F.coalesce(F.try_divide(F.col("_sum"), n), F.lit(0.0))
        return both.select("n", centre.alias("mean"), F.greatest(F.col("_all") - n * centre * centre, F.lit(0.0)).alias("squares"))

    kept = store.carry("volatility", own, merge)
    return kept.select(F.sqrt(F.try_divide(F.col("squares"), F.col("n"))).alias(f"std_{RET}"))


def _runs(batch: DataFrame, store: Store) -> DataFrame:
    month = F.coalesce(F.year(TIME) * 12 + F.month(TIME), F.lit(UNDATED))
    signs = batch.select(TIME, KEY, F.signum(RET).alias(RET), month.alias("month"))
    touched = [row.month for row in signs.select("month").distinct().collect()]  # months of the calendar
    rows = store.add("signs", signs, "month").where(F.col("month").isin(touched))
    marks = G.run_marks(RET)
    own = run_summaries(rows, marks, ["month"])
    kept = store.carry("months", own, lambda before, own: before.where(~F.col("month").isin(touched)).unionByName(own))
    whole = merge_runs(kept, len(marks), "month")
    return G.up_down(whole.select(*[F.col(f"_best{i}").alias(m) for i, m in enumerate(marks)]))


def _return_quantiles(batch: DataFrame, store: Store, q: int = 5) -> DataFrame:
    value = batch.select(clean(RET).alias("value")).where("value IS NOT NULL")
    band = F.floor(chunk_of(F.col("value")) / BAND).cast("int")
    values = value.groupBy("value").agg(F.count(F.lit(1)).alias("n")).withColumn("band", band)
    kept = store.add("values", values, "band")
    bands = store.carry("bands", values.groupBy("band").agg(F.sum("n").alias("n")), _summed(["band"]))
    sizes = sorted((row.band, row.n) for row in bands.collect())  # a few thousand bands hold all doubles
    total = sum(n for _, n in sizes)
    counts = _bucket_counts(kept, sizes, total, q) if total else [0] * q
    return batch.sparkSession.createDataFrame([tuple(counts)], ", ".join(f"bucket_{i + 1} long" for i in range(q)))


def _bucket_counts(kept: DataFrame, sizes: list[tuple[int, int]], total: int, q: int) -> list[int]:
    """Rows per bucket between interpolated quantiles, from the values at the positions next to them."""
    places = []
    for i in range(q + 1):
        exact = (total - 1) * round(i / q, 12)
        at = round(exact) if abs(exact - round(exact)) < 1e-9 else exact
        places.append((int(at), min(int(at) + 1, total - 1), at - int(at)))
    wanted = sorted({x for low, high, _ in places for x in (low, high)})
    before, starts = 0, {}
    for band, n in sizes:
        if any(before <= x < before + n for x in wanted):
            starts[band] = before
        before += n
    rows = kept.where(F.col("band").isin(list(starts))).groupBy("band", "value").agg(F.sum("n").alias("n")).withColumn("chunk", chunk_of(F.col("value")))
    lower = Window.partitionBy("band").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = rows.groupBy("band", "chunk").agg(F.sum("n").alias("size"))  # at most BAND rows a band
    chunks = chunks.select("band", "chunk", F.coalesce(F.sum("size").over(lower), F.lit(0)).alias("below"))
    inside = Window.partitionBy("band", "chunk").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    start = F.create_map(*[F.lit(x).cast("long") for pair in starts.items() for x in pair])[F.col("band").cast("long")]
    ends = rows.join(chunks, ["band", "chunk"]).select("value", "n", (start + F.col("below") + F.sum("n").over(inside)).alias("end"))
    hit = reduce(Column.__or__, [(F.col("end") - F.col("n") <= x) & (F.col("end") > x) for x in wanted])
    found = ends.where(hit).collect()  # at most two values for an edge
    at = {x: row for row in found for x in wanted if row.end - row.n <= x < row.end}
    upto = {}
    for low, high, part in places:
        a, b = at[low], at[high]
        edge = a.value + (b.value - a.value) * part
        upto[edge] = b.end if edge >= b.value else a.end
    edges = sorted(upto)
    if len(edges) == 1:
        return [0] * q  # a constant has no buckets
    marks = [0, *[upto[e] for e in edges[1:]]]
    counts = [b - a for a, b in zip(marks, marks[1:])]
    return counts + [0] * (q - len(counts))


PARTIALS: dict[str, Callable[[DataFrame, Store], DataFrame]] = {
    "return_summary": _return_summary,
    "accuracy": _accuracy,
    "volatility": _volatility,
    "runs": _runs,
    "return_quantiles": _return_quantiles,
}


def update_metrics(batch: DataFrame, store: Store, names: Sequence[str]) -> DataFrame:
    """(metric, field, value) of all rows so far, for metrics that have a partial form."""
    for name in names:
        missing = set(G.METRICS[name][0]) - set(batch.columns)
        if missing:
            raise ValueError(f"metric {name} lacks columns {sorted(missing)}")
    return reduce(DataFrame.unionByName, [G.metric_rows(name, PARTIALS[name](batch, store)) for name in names])
