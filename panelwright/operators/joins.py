"""Joins the DataFrame API lacks or needs a fixed form for: as-of, range, positional, fallback."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.columns import KEY, TIME, own
from panelwright.operators.sizes import CALENDAR_DAYS, attach, require_day

PIECE = 1 << 18  # rows of one key that are ordered together


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str | tuple[str, str],
    how: str = "left",
    cols: Sequence[str] | None = None,
    default: object = None,
) -> DataFrame:
    """Dimension join; ``on`` may name different keys, ``default`` replaces missing attributes."""
    left_key, right_key = (on, on) if isinstance(on, str) else on
    cols = list(cols) if cols is not None else [c for c in dim.columns if c != right_key]
    side = dim.select(F.col(right_key).alias("_key"), *cols)
    joined = df.join(side, F.col(left_key) == F.col("_key"), how).drop("_key")
    return joined if default is None else joined.fillna(default, cols)


def replace_by(df: DataFrame, col: str, dim: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """Map a column through a dimension, keeping the original where it has no entry."""
    side = dim.select(F.col(key).cast("string").alias("_key"), F.col(value).alias("_value"))
    text = F.col(col).cast("string")
    joined = df.join(side, text == F.col("_key"), "left")
    return joined.withColumn(out or col, F.coalesce("_value", text)).drop("_key", "_value")


def merge_panel(base: DataFrame, tables: Sequence[DataFrame], on: Sequence[str] = (TIME, KEY)) -> DataFrame:
    """Left-join feature tables onto a base panel.

    Tables made by the per-security operators are already partitioned by
    security; with ``spark.sql.requireAllClusterKeysForCoPartition=false`` (see
    ``session``) the joins on (date, security) reuse that partitioning.
    """
    on = list(on)

    def step(left: DataFrame, right: DataFrame) -> DataFrame:
        extra = [c for c in right.columns if c in on or c not in left.columns]
        return left.join(right.select(*extra), on, "left")

    return reduce(step, tables, base)


def asof_days(days: DataFrame, right: DataFrame, on: str = TIME) -> DataFrame:
    """For each day the latest row of a date-level table at or before it.

    Rows of one day count as one: of each column the greatest value.
    """
    require_day(days, on)
    require_day(right, on)
    cols = [c for c in right.columns if c != on]
    right = right.groupBy(on).agg(*[F.max(c).alias(c) for c in cols]) if cols else right.select(on).distinct()
    right_rows = right.select(on, F.struct(F.col(on).alias("_at"), *cols).alias("_r"), F.lit(0).alias("_side"))
    day_rows = days.select(on).distinct().select(
        on, F.lit(None).cast(right_rows.schema["_r"].dataType).alias("_r"), F.lit(1).alias("_side")
    )
    upto = Window.orderBy(on, "_side").rowsBetween(Window.unboundedPreceding, 0)
    filled = day_rows.unionByName(right_rows).withColumn("_m", F.last("_r", ignorenulls=True).over(upto))
    return filled.where("_side = 1").select(on, "_m._at", *[F.col(f"_m.{c}").alias(c) for c in cols])


def _cut_again(both: DataFrame, by: Sequence[str], on: str, day: bool, bound: int) -> DataFrame:
    """``_cut`` of pieces that hold over ``bound`` rows, at moments where their running count passes multiples of it, and the ``_shares`` of its left rows."""
    moment = F.unix_date(F.col(on)) if day else F.unix_seconds(F.col(on).cast("timestamp"))
    both = both.withColumn("_moment", moment.cast("long"))
    large = both.groupBy(*by, "_piece").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > bound).select(*by, "_piece")
    ahead = Window.partitionBy(*by, "_piece").orderBy("_moment").rowsBetween(Window.unboundedPreceding, -1)
    moments = both.select(*by, "_piece", "_moment").join(large, [*by, "_piece"], "left_semi").groupBy(*by, "_piece", "_moment").agg(F.count(F.lit(1)).alias("_rows"))
    cuts = moments.withColumn("_cut", F.floor(F.coalesce(F.sum("_rows").over(ahead), F.lit(0)) / bound))
    whole = Window.partitionBy(*by, "_piece", "_cut")
    cuts = cuts.select(*by, "_piece", "_moment", "_cut", F.ceil(F.sum("_rows").over(whole) / (2 * bound)).cast("int").alias("_shares"))
    return both.join(cuts, [*by, "_piece", "_moment"], "left").withColumns({"_cut": F.coalesce("_cut", F.lit(0)), "_shares": F.coalesce("_shares", F.lit(1))})


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str = TIME,
    by: Sequence[str] = (),
    tolerance: int | None = None,
    ties: Sequence[str] = (),
    piece: Column | None = None,
    bound: int | None = None,
) -> DataFrame:
    """Each left row with the latest right row at or before it, within ``tolerance`` days.

    Without ``by`` the right side is a date-level table: the match is found per
    distinct day and joined back.  With ``by`` both sides are united and the
    last right row carried forward; keys are cut into pieces of time (months
    unless given), and each piece starts from the last right row of the pieces before
    it.  Where times are finer than days, a piece of over ``bound`` rows (PIECE unless
    given; 0: never) is cut again; tables of days hold a row per key and day, and are cut
    so if a bound is given.  Cuts lie at the seconds (or days) where its
    row count passes multiples of ``bound``; left rows that share one moment are dealt
    out beyond that, each share with the right rows of its cut.
    """
    by = list(by)
    cols = [c for c in right.columns if c not in by and c != on]

    def within(match: DataFrame) -> DataFrame:
        age = F.datediff(F.col(on), F.col("_m._at"))
        ok = F.col("_m").isNotNull() if tolerance is None else (age <= tolerance)
        kept = match.withColumn("_m", F.when(ok, F.col("_m")))
        return kept.select(*left.columns, *[F.col(f"_m.{c}").alias(c) for c in cols])

    if not by:
        found = asof_days(left, right, on)
        packed = found.select(on, F.when(F.col("_at").isNotNull(), F.struct("_at", *cols)).alias("_m"))
        return within(attach(left, packed, [on], max_rows=CALENDAR_DAYS))

    month = F.trunc(F.col(on), "month") if piece is None else piece
    left_rows = left.select(*by, on, F.struct(*left.columns).alias("_l"))
    right_rows = right.select(
        *by, on, F.struct(F.col(on).alias("_at"), *cols).alias("_r"), F.struct(*ties or [on]).alias("_tie")
    )
    both = (
        left_rows.withColumn("_side", F.lit(1))
        .unionByName(right_rows.withColumn("_side", F.lit(0)), allowMissingColumns=True)
        .withColumn("_piece", month)
    )
    day = left.schema[on].dataType.simpleString() == "date"
    most = bound if bound is not None else 0 if day else PIECE
    both = _cut_again(both, by, on, day, most) if most else both.withColumns({"_cut": F.lit(0).cast("long"), "_shares": F.lit(1)})

    last_of = F.max_by("_r", F.when(F.col("_r").isNotNull(), F.struct(F.col(on), F.col("_tie"))))
    before = Window.partitionBy(*by).orderBy("_piece", "_cut").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        both.groupBy(*by, "_piece", "_cut")
        .agg(last_of.alias("_end"))
        .select(*by, "_piece", "_cut", F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    )
    share = F.when(F.col("_side") == 1, F.array(F.pmod(F.xxhash64("_l"), F.col("_shares")))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("_shares").cast("long") - 1))
    dealt = both.withColumn("_share", F.explode(share)) if most else both.withColumn("_share", F.lit(0).cast("long"))
    inside = (
        Window.partitionBy(*by, "_piece", "_cut", "_share").orderBy(on, "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    )
    matched = (
        dealt.withColumn("_m", F.last("_r", ignorenulls=True).over(inside))
        .where("_side = 1")
        .join(carry, [*by, "_piece", "_cut"], "left")
        .select(F.col("_l.*"), F.coalesce("_m", "_carry").alias("_m"))
    )
    return within(matched)


def effective_dates(df: DataFrame, starts: DataFrame, start_col: str, on: str = TIME, out: str = "effective") -> DataFrame:
    """The latest start day at or before each row's day: [start, next start) intervals."""
    side = starts.select(F.col(start_col).alias(on)).distinct()
    days = asof_days(df, side.withColumn("_x", F.lit(1)), on).select(on, F.col("_at").alias(out))
    return attach(df, days, [on], max_rows=CALENDAR_DAYS)


def stitch_segments(predictions: DataFrame, model_dates: DataFrame, model_col: str = "model_date") -> DataFrame:
    """Keep for each row's day the prediction of the model whose [date, next date) holds it.

    The first segment is open to the left.
    """
    first = model_dates.agg(F.min(model_col)).scalar()
    placed = effective_dates(predictions, model_dates, model_col, out="_use")
    use = F.coalesce(F.col("_use"), first)
    return placed.where(F.col(model_col) == use).drop("_use")


def in_force(df: DataFrame, models: DataFrame, start_col: str = "model_date") -> DataFrame:
    """Each row with the columns of the one model in force on its day: [start, next start), the first open to the left.

    Start days are unique.  What a model does comes after this, so a row is scored once
    however many models there are; a model's other columns are its parameters.
    """
    first = models.agg(F.min(start_col)).scalar()
    placed = effective_dates(df, models, start_col, out="_use")
    named = models.withColumnRenamed(start_col, "_use")
    used = attach(placed.withColumn("_use", F.coalesce("_use", first)), named, ["_use"], max_rows=CALENDAR_DAYS)
    return used.withColumnRenamed("_use", start_col)


def paths_after(
    returns: DataFrame, strikes: DataFrame, n: int = 30, ret: str = "ret_1B", by: str = KEY, time: str = TIME
) -> DataFrame:
    """The n returns after each strike day of a security: step 0..n-1, null where history ends.

    Rows are numbered inside their security; only strikes are expanded, to the n places
    after theirs, and meet the returns by (security, place).
    """
    numbered = returns.select(by, time, ret, F.row_number().over(own(by, time)).alias("_at"))
    hit = numbered.join(strikes.select(by, time).distinct(), [by, time], "left_semi")
    steps = F.posexplode(F.sequence(F.col("_at") + 1, F.col("_at") + n)).alias("step", "_at")
    wanted = hit.select(by, F.col(time).alias("strike"), steps)
    return wanted.join(numbered.select(by, "_at", F.col(ret).alias("ret")), [by, "_at"], "left").select(by, "strike", "step", "ret")


def with_fallback(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Rows of ``first``, and rows of ``second`` for keys that ``first`` lacks."""
    return first.unionByName(second.join(first.select(key).distinct(), key, "left_anti"))


def restrict_to(df: DataFrame, keys: DataFrame, on: str | tuple[str, str]) -> DataFrame:
    left_key, right_key = (on, on) if isinstance(on, str) else on
    side = keys.select(F.col(right_key).alias("_key")).distinct()
    return df.join(side, F.col(left_key) == F.col("_key"), "left_semi")


def common_keys(frames: Sequence[DataFrame], time: str = TIME, by: str = KEY) -> list[DataFrame]:
    """Each frame cut to the days and securities that every frame has (date-only frames: days)."""
    for f in frames:
        require_day(f, time)
    days = reduce(lambda a, b: a.intersect(b), [f.select(time).distinct() for f in frames])
    named = [f for f in frames if by in f.columns]
    names = reduce(lambda a, b: a.intersect(b), [f.select(by).distinct() for f in named])
    out = []
    for f in frames:
        cut = f.join(F.broadcast(days), time, "left_semi")
        out.append(cut.join(names, by, "left_semi") if by in f.columns else cut)
    return out


def attach_returns(returns: DataFrame, df: DataFrame, on: Sequence[str] = (TIME, KEY)) -> DataFrame:
    """Features joined onto the return grid, whose rows are all kept."""
    return merge_panel(returns, [df], on)


def portfolio_returns(
    returns: DataFrame, weights: DataFrame, ret: str = "ret", weight: str = "weight", by: str = KEY, time: str = TIME
) -> DataFrame:
    """Daily sum of weight x return, each weight day holding until the next weight day."""
    placed = effective_dates(returns.select(time, by, ret), weights, time, time, "effective")
    side = weights.select(F.col(time).alias("effective"), by, weight)
    joined = placed.where(F.col("effective").isNotNull()).join(side, ["effective", by], "left")
    paid = F.coalesce(F.col(ret), F.lit(0.0)) * F.coalesce(F.col(weight), F.lit(0.0))
    return joined.groupBy(time).agg(F.sum(paid).alias("portfolio_ret"))
