"""Exchange calendar as a Spark table of at most 22 280 days, and joins against it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Bounds of the calendar and closures outside the yearly rules.
FIRST_DAY = "1990-01-01"
LAST_DAY = "2050-12-31"
ONE_OFF_CLOSURES = [
    "1994-04-27",
    "2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14", "2001-09-15", "2001-09-16",
    "2004-06-11",
    "2007-01-02",
    "2012-10-29", "2012-10-30",
    "2018-12-05",
    "2022-06-20",
]


def easter(year: int) -> date:
    """Gregorian Easter Sunday (Butcher's computus)."""
    a, b, c = year % 19, year // 100, year % 100
    d, e = b // 4, b % 4
    g = (8 * b + 13) // 25
    h = (19 * a + b - d - g + 15) % 30
    i, k = c // 4, c % 4
    shift = (32 + 2 * e + 2 * i - h - k) % 7
    m = (a + 11 * h + 22 * shift) // 451
    month, day = divmod(h + shift - 7 * m + 114, 31)
    return date(year, month, day + 1)


def good_fridays() -> list[str]:
    return [(easter(y) - timedelta(days=2)).isoformat() for y in range(1990, 2051)]


# Closed days; {d} is the day and {dow} its weekday, Monday = 1.
CLOSED_RULE = """(
    {dow} >= 6
    OR dayofyear({d}) = 1
    OR (dayofyear({d}) = 2 AND {dow} = 1)
    OR (month({d}) = 1 AND {dow} = 1 AND day({d}) BETWEEN 15 AND 21 AND year({d}) >= 1998)
    OR (month({d}) = 2 AND {dow} = 1 AND day({d}) BETWEEN 15 AND 21)
    OR (month({d}) = 5 AND {dow} = 1 AND day({d}) >= 25)
    OR (month({d}) = 7 AND (day({d}) = 4 OR (day({d}) = 5 AND {dow} = 1) OR (day({d}) = 3 AND {dow} = 5)))
    OR (month({d}) = 9 AND {dow} = 1 AND day({d}) <= 7)
    OR (month({d}) = 11 AND {dow} = 4 AND day({d}) BETWEEN 22 AND 28)
    OR (month({d}) = 12 AND (day({d}) = 25 OR (day({d}) = 26 AND {dow} = 1) OR (day({d}) = 24 AND {dow} = 5)))
    OR {d} IN ({listed})
)"""


def closed_rule(day: str, weekday: str) -> str:
    listed = ", ".join(f"DATE '{x}'" for x in ONE_OFF_CLOSURES + good_fridays())
    return CLOSED_RULE.format(d=day, dow=weekday, listed=listed)


def calendar(spark: SparkSession, start: str = FIRST_DAY, end: str = LAST_DAY) -> DataFrame:
    """``date``, ``is_open`` and ``seq`` (open days up to and including the day)."""
    days = spark.sql(
        f"SELECT explode(sequence(DATE '{FIRST_DAY}', DATE '{LAST_DAY}')) AS date"
    ).withColumn("is_open", ~F.expr(closed_rule("date", "(weekday(date) + 1)")))
    upto = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    numbered = days.withColumn("seq", F.sum(F.col("is_open").cast("int")).over(upto).cast("int"))
    return numbered.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def trading_days(cal: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    out = cal.where("is_open")
    if start is not None:
        out = out.where(F.col("date") >= start)
    if end is not None:
        out = out.where(F.col("date") <= end)
    return out.select("date", "seq")


def offset_map(cal: DataFrame, k: int) -> DataFrame:
    """Day -> trading day k open days on; from a closed day +1 and 0 give the next open day."""
    closed_step = 0 if k > 0 else 1
    target = F.col("seq") + k + F.when(F.col("is_open"), 0).otherwise(closed_step)
    open_days = cal.where("is_open").select(F.col("seq").alias("target"), F.col("date").alias("moved"))
    return cal.select("date", target.alias("target")).join(F.broadcast(open_days), "target", "left").select(
        "date", "moved"
    )


def offset_days(df: DataFrame, col: str, cal: DataFrame, k: int = 1, out: str | None = None) -> DataFrame:
    """Move a date column by k trading days."""
    moves = offset_map(cal, k).withColumnsRenamed({"date": "_from", "moved": "_moved"})
    joined = df.join(F.broadcast(moves), F.col(col) == F.col("_from"), "left").drop("_from")
    return joined.withColumn(out or col, F.col("_moved")).drop("_moved")


def day_facts(df: DataFrame, col: str, cal: DataFrame) -> DataFrame:
    """Whether a day is open, the previous trading day, and the next / previous open day if closed."""
    def named(k: int, name: str) -> DataFrame:
        return offset_map(cal, k).withColumnsRenamed({"date": "_d", "moved": name})

    facts = (
        cal.select(F.col("date").alias("_d"), "is_open")
        .join(named(-1, "previous_day"), "_d")
        .join(named(0, "open_or_next"), "_d")
        .withColumn("open_or_previous", F.when(F.col("is_open"), F.col("_d")).otherwise(F.col("previous_day")))
    )
    return df.join(F.broadcast(facts), F.col(col) == F.col("_d"), "left").drop("_d")


def sample_dates(cal: DataFrame, freq: str, start: Column, end: Column) -> DataFrame:
    """Sampling days in [start, end]: ``bme``/``bms`` month ends/starts, ``w-mon``, ``bq`` quarter ends."""
    inside = F.col("date").between(start, end)
    if freq in ("bme", "bms"):
        pick = F.max if freq == "bme" else F.min
        days = cal.where(inside & F.col("is_open")).groupBy(F.trunc("date", "month").alias("_m"))
        return days.agg(pick("date").alias("date")).select("date")
    if freq == "w-mon":
        anchors = cal.where(inside & (F.weekday("date") == 0)).select("date")
    elif freq == "bq":
        weekdays = cal.where(inside & (F.weekday("date") < 5))
        ends = weekdays.groupBy(F.date_trunc("quarter", "date").alias("_q")).agg(F.max("date").alias("date"))
        last = F.expr("last_day(add_months(_q, 2))")
        anchors = ends.where(F.datediff(last, "date") <= 2).select("date")
    else:
        raise ValueError(f"unknown sampling frequency {freq!r}")
    rolled = offset_days(anchors, "date", cal, 0)
    return rolled.where(inside).distinct()


def range_of(df: DataFrame, col: str = "date") -> tuple[Column, Column]:
    """First and last day of a frame as scalar subqueries."""
    return df.agg(F.min(col)).scalar(), df.agg(F.max(col)).scalar()


def sample_panel(df: DataFrame, cal: DataFrame, freq: str) -> DataFrame:
    """Rows on the sampling days of the frame's own date range."""
    start, end = range_of(df)
    return df.join(F.broadcast(sample_dates(cal, freq, start, end)), "date", "left_semi")


def intervals(cal: DataFrame, start: Column, end: Column, holding: int = 1) -> DataFrame:
    """Entry and exit day of each trading day, with the start and label of its quarter."""
    entries = trading_days(cal, start, end).select(F.col("date").alias("entry_date"))
    moved = offset_days(entries, "entry_date", cal, holding, "exit_date")
    return moved.select(
        "entry_date",
        "exit_date",
        F.to_date(F.date_trunc("quarter", "entry_date")).alias("quarter_date"),
        F.concat(F.year("entry_date"), F.lit("-Q"), F.quarter("entry_date")).alias("this_quarter"),
    )


def next_month_start(col: str | Column) -> Column:
    """First weekday of the month after a day."""
    first = F.trunc(F.add_months(F.col(col) if isinstance(col, str) else col, 1), "month")
    roll = F.when(F.weekday(first) == 5, 2).when(F.weekday(first) == 6, 1).otherwise(0)
    return F.date_add(first, roll)


def month_last_weekday(col: str | Column) -> Column:
    """Last weekday of the month of a day."""
    last = F.last_day(F.col(col) if isinstance(col, str) else col)
    back = F.when(F.weekday(last) == 5, 1).when(F.weekday(last) == 6, 2).otherwise(0)
    return F.date_sub(last, back)


def on_days(df: DataFrame, days: DataFrame, cols: Sequence[str] = ("date",)) -> DataFrame:
    return df.join(F.broadcast(days), list(cols), "left_semi")
