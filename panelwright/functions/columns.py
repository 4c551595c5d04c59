"""Column builders for ordered panels: lags, rolling statistics, fills, guarded arithmetic."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

KEY = "ticker"
TIME = "date"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def own(by: str | Sequence[str] = KEY, order: str = TIME) -> WindowSpec:
    """Rows of one security in time order (at most one row per calendar day)."""
    keys = [by] if isinstance(by, str) else list(by)
    return Window.partitionBy(*keys).orderBy(order)


def lag_n(c: str | Column, k: int, by: str = KEY, order: str = TIME) -> Column:
    """Value k rows back; negative k looks ahead."""
    w = own(by, order)
    return F.lag(col(c), k).over(w) if k >= 0 else F.lead(col(c), -k).over(w)


def lag_all(df: DataFrame, cols: Sequence[str], k: int = 1, by: str = KEY, order: str = TIME) -> DataFrame:
    return df.withColumns({c: lag_n(c, k, by, order) for c in cols})


def diff(c: str | Column, k: int = 1, order: int = 1, by: str = KEY, time: str = TIME) -> Column:
    """First or second difference over k rows."""
    x = col(c)
    first = x - lag_n(x, k, by, time)
    if order == 1:
        return first
    return first - (lag_n(x, k, by, time) - lag_n(x, 2 * k, by, time))


def log_diff(c: str | Column, k: int = 1, order: int = 1, by: str = KEY, time: str = TIME) -> Column:
    return diff(F.ln(col(c)), k, order, by, time)


_ROLLING = {
    "avg": F.avg,
    "sum": F.sum,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "max": F.max,
    "min": F.min,
}


def rolling(
    c: str | Column,
    n: int,
    fn: str = "avg",
    min_periods: int | None = None,
    by: str = KEY,
    order: str = TIME,
    shift: int = 0,
) -> Column:
    """Statistic over the last n rows, null unless ``min_periods`` (default n) are present."""
    x = col(c)
    need = n if min_periods is None else min_periods
    w = own(by, order).rowsBetween(-(n - 1) - shift, -shift)
    return F.when(F.count(x).over(w) >= need, _ROLLING[fn](x).over(w))


def ffill(
    c: str | Column, limit: int | None = None, by: str = KEY, order: str = TIME, shift: int = 0
) -> Column:
    """Carry the last value forward at most ``limit`` rows; ``shift`` also moves the result down."""
    start = Window.unboundedPreceding if limit is None else -(limit + shift)
    return F.last(col(c), ignorenulls=True).over(own(by, order).rowsBetween(start, -shift))


def carry(
    df: DataFrame, cols: Sequence[str], limit: int, by: str = KEY, order: str = TIME, shift: int = 0
) -> DataFrame:
    """:func:`ffill` for long limits: the running last value and its row, kept while it is near enough.

    The cost per row does not grow with the limit.
    """
    w = own(by, order)
    upto = w.rowsBetween(Window.unboundedPreceding, -shift)
    numbered = df.withColumn("_pos", F.row_number().over(w))
    held = numbered.withColumns(
        {f"_h_{c}": F.last(F.when(F.col(c).isNotNull(), F.struct("_pos", c)), ignorenulls=True).over(upto) for c in cols}
    )
    near = {c: F.when(F.col("_pos") - F.col(f"_h_{c}._pos") <= limit + shift, F.col(f"_h_{c}.{c}")) for c in cols}
    return held.withColumns(near).drop("_pos", *[f"_h_{c}" for c in cols])


def rolling_extreme(df: DataFrame, c: str, n: int, fn: str, out: str, by: str = KEY, order: str = TIME) -> DataFrame:
    """Maximum or minimum of the last n rows, null unless all are present, for long n.

    Extremes of about sqrt(n) rows are combined at lags that cover the n rows.
    """
    w = own(by, order)
    step = max(int(n**0.5), 1)
    short = df.withColumn("_x", _ROLLING[fn](c).over(w.rowsBetween(-(step - 1), 0)))
    lags = sorted({*range(0, n - step + 1, step), n - step})
    parts = [F.col("_x") if k == 0 else F.lag("_x", k).over(w) for k in lags]
    both = {"max": F.greatest, "min": F.least}[fn]
    whole = both(*parts) if len(parts) > 1 else parts[0]
    full = F.count(c).over(w.rowsBetween(-(n - 1), 0)) == n
    return short.withColumn(out, F.when(full, whole)).drop("_x")


_SHORT = 10  # windows below this are computed row by row


def rolled(
    df: DataFrame, stats: dict[str, tuple[str, int, str]], by: str = KEY, order: str = TIME, shift: int = 0
) -> DataFrame:
    """Adds ``out: (column, n, fn)`` as :func:`rolling` does, null unless all n rows are present, at little more cost for long n.

    Statistics of about sqrt(n) rows are combined at lags that cover the n rows once, so no
    result depends on rows outside its window.  Variances come from the blocks' own means and
    variances; what is below the last digits of the mean counts as none.
    """
    w = own(by, order)
    upto, first, second, short = w.rowsBetween(Window.unboundedPreceding, 0), {}, {}, {}
    names = {c: i for i, c in enumerate(dict.fromkeys(c for c, _, _ in stats.values()))}
    parts = {"sum": ("sum",), "avg": ("sum",), "std": ("avg", "var"), "var": ("avg", "var"), "max": ("max",), "min": ("min",)}
    made = {"sum": F.sum, "avg": F.avg, "var": F.var_pop, "max": F.max, "min": F.min}
    alone = {"sum": lambda x: x, "avg": lambda x: x.cast("double"), "var": lambda x: (x - x).cast("double")}  # a row that makes a block by itself

    def at(c: str, k: int) -> Column:
        return F.lag(c, k).over(w) if k else F.col(c)

    plans = {}
    for out, (c, n, fn) in stats.items():
        if n < _SHORT:
            short[out] = rolling(c, n, fn, by=by, order=order, shift=shift)
            continue
        key, step = f"_w{names[c]}", int(n**0.5)
        first[f"{key}_n"] = F.count(c).over(upto)
        second[f"{key}_n{n}"] = at(f"{key}_n", shift) - F.coalesce(at(f"{key}_n", shift + n), F.lit(0))
        blocks = [(step, step * i) for i in range(n // step)]
        if n % step:  # extremes may overlap
            blocks.append((n % step, n - n % step) if fn not in ("max", "min") else (step, n - step))
        for part in parts[fn]:
            for size, back in blocks:
                block = f"{key}_{part}{size}"
                first[block] = made[part](c).over(w.rowsBetween(-(size - 1), 0)) if size > 1 else alone[part](F.col(c))
                second[f"{block}_{back}"] = at(block, shift + back)
        plans[out] = (key, n, fn, blocks)
    held = df.withColumns({**first, **short}).withColumns(second)

    def each(out: str, part: str) -> list[tuple[int, Column]]:
        key, _, _, blocks = plans[out]
        return [(size, F.col(f"{key}_{part}{size}_{back}")) for size, back in blocks]

    means = {
        f"_m_{out}": reduce(Column.__add__, [x * size for size, x in each(out, "avg")]) / n
        for out, (_, n, fn, _) in plans.items() if fn in ("std", "var")
    }
    values = {}
    for out, (key, n, fn, _) in plans.items():
        if fn in ("sum", "avg"):
            value = reduce(Column.__add__, [x for _, x in each(out, "sum")])
            value = value / n if fn == "avg" else value
        elif fn in ("max", "min"):
            value = {"max": F.greatest, "min": F.least}[fn](*[x for _, x in each(out, fn)])
        else:
            mean = F.col(f"_m_{out}")
            apart = [(x * size, (m - mean) * (m - mean) * size) for (size, x), (_, m) in zip(each(out, "var"), each(out, "avg"))]
            whole = reduce(Column.__add__, [x for pair in apart for x in pair])
            noise = mean * mean * (n * 1e-28)
            value = F.when(whole <= noise, 0.0).otherwise(whole / (n - 1))
            value = F.sqrt(value) if fn == "std" else value
        values[out] = F.when(F.col(f"{key}_n{n}") == n, value)
    return held.withColumns(means).withColumns(values).drop(*first, *second, *means)


def rolling_moments(
    df: DataFrame, a: str, b: str, n: int, by: str = KEY, order: str = TIME
) -> DataFrame:
    """``cov``, ``var_a`` and ``var_b`` of the last n rows, null unless all n pairs exist.

    Sums of about sqrt(n) rows are added at lags that cover the n rows once, so a row
    costs little more for a long window, and no sum reaches beyond its window: what lies
    outside costs no digits.  Meant for columns of moderate size around 0 such as returns.
    """
    w = own(by, order)
    # a NaN counts as missing: the products of a window that holds one are not used
    both = F.col(a).isNotNull() & F.col(b).isNotNull() & ~F.isnan(a) & ~F.isnan(b)
    x, y = F.when(both, F.col(a)).otherwise(0.0), F.when(both, F.col(b)).otherwise(0.0)
    terms = {"_a": x, "_b": y, "_aa": x * x, "_bb": y * y, "_ab": x * y}
    step = max(int(n**0.5), 1)
    whole = n // step
    held = df.withColumns({"_n": both.cast("long"), **terms})
    blocks = {f"{k}_short": F.sum(k).over(w.rowsBetween(-(step - 1), 0)) for k in terms}
    if n % step:
        blocks |= {f"{k}_rest": F.sum(k).over(w.rowsBetween(-(n - 1), -step * whole)) for k in terms}
    upto = F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0))  # whole numbers: differences are exact
    summed = held.withColumns({**blocks, "_upto": upto})

    def covered(k: str) -> Column:
        parts = [F.lag(f"{k}_short", step * i).over(w) if i else F.col(f"{k}_short") for i in range(whole)]
        return reduce(Column.__add__, [*parts, *([F.col(f"{k}_rest")] if n % step else [])])

    counted = F.col("_upto") - F.coalesce(F.lag("_upto", n).over(w), F.lit(0))
    inside = summed.withColumns({**{k: covered(k) for k in terms}, "_n": counted}).drop(*blocks, "_upto")

    def centred(p: str, q: str, pq: str) -> Column:
        value = (F.col(pq) - F.col(p) * F.col(q) / n) / (n - 1)
        return F.when(F.col("_n") == n, value)

    return inside.withColumns(
        {"cov": centred("_a", "_b", "_ab"), "var_a": centred("_a", "_a", "_aa"), "var_b": centred("_b", "_b", "_bb")}
    ).drop("_n", *terms)


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b with a zero divisor giving null."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def pct_change(
    df: DataFrame,
    c: str,
    k: int = 1,
    out: str | None = None,
    pad: bool = True,
    by: str = KEY,
    order: str = TIME,
    shift: int = 0,
) -> DataFrame:
    """x / x[k rows back] - 1; with ``pad`` gaps are first filled without limit."""
    out = out or c
    if not pad:
        base = lag_n(c, k + shift, by, order)
        return df.withColumn(out, ratio(lag_n(c, shift, by, order) if shift else col(c), base) - 1)
    now = ffill(c, None, by, order, max(shift, 0))
    then = ffill(c, None, by, order, k + max(shift, 0))
    return df.withColumn(out, ratio(now, then) - 1)


def cumprod1(c: str | Column, by: str | Sequence[str] = KEY, order: str = TIME) -> Column:
    """Running product of (1 + x) minus 1, for any sign of 1 + x; nulls are skipped."""
    growth = 1 + col(c)
    w = own(by, order).rowsBetween(Window.unboundedPreceding, 0)
    zeros = F.sum(F.when(growth == 0, 1).otherwise(0)).over(w)
    negatives = F.sum(F.when(growth < 0, 1).otherwise(0)).over(w)
    size = F.exp(F.coalesce(F.sum(F.ln(F.abs(growth))).over(w), F.lit(0.0)))
    sign = F.when(negatives % 2 == 1, -1.0).otherwise(1.0)
    return F.when(zeros > 0, F.lit(-1.0)).otherwise(sign * size - 1)


def cumprod1_agg(c: str | Column) -> Column:
    """Aggregate form of :func:`cumprod1`."""
    growth = 1 + col(c)
    zeros = F.sum(F.when(growth == 0, 1).otherwise(0))
    negatives = F.sum(F.when(growth < 0, 1).otherwise(0))
    size = F.exp(F.coalesce(F.sum(F.ln(F.abs(growth))), F.lit(0.0)))
    sign = F.when(negatives % 2 == 1, -1.0).otherwise(1.0)
    return F.when(zeros > 0, F.lit(-1.0)).otherwise(sign * size - 1)


def drawdown(df: DataFrame, ret: str, by: Sequence[str] = (), order: str = TIME) -> DataFrame:
    """Wealth, running peak and drawdown of a return series (one row per date and key)."""
    wealth = df.withColumn("wealth", 1 + cumprod1(ret, by, order))
    w = own(by, order).rowsBetween(Window.unboundedPreceding, 0)
    return wealth.withColumn("peak", F.max("wealth").over(w)).withColumn(
        "drawdown", ratio(F.col("wealth") - F.col("peak"), "peak")
    )


def half_even(c: str | Column, digits: int = 2) -> Column:
    """Round half to even on the scaled binary value."""
    scale = float(10**digits)
    return F.rint(col(c) * scale) / scale


def clip(c: str | Column, low: Column, high: Column) -> Column:
    """Bound a value; a null bound does not bind and a null value stays null."""
    x = col(c)
    return F.when(x.isNotNull(), F.least(F.greatest(x, low), high))


def finite(df: DataFrame, cols: Sequence[str], fill: float | None = None) -> DataFrame:
    """Replace infinities (and NaN, which stands for a missing value) by null or a constant."""

    def fix(c: str) -> Column:
        x = F.col(c)
        bad = x.isin(float("inf"), float("-inf"))
        return F.when(F.isnan(x), None).when(bad, F.lit(fill).cast("double")).otherwise(x)

    return df.withColumns({c: fix(c) for c in cols})


def numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast text to numbers, null where it is not a number."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def percent_text(c: str | Column, digits: int = 2) -> Column:
    """A number as text with a percent sign; null stays null."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x.isNotNull(), F.format_string(f"%.{digits}f%%", x.cast("double") + 0.0))


def signed_text(c: str | Column, digits: int = 2) -> Column:
    """A number as text with its sign, zero without one; null stays null."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(x == 0, F.format_string(f"%.{digits}f", F.abs(x))).when(x.isNotNull(), F.format_string(f"%+.{digits}f", x))


def to_day(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.to_date(c) for c in cols})


def transform_code(c: str | Column, code: int, by: str = KEY, order: str = TIME) -> Column:
    """Stationarity transform by catalogue code 1..7 over the rows of one series."""
    x = col(c)
    if code == 2:
        return diff(x, 1, 1, by, order)
    if code == 3:
        return diff(x, 1, 2, by, order)
    if code == 4:
        return F.ln(x)
    if code == 5:
        return log_diff(x, 1, 1, by, order)
    if code == 6:
        return log_diff(x, 1, 2, by, order)
    if code == 7:
        first, second = lag_n(x, 1, by, order), lag_n(x, 2, by, order)
        return (ratio(x, first) - 1) - (ratio(first, second) - 1)
    return x


def select_like(
    df: DataFrame,
    prefix: str | None = None,
    suffix: str | None = None,
    exclude: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Columns whose names match a prefix and suffix, without ``exclude``, plus ``keep``."""

    def wanted(name: str) -> bool:
        if name in keep:
            return True
        if name in exclude:
            return False
        return name.startswith(prefix or "") and name.endswith(suffix or "")

    return df.select(*[F.col(f"`{n}`") for n in df.columns if wanted(n)])


def drop_like(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(*[n for n in df.columns if n.startswith(prefix)])


def rename_like(df: DataFrame, fn) -> DataFrame:
    """Rename every column through ``fn(name) -> name``."""
    return df.withColumnsRenamed({n: fn(n) for n in df.columns if fn(n) != n})


def total(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)
