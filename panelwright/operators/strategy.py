"""Strategy and portfolio statistics, and the registry of metrics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.columns import KEY, TIME, cumprod1, cumprod1_agg, drawdown, own, ratio
from panelwright.operators.joins import portfolio_returns
from panelwright.operators.order_stats import qcut
from panelwright.operators.picks import longest_runs
from panelwright.session import durable

RISK_FREE = 0.02
PERIODS = 12  # kept for the shorter holding period too


def quantile_returns(df: DataFrame, bucket: str = "ensemble_qt", ret: str = "future_ret_5B", q: int = 5) -> DataFrame:
    """Mean return per date and bucket, one column ``q<i>`` per bucket."""
    return df.groupBy(TIME).agg(*[F.avg(F.when(F.col(bucket) == i, F.col(ret))).alias(f"q{i}") for i in range(q)])


def long_short(df: DataFrame, bucket: str = "ensemble_qt", ret: str = "future_ret_5B", q: int = 5) -> DataFrame:
    """Top minus bottom bucket return per date."""
    return quantile_returns(df, bucket, ret, q).withColumn("long_short", F.col(f"q{q - 1}") - F.col("q0"))


def return_summary(rets: DataFrame, ret: str = "long_short", beta: float = 1.0) -> DataFrame:
    """Annualised return and volatility, Sharpe, Treynor, maximum drawdown and Calmar of a return series."""
    falls = drawdown(rets.where(F.col(ret).isNotNull()).withColumn("_all", F.lit(0)), ret, ["_all"])
    stats = falls.agg(
        (F.avg(ret) * PERIODS).alias("annualized_return"),
        (F.stddev_samp(ret) * F.sqrt(F.lit(float(PERIODS)))).alias("annualized_volatility"),
        F.min("drawdown").alias("max_drawdown"),
    )
    excess = F.col("annualized_return") - RISK_FREE
    return stats.withColumns(
        {
            "sharpe_ratio": ratio(excess, "annualized_volatility"),
            "treynor_ratio": ratio(excess, F.lit(float(beta))),
            "calmar_ratio": ratio(excess, F.abs("max_drawdown")),
        }
    )


def quarterly_hit_ratio(df: DataFrame, bucket: str = "ensemble_qt", ret: str = "future_ret_5B", q: int = 5, min_rows: int = 4) -> DataFrame:
    """Share, in percent, of top-bucket gains and bottom-bucket losses per quarter with enough rows."""
    top, low = F.col(bucket) == q - 1, F.col(bucket) == 0
    hit = (top & (F.col(ret) > 0)) | (low & (F.col(ret) < 0))
    grouped = df.groupBy(F.to_date(F.date_trunc("quarter", TIME)).alias("quarter")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(top | low, 1)).alias("n_ends"),
        F.count(F.when(hit, 1)).alias("n_hits"),
    )
    kept = grouped.where((F.col("n_rows") >= min_rows) & (F.col("n_ends") > 0))
    return kept.select("quarter", "n_ends", (ratio("n_hits", "n_ends") * 100).alias("hit_ratio"))


def sign_agreement(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose signs agree, summed over column pairs, and the number of rows."""
    def sign(c: str) -> Column:
        return F.when(F.col(c) == 0, 0).when(F.col(c) > 0, 1).otherwise(-1)

    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    same = [F.sum(F.when(sign(a) == sign(b), 1).otherwise(0)) for a, b in pairs]
    return df.agg(
        sum(same, F.lit(0)).cast("bigint").alias("correct_predictions"), F.count(F.lit(1)).alias("number_of_predictions")
    )


def run_ratio(df: DataFrame, col: str, by: Sequence[str] = (), chunk: Sequence[str] = (TIME,), order: Sequence[str] = (KEY,)) -> DataFrame:
    """Longest rise and fall and their ratio."""
    return up_down(longest_runs(df, run_marks(col), by, [*chunk, *order]))


def run_marks(col: str) -> dict[str, Column]:
    sign = F.signum(F.col(col))
    return {"up_periods": sign == 1, "down_periods": sign == -1}


def up_down(both: DataFrame) -> DataFrame:
    quotient = F.when(F.col("down_periods") != 0, ratio("up_periods", "down_periods")).otherwise(F.col("up_periods").cast("double"))
    return both.withColumn("up_down_ratio", quotient)


def return_quantiles(df: DataFrame, ret: str = "future_ret_5B", q: int = 5) -> DataFrame:
    """Buckets 1..q of the return over the whole frame."""
    return qcut(df, ret, q, (), 1, "quantiles")


def deviations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population deviation of each column."""
    return df.agg(*[F.stddev_pop(c).alias(f"std_{c}") for c in cols])


def upside_ratio(df: DataFrame, cols: Sequence[str], ret: str = "returns") -> DataFrame:
    """Deviation of each column on rising rows over the deviation of the return."""
    return df.agg(*[ratio(F.stddev_samp(F.when(F.col(ret) > 0, F.col(c))), F.stddev_samp(ret)).alias(f"upside_{c}") for c in cols])


def portfolio_vs_benchmark(returns: DataFrame, weights: DataFrame, benchmark, ret: str = "ret") -> DataFrame:
    """Cumulative return of a weighted portfolio and of a benchmark security, per date."""
    port = portfolio_returns(returns, weights, ret)
    bench = returns.where(F.col(KEY) == benchmark).groupBy(TIME).agg(F.avg(ret).alias("benchmark_ret"))
    both = port.join(bench, TIME, "left").withColumn("_all", F.lit(0))
    return both.select(
        TIME,
        cumprod1("portfolio_ret", "_all").alias("portfolio_cum"),
        cumprod1("benchmark_ret", "_all").alias("benchmark_cum"),
    )


def past_strikes(signals: DataFrame, bucket: str = "ensemble_qt", drop_last: bool = False) -> DataFrame:
    """Days on which a security had its present signal; ``drop_last`` leaves out the last of them."""
    back = Window.partitionBy(KEY).orderBy(F.desc(TIME))
    kept = signals.withColumn("_now", F.first(bucket).over(back)).where(F.col(bucket) == F.col("_now"))
    if drop_last:
        kept = kept.withColumn("_rn", F.row_number().over(back)).where(F.col("_rn") > 1)
    return kept.select(KEY, TIME, F.col("_now").alias("current_signal"))


def path_groups(paths: DataFrame, q: int = 5) -> DataFrame:
    """Mean path per group of paths, grouped by final cumulative return; incomplete paths are left out."""
    paths = durable(paths)
    ends = paths.groupBy(KEY, "strike").agg(
        cumprod1_agg("ret").alias("final"), F.count(F.when(F.col("ret").isNull(), 1)).alias("_gaps")
    )
    whole = ends.withColumn("final", F.when(F.col("_gaps") == 0, F.round("final", 9))).drop("_gaps")
    grouped = qcut(whole, "final", q, [KEY], 0, "cut").where(F.col("cut").isNotNull())
    return (
        paths.join(grouped.select(KEY, "strike", "cut"), [KEY, "strike"])
        .groupBy(KEY, "cut", "step")
        .agg(F.avg("ret").alias("ret"))
    )


def hit_ratio(paths: DataFrame, current: DataFrame) -> DataFrame:
    """Share of complete paths whose mean return has the sign of the signal, and the number of paths."""
    means = paths.groupBy(KEY, "strike").agg(
        F.avg("ret").alias("_mean"), F.count(F.when(F.col("ret").isNull(), 1)).alias("_gaps")
    )
    mean = F.when(F.col("_gaps") == 0, F.col("_mean"))
    joined = means.withColumn("_mean", mean).join(current, KEY)
    signal = F.col("current_signal")
    hit = F.when(signal >= 3, F.col("_mean") > 0).when(signal <= 1, F.col("_mean") < 0)
    counted = joined.groupBy(KEY, "current_signal").agg(
        F.count(F.lit(1)).alias("occurrences"), F.count(F.when(hit, 1)).alias("_hits")
    )
    share = F.when(signal != 2, ratio("_hits", "occurrences") * 100)
    return counted.select(KEY, "current_signal", "occurrences", share.alias("hit_ratio"))


def forecast_band(returns: DataFrame, groups: DataFrame, lookback: int = 282, ret: str = "ret_1B") -> DataFrame:
    """Cumulative past return and the median, lowest and highest continuation along the group paths.

    The past covers ``lookback`` days before each security's last day; step s of
    a path lies s days after it, and step 0 is left out.
    """
    last = returns.groupBy(KEY).agg(F.max(TIME).alias("_last"))
    past = returns.join(last, KEY).where(F.col(TIME) > F.date_sub("_last", lookback))
    line = past.select(KEY, TIME, "_last", cumprod1(ret).alias("value"))
    end = line.where(F.col(TIME) == F.col("_last")).select(KEY, "_last", F.col("value").alias("_base"))
    ahead = groups.where("step > 0").withColumn("_cum", cumprod1("ret", [KEY, "cut"], "step"))
    middle = ahead.groupBy(KEY, "step").agg(
        F.percentile("ret", F.lit(0.5)).alias("_mid"), F.min("_cum").alias("_low"), F.max("_cum").alias("_high")
    )  # at most q values per step
    cum = middle.withColumn("_mid_cum", cumprod1("_mid", KEY, "step")).join(end, KEY)

    def onto(c: str) -> Column:
        return (1 + F.col("_base")) * (1 + F.col(c)) - 1

    future = cum.select(
        KEY, F.date_add("_last", F.col("step").cast("int")).alias(TIME), F.lit("forecast").alias("part"),
        onto("_mid_cum").alias("value"), onto("_low").alias("lower"), onto("_high").alias("upper"),
    )
    history = line.select(KEY, TIME, F.lit("past").alias("part"), "value", F.col("value").alias("lower"), F.col("value").alias("upper"))
    return history.unionByName(future)


# Bucket -> wording.
SIGNAL_TEXT = {4: "Strong Buy", 3: "Weak Buy", 2: "Neutral", 1: "Weak Sell", 0: "Strong Sell"}


def signal_text(bucket: str = "ensemble_qt") -> Column:
    pairs = [F.lit(x) for kv in SIGNAL_TEXT.items() for x in kv]
    return F.create_map(*pairs)[F.col(bucket)]


def book_signals(book: DataFrame, signals: DataFrame, bucket: str = "signal") -> DataFrame:
    """Wording of the signal of each book position, ``No Forecast`` where there is none."""
    joined = book.join(signals.select(KEY, bucket), KEY, "left")
    return joined.withColumn("signal_text", F.coalesce(signal_text(bucket), F.lit("No Forecast"))).drop(bucket)


METRICS: dict[str, tuple[tuple[str, ...], Callable[[DataFrame], DataFrame]]] = {}


def metric(name: str, needs: Sequence[str] = ()):
    """Register a metric: a function from a predictions frame to a one-row frame of doubles or counts."""

    def add(fn: Callable[[DataFrame], DataFrame]):
        METRICS[name] = (tuple(needs), fn)
        return fn

    return add


def metric_rows(name: str, row: DataFrame) -> DataFrame:
    """The columns of a metric's one row as rows (metric, field, value)."""
    long = row.select(*[F.col(c).cast("double").alias(c) for c in row.columns]).unpivot([], row.columns, "field", "value")
    return long.select(F.lit(name).alias("metric"), "field", "value")


def run_metrics(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """All chosen metrics as rows (metric, field, value)."""
    out = None
    for name in names or sorted(METRICS):
        needs, fn = METRICS[name]
        missing = set(needs) - set(df.columns)
        if missing:
            raise ValueError(f"metric {name} lacks columns {sorted(missing)}")
        part = metric_rows(name, fn(df))
        out = part if out is None else out.unionByName(part)
    return out


_SIGNALS = ("date", "ensemble_qt", "future_ret_5B")


@metric("return_summary", _SIGNALS)
def _return_summary(df: DataFrame) -> DataFrame:
    return return_summary(long_short(df))


@metric("accuracy", ("ensemble", "future_ret_5B"))
def _accuracy(df: DataFrame) -> DataFrame:
    return sign_agreement(df.withColumn("centred", F.col("ensemble") - 0.5), ["centred", "future_ret_5B"])


@metric("runs", ("date", "future_ret_5B"))
def _runs(df: DataFrame) -> DataFrame:
    return run_ratio(df, "future_ret_5B")


@metric("volatility", ("future_ret_5B",))
def _volatility(df: DataFrame) -> DataFrame:
    return deviations(df, ["future_ret_5B"])


@metric("return_quantiles", ("future_ret_5B",))
def _return_quantiles(df: DataFrame) -> DataFrame:
    counted = return_quantiles(df)
    return counted.agg(*[F.count(F.when(F.col("quantiles") == i, 1)).alias(f"bucket_{i}") for i in range(1, 6)])


__all__ = [n for n in dir() if not n.startswith("_")] + ["own"]
