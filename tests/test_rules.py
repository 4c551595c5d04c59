"""Hand fixtures for the null rules, ranks, buckets, folds, calendar and runs."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.functions import columns as C
from panelwright.operators import calendar as CAL
from panelwright.operators import crosssec as X
from panelwright.operators import indicators
from panelwright.operators import joins as J
from panelwright.operators import order_stats as Q
from panelwright.operators import picks as K
from panelwright.operators import recursive
from panelwright.operators import strategy as G
from panelwright.operators.grid import densify
from panelwright.operators.recursive import ewm
from panelwright.operators.sizes import attach
from panelwright.sources import readers as R


def near(got, want, tol=1e-6):
    assert len(got) == len(want), (got, want)
    for a, b in zip(got, want):
        assert (a is None and b is None) or (a is not None and b is not None and abs(a - b) <= tol), (got, want)


GAP = [1, 2, None, 4, 5, 6]
FILL = [10, None, None, None, None, 12, 15]


def test_rolling_needs_every_row(series, values):
    df = series(GAP)
    near(values(df.withColumn("y", C.rolling("x", 3)), "y"), [None] * 5 + [5])
    near(values(df.withColumn("y", C.rolling("x", 3, "std")), "y"), [None] * 5 + [1])
    near(values(df.withColumn("y", C.rolling("x", 3, "avg", 1)), "y"), [1, 1.5, 1.5, 3, 4.5, 5])


def test_bounded_fill(series, values):
    near(values(series(FILL).withColumn("y", C.ffill("x", 3)), "y"), [10, 10, 10, 10, None, 12, 15])


@pytest.mark.parametrize("limit,shift", [(1, 0), (3, 0), (2, 1), (3, 2)])
def test_carry_equals_ffill(series, values, limit, shift):
    df = series(FILL)
    want = values(df.withColumn("y", C.ffill("x", limit, shift=shift)), "y")
    near(values(C.carry(df, ["x"], limit, shift=shift), "x"), want)


def test_pct_change(series, values):
    df = series(FILL)
    near(values(C.pct_change(df, "x", 1, "y"), "y"), [None, 0, 0, 0, 0, 0.2, 0.25])
    near(values(C.pct_change(df, "x", 1, "y", pad=False), "y"), [None] * 6 + [0.25])


def test_half_even(series, values):
    near(values(series([0.125]).withColumn("y", C.half_even("x", 2)), "y"), [0.12])
    near(values(series([2.5, 3.5]).withColumn("y", C.half_even("x", 0)), "y"), [2, 4])


@pytest.mark.parametrize("n", [1, 2, 5, 9, 16])
@pytest.mark.parametrize("fn", ["max", "min"])
def test_rolling_extreme_equals_window(series, values, n, fn):
    df = series([5, 3, 8, 8, 1, 9, None, 2, 2, 7, 4, 6, 0, 3, 5, 1, 8, 2, 9, 9, 4, 4, 1, 3, 6, 2])
    want = values(df.withColumn("y", C.rolling("x", n, fn)), "y")
    near(values(C.rolling_extreme(df, "x", n, fn, "y"), "y"), want)


def test_rolling_moments_equal_window(series, values):
    df = series([0.1, -0.2, 0.05, 0.3, None, 0.2, 0.1, -0.4, 0.25, 0.15]).withColumn("b", F.col("x") * F.col("x") - 0.1)
    w = C.own().rowsBetween(-2, 0)
    got = C.rolling_moments(df, "x", "b", 3)
    full = F.count("x").over(w) == 3
    near(values(got, "cov"), values(df.withColumn("y", F.when(full, F.covar_samp("x", "b").over(w))), "y"))
    near(values(got, "var_a"), values(df.withColumn("y", F.when(full, F.var_samp("x").over(w))), "y"))


def test_cumulative_product_any_sign(series, values):
    near(values(series([0.5, -2.0, 0.1, -1.0, 0.3]).withColumn("y", C.cumprod1("x")), "y"), [0.5, -2.5, -2.65, -1, -1])


def day(spark, xs):
    rows = [(dt.date(2020, 1, 1), i, None if x is None else float(x)) for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "date date, ticker bigint, x double")


def test_zscore_and_clip(spark, values):
    scored = X.with_moments(day(spark, [1, 2, 3, 100]), ["x"]).withColumn("z", X.zscore("x"))
    near(values(scored, "z", "ticker"), [-0.520336, -0.499931, -0.479525, 1.499792])
    flat = X.with_moments(day(spark, [5, 5, 5]), ["x"]).withColumn("z", X.zscore("x"))
    near(values(flat, "z", "ticker"), [0, 0, 0])
    near(values(Q.winsorize(day(spark, [1, 2, 3, 100]), ["x"]), "x", "ticker"), [1.015, 2, 3, 98.545])


def test_standardize_properties(spark):
    rows = [(dt.date(2020, 1, 1 + d), i, float((i * 7 + d * 3) % 23) ** 2) for d in range(3) for i in range(40)]
    out = X.standardize(spark.createDataFrame(rows, "date date, ticker bigint, x double"))
    for row in out.groupBy("date").agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s")).collect():
        assert abs(row.m) < 1e-9 and abs(row.s - 1) < 1e-9


def test_average_rank(spark, values):
    df = day(spark, [3, 1, 3, None, 2])
    near(values(Q.avg_rank(df, "x", "r"), "r", "ticker"), [3.5, 1, 3.5, None, 2])
    near(values(Q.avg_rank(df, "x", "r", pct=True), "r", "ticker"), [0.875, 0.25, 0.875, None, 0.5])


@pytest.mark.parametrize(
    "xs,want",
    [
        (list(range(1, 11)), [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]),
        ([0, 0, 0, 0, 1, 2, 3, 4, 5, 6], [0, 0, 0, 0, 1, 1, 2, 2, 3, 3]),
        ([7, 7, 7], [None, None, None]),
        ([-3, None, 5, -1e-9, 0.0, 2e6], None),
    ],
)
def test_qcut(spark, values, xs, want):
    got = values(Q.qcut(day(spark, xs), "x", 5, ["date"]), "x_qt", "ticker")
    if want is not None:
        assert got == want
    assert got == values(Q.qcut(day(spark, xs), "x", 5), "x_qt", "ticker")


def test_quantiles_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(7)
    data = np.concatenate([rng.normal(0, 1e-3, 400), rng.lognormal(3, 4, 400), np.zeros(500), -rng.lognormal(0, 2, 100)])
    df = spark.createDataFrame([(i % 3, float(x)) for i, x in enumerate(data)], "g int, x double")
    probs = [0.0, 0.005, 0.25, 0.5, 0.77, 0.995, 1.0]
    for row in Q.quantiles(df, ["x"], probs, ["g"]).collect():
        near(row.q_x, list(np.quantile(data[row.g :: 3], probs)), 1e-9 * max(1.0, abs(data).max()))
    ranks = {(r.g, r.x): r.before for r in Q.value_ranks(df, "x", ["g"]).collect()}
    for g in range(3):
        part = np.sort(data[g::3])
        for x in (0.0, part[10], part[-1]):
            assert ranks[(g, float(x))] == int(np.searchsorted(part, x))


def test_folds(spark, values):
    days = ["2010-12-31", "2012-09-28", "2013-01-01", "2020-01-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("date"))
    cuts = ["2010-12-31", "2012-09-28"]
    assert values(X.fold_by_cuts(df, cuts), "fold_id") == [0, 1, 2, 2]
    assert values(X.fold_by_cuts(df, cuts, right=False), "fold_id") == [1, 2, 2, 2]


def test_insample_bins(spark):
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=7 * i), 1) for i in range(6)]
    df = spark.createDataFrame(rows, "date date, ticker bigint")
    out = X.insample(df, 2020, 2, 6).orderBy("date").collect()
    assert [r.fold_id for r in out] == [0, 0, 1, 2, 3, 4]


def test_ewm(series, values):
    near(values(ewm(series([1, 2, 3, 4]), "x", 3, out="y"), "y"), [None, None, 2.428571, 3.266667])


def days_of(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "d string").select(F.to_date("d").alias("date"))


def test_asof_by_day_and_by_key(spark, values):
    right = days_of(spark, "2020-01-02", "2020-01-06").withColumn("v", F.when(F.day("date") == 2, 1).otherwise(2))
    left = days_of(spark, "2020-01-01", "2020-01-06", "2020-01-13")
    assert values(J.asof_join(left, right), "v") == [None, 2, 2]
    keyed = J.asof_join(left.withColumn("k", F.lit(1)), right.withColumn("k", F.lit(1)), "date", ["k"])
    assert values(keyed, "v") == [None, 2, 2]
    old = J.asof_join(left.withColumn("k", F.lit(1)), right.withColumn("k", F.lit(1)), "date", ["k"], tolerance=3)
    assert values(old, "v") == [None, 2, None]


def test_asof_crosses_pieces(spark, values):
    right = days_of(spark, "2020-01-02").withColumns({"k": F.lit(1), "v": F.lit(9)})
    left = days_of(spark, "2019-12-31", "2020-01-31", "2020-05-04", "2021-02-01").withColumn("k", F.lit(1))
    assert values(J.asof_join(left, right, "date", ["k"]), "v") == [None, 9, 9, 9]


def test_paths_end_with_nulls(series):
    returns = series([0.1, 0.2, 0.3, 0.4, 0.5], "ret_1B")
    strike = returns.where(F.col("date") == F.lit("2020-01-04").cast("date"))
    got = [r.ret for r in J.paths_after(returns, strike, 3).orderBy("step").collect()]
    near(got, [0.5, None, None])


def moved(spark, k, text):
    return CAL.offset_days(days_of(spark, text), "date", CAL.calendar(spark), k).collect()[0].date.isoformat()


def test_calendar_offsets(spark):
    assert moved(spark, 1, "2018-12-01") == "2018-12-03"
    assert moved(spark, 0, "2018-12-01") == "2018-12-03"
    assert moved(spark, -1, "2018-12-01") == "2018-11-30"
    assert moved(spark, 1, "2018-12-04") == "2018-12-06"


def test_calendar_days(spark):
    open_days = {r.date.isoformat() for r in CAL.calendar(spark, "1997-01-01", "2022-12-31").where("is_open").collect()}
    closed = ["2019-04-19", "2000-04-21", "2001-09-13", "2012-10-29", "2022-06-20", "2021-12-24", "2015-07-03", "2019-09-02", "1998-01-19"]
    assert not open_days & set(closed)
    assert {"1997-01-20", "2021-06-18", "2022-12-27", "2010-12-31"} <= open_days
    lit = [F.lit(x).cast("date") for x in ("2019-08-30", "2019-09-10")]
    weeks = CAL.sample_dates(CAL.calendar(spark), "w-mon", *lit)
    assert sorted(r.date.isoformat() for r in weeks.collect()) == ["2019-09-03", "2019-09-09"]


def test_month_start_after_filing(spark):
    got = days_of(spark, "2018-08-15").select(CAL.next_month_start("date").alias("d")).collect()[0].d
    assert got == dt.date(2018, 9, 3)


def test_runs(series):
    df = series([1, 1, 1, -1, -1, 1, 1, -1, 1])
    row = G.run_ratio(df, "x").collect()[0]
    assert (row.up_periods, row.down_periods, row.up_down_ratio) == (3, 2, 1.5)
    assert K.longest_run(df, "x", 1, ["ticker"], ["date"], []).collect()[0].run == 3


def test_drawdown(series, values):
    out = C.drawdown(series([0.1, -0.5, 0.2]), "x", ["ticker"])
    near(values(out, "peak"), [1.1, 1.1, 1.1])
    assert abs(min(values(out, "drawdown")) + 0.5) < 1e-12


def test_densify_counts(spark):
    rows = [(dt.date(2020, 1, d), t, float(d)) for d, t in [(1, 1), (3, 1), (2, 2), (5, 3), (1, 3)]]
    df = spark.createDataFrame(rows, "date date, ticker bigint, x double")
    grid = densify(df)
    assert grid.count() == 4 * 3
    assert grid.where("x is not null").count() == 5
    assert grid.select("date", "ticker").distinct().count() == 12


def test_activity_has_the_whole_universe(spark):
    rows = [(dt.date(2020, 1, 1), 1, 0.0), (dt.date(2020, 1, 1), 2, 1e-7), (dt.date(2020, 1, 2), 2, None)]
    df = spark.createDataFrame(rows, "date date, ticker bigint, r double")
    names = spark.createDataFrame([(1,), (2,), (9,)], "ticker bigint")
    got = {(r.date.day, r.ticker): r.is_active for r in X.activity(df, names, "r").collect()}
    assert got == {(1, 1): 0, (1, 2): 1, (2, 1): 0, (2, 2): 0, (1, 9): 0, (2, 9): 0}
    assert sum(r.is_active for r in X.activity(df, names, "r", eps=1e-6).collect()) == 0


def test_stable_sample(spark):
    df = spark.range(101).withColumn("g", F.col("id") % 2)
    a = K.stable_sample(df, 0.5, "id", ["g"])
    assert sorted(r["count"] for r in a.groupBy("g").count().collect()) == [25, 25]
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, K.stable_sample(df, 0.5, "id", ["g"]).collect()))


def test_stable_sample_counts_rows_that_share_an_id(spark):
    df = spark.createDataFrame([(1, x) for x in range(7)] + [(2, 9)] * 3, "id bigint, x bigint")
    got = sorted(map(tuple, K.stable_sample(df, 0.5, "id").collect()))
    assert len(got) == 5 and not set(got) - set(map(tuple, df.collect()))
    assert got == sorted(map(tuple, K.stable_sample(df, 0.5, "id").collect()))


def test_densify_repeated_rows(spark):
    rows = [(dt.date(2020, 1, d), t, x) for d, t, x in [(1, 1, 1.0), (3, 1, 2.0), (3, 1, 3.0), (2, 2, 4.0), (4, 2, 5.0)]]
    grid = densify(spark.createDataFrame(rows, "date date, ticker bigint, x double")).where("ticker = 1")
    got = sorted((r.date.day, r.x or 0.0) for r in grid.collect())
    assert got == [(1, 1.0), (2, 0.0), (3, 2.0), (3, 3.0), (4, 0.0)]


def test_nan_is_missing_on_scan(spark, tmp_path):
    spark.createDataFrame([(1, float("nan"), "a"), (2, 1.5, None)], "k int, `x.y` double, s string").write.parquet(f"{tmp_path}/t")
    assert sorted(map(tuple, R.read_table(spark, f"{tmp_path}/t").collect())) == [(1, None, "a"), (2, 1.5, None)]
    kept = R.read_table(spark, f"{tmp_path}/t", nan_missing=False).where("k = 1").first()
    assert kept["x.y"] != kept["x.y"]


def test_one_nan_leaves_moments_after_its_window(series, values):
    df = series([0.1, float("nan"), 0.05, 0.3, 0.1, 0.2]).withColumn("b", F.lit(1.0) - F.col("x") * F.col("x"))
    near(values(C.rolling_moments(df, "x", "b", 3), "var_a"), [None] * 4 + [0.0175, 0.01])


def test_a_time_is_not_broadcast_as_a_day(spark):
    def plan(kind):
        left = spark.range(10).select(F.timestamp_seconds(F.col("id")).cast(kind).alias("date"), "id")
        right = left.groupBy("date").agg(F.max("id").alias("m"))
        return attach(left, right, ["date"], max_rows=100)._jdf.queryExecution().analyzed().toString()

    assert "strategy=broadcast" in plan("date")
    assert "strategy=broadcast" not in plan("timestamp")


def test_keyless_asof_takes_one_row_a_day(spark):
    day = dt.date(2020, 1, 1)
    left = spark.createDataFrame([(day, 1), (day + dt.timedelta(1), 1)], "date date, ticker bigint")
    right = spark.createDataFrame([(day, 1.0), (day, 3.0)], "date date, m double")
    assert [r.m for r in J.asof_join(left, right).collect()] == [3.0, 3.0]
    assert [r.m for r in X.attach_macro(left, right).orderBy("date").collect()] == [3.0, None]


def test_past_strikes_keep_all(spark):
    for n in (3, 8):
        df = spark.createDataFrame([(dt.date(2020, 1, 1 + i), 1, 4) for i in range(n)], "date date, ticker bigint, ensemble_qt int")
        assert G.past_strikes(df).count() == n
        assert G.past_strikes(df, drop_last=True).count() == n - 1


def test_assembled_symbols_fill_over_days(spark):
    rows = [(1, "A", 1, 5.0, 1.0), (1, "A", 2, None, 2.0), (2, "A", 1, None, 3.0), (2, "B", 1, 7.0, None), (3, "B", 1, 8.0, None)]
    df = spark.createDataFrame([(dt.date(2020, 1, d), *x) for d, *x in rows], "date date, symbol string, n int, close double, volume double")
    got = [tuple(r)[1:] for r in R.assemble_symbols(df, ["A", "B"], order=["n"]).orderBy("date").collect()]
    assert got == [(5.0, 2.0, None, None), (5.0, 3.0, 7.0, None), (None, None, 8.0, None)]


def test_factor_without_values_is_left_out(spark):
    rows = [(dt.date(2020, 1, 1), i, float(i), None, 2.0 * i + (i % 2)) for i in range(6)]
    df = spark.createDataFrame(rows, "date date, ticker bigint, a double, b double, y double")
    both, one = (X.neutralize(df.select("date", "ticker", *f, "y"), f).orderBy("ticker").collect() for f in (["a", "b"], ["a"]))
    near([r.y for r in both], [r.y for r in one], 1e-9)


def test_smoothing_steps():
    """Vectorised recursions against the steps they stand for."""
    rng = np.random.default_rng(3)
    x = np.cumsum(rng.normal(size=60)) + 50
    n, change = 5, np.diff(x)
    up, down = np.maximum(change, 0), np.maximum(-change, 0)
    gain, loss, want = up[:n].mean(), down[:n].mean(), []
    for i in range(n - 1, len(change)):
        if i >= n:
            gain, loss = (gain * (n - 1) + up[i]) / n, (loss * (n - 1) + down[i]) / n
        want.append(100 * gain / (gain + loss))
    got = recursive.wilder_rsi(x, n)
    assert np.isnan(got[:n]).all() and np.allclose(got[n:], want)
    gap = x.copy()
    gap[30] = np.nan
    assert np.allclose(recursive.wilder_rsi(gap, n)[:30], got[:30], equal_nan=True) and np.isnan(recursive.wilder_rsi(gap, n)[30:]).all()
    flat = np.full(20, 3.0)
    assert (recursive.wilder_rsi(flat, n)[n:] == 0).all() and (recursive.wilder_adx(flat, flat, flat, n)[2 * n - 1 :] == 0).all()


def test_configurations_on_own_rows_share_one_sort(spark):
    rows = spark.createDataFrame(
        [(dt.date(2020, 1, 1) + dt.timedelta(days=i), t, 1.0 + i, 2.0 + i, 0.5 + i, 1.5 + i, 10.0) for i in range(6) for t in (1, 2)],
        "date date, ticker bigint, open double, high double, low double, close double, volume double",
    )
    configs = [("ppo", {"fast": 2, "slow": 3}), ("stochf", {"fastk": 2, "fastd": 2}), ("past_returns", {"lags": [1]}), ("volatility", {"lookbacks": [2]})]
    both = indicators.indicators(rows, configs)
    assert both.columns[:3] == ["date", "ticker", "PPO_2_3"] and both.columns[-2:] == ["ret_1B", "volatility_2"]
    alone = {(r.date, r.ticker): r.PPO_2_3 for r in indicators.ppo(rows, 2, 3).collect()}
    assert {(r.date, r.ticker): r.PPO_2_3 for r in both.collect()} == alone
    own = indicators.indicators(rows, [configs[0], *configs[2:]])
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_numbers_as_text(spark):
    rows = spark.createDataFrame([(1.5,), (-0.25,), (0.0,), (None,)], "x double")
    found = rows.select(C.percent_text("x").alias("p"), C.signed_text("x").alias("s")).collect()
    assert [tuple(r) for r in found] == [("1.50%", "+1.50"), ("-0.25%", "-0.25"), ("0.00%", "0.00"), (None, None)]


@pytest.mark.parametrize("fn", ["sum", "avg", "std", "var", "max", "min"])
@pytest.mark.parametrize("n,shift", [(5, 0), (12, 0), (21, 1), (26, 0)])
def test_rolled_equals_window(series, values, n, shift, fn):
    xs = [((i * 37) % 11) * 1.5 - 4 if i not in (3, 60) else None for i in range(100)] + [0.1] * 60
    df = series(xs)
    want = values(df.withColumn("y", C.rolling("x", n, fn, shift=shift)), "y")
    got = C.rolled(df, {"y": ("x", n, fn), "z": ("x", 13, "avg")}, shift=shift)
    near(values(got, "y"), want)
    assert got.columns == ["date", "ticker", "x", "y", "z"]
    if fn == "std":
        assert values(got, "y")[-1] == 0.0


def test_rolled_frames_are_short(series):
    """No window over a long lookback goes through it row by row."""
    import re

    from panelwright.operators import indicators as T

    df = series([100.0 + i for i in range(5)], "close")
    plan = T.volatility(df, (126,))._jdf.queryExecution().optimizedPlan().toString()
    assert max(int(k) for k in re.findall(r"specifiedwindowframe\(RowFrame, -(\d+), currentrow", plan)) < 30
