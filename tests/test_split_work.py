"""Hot keys and dates cut into pieces, bucketed storage, fits from sums: against plain Python and Spark ML."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.operators import gram, joins, models, order_stats, picks, strategy
from panelwright.plans import joining
from panelwright.sources import buckets, writers

DAY = dt.date(2020, 1, 1)
SF = "/root/testdata/sf0.001"


def runs_of(values, hit):
    best = here = 0
    for v in values:
        here = here + 1 if hit(v) else 0
        best = max(best, here)
    return best


@pytest.fixture(scope="module")
def signs():
    rng = random.Random(4)
    values = []
    while len(values) < 30_000:  # nearly all on one date
        values += [rng.choice([1.0, -2.0, 0.0, None])] * rng.choice([1, 2, 3, 400])
    return [(DAY if 5 < i < 29_000 else DAY + dt.timedelta(days=-1 if i <= 5 else 1), i, v) for i, v in enumerate(values)]


def test_runs_of_one_date_in_many_pieces(spark, signs):
    rows = spark.createDataFrame(signs, "date date, ticker long, x double").repartition(7)
    values = [v for *_, v in signs]
    up, down = runs_of(values, lambda v: v is not None and v > 0), runs_of(values, lambda v: v is not None and v < 0)
    got = strategy.run_ratio(rows, "x").first()
    assert (got.up_periods, got.down_periods) == (up, down) and up > 400
    plan = picks.longest_runs(rows, {"up": F.col("x") > 0})._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "Window" not in plan
    # one mark over everything crosses every border
    assert picks.longest_runs(rows, {"all": F.lit(True)}).first()["all"] == len(signs)


def test_runs_per_group_and_of_nothing(spark, signs):
    rows = spark.createDataFrame(signs[:3000], "date date, ticker long, x double").withColumn("grp", F.col("ticker") % 3)
    got = {r.grp: r.run for r in picks.longest_run(rows, "x", -1, ["grp"]).collect()}
    assert got == {g: runs_of([v for _, i, v in signs[:3000] if i % 3 == g], lambda v: v is not None and v < 0) for g in range(3)}
    assert picks.longest_run(rows.limit(0), "x", 1).collect()[0].run == 0
    assert picks.longest_run(rows.limit(0), "x", 1, ["grp"]).collect() == []


def brute_asof(left, right):
    for i, k, t in left:
        seen = [(u, j) for j, q, u in right if q == k and u <= t]
        yield i, max(seen)[1] if seen else None


@pytest.mark.parametrize("one_moment", [False, True])
def test_asof_splits_a_hot_key_day(spark, one_moment):
    rng = random.Random(2)
    at = lambda: dt.datetime(2020, 1, 5, 12) if one_moment else dt.datetime(2020, 1, 5) + dt.timedelta(seconds=rng.randint(0, 80_000))
    left = [(i, 1, at()) for i in range(900)] + [(i, i % 40, dt.datetime(2020, 1, rng.randint(1, 28), rng.randint(0, 23))) for i in range(900, 1500)]
    right = [(i, 1, dt.datetime(2020, 1, 5) + dt.timedelta(seconds=rng.randint(0, 80_000))) for i in range(700)]
    right += [(i, i % 30, dt.datetime(2020, 1, rng.randint(1, 28), rng.randint(0, 23))) for i in range(700, 900)]
    lf, rf = spark.createDataFrame(left, "i long, k long, ts timestamp"), spark.createDataFrame(right, "j long, k long, ts timestamp")
    got = joins.asof_join(lf, rf, "ts", ["k"], ties=["j"], piece=F.to_date("ts"), bound=100).select("i", "j").collect()
    assert sorted(map(tuple, got)) == sorted(brute_asof(left, right))
    # a cut holds about the bound, a moment shared by many rows is dealt out
    whole = joins.asof_join(lf, rf, "ts", ["k"], ties=["j"], piece=F.to_date("ts"), bound=0)
    assert sorted(map(tuple, whole.select("i", "j").collect())) == sorted(brute_asof(left, right))


def test_paths_expand_strikes_only(spark):
    rows = spark.createDataFrame([(DAY + dt.timedelta(days=i), k, float(i * k)) for k in (1, 2) for i in range(10)], "date date, ticker long, ret_1B double")
    strikes = spark.createDataFrame([(DAY + dt.timedelta(days=8), 1), (DAY + dt.timedelta(days=2), 2), (DAY + dt.timedelta(days=2), 2), (DAY, 9)], "date date, ticker long")
    paths = joins.paths_after(rows, strikes, 3)
    got = sorted((r.ticker, r.strike.day, r.step, r.ret) for r in paths.collect())
    assert got[3:] == [(2, 3, 0, 6.0), (2, 3, 1, 8.0), (2, 3, 2, 10.0)] and [g[3] for g in got[:3]] == [9.0, None, None]
    assert "collect_list" not in paths._jdf.queryExecution().optimizedPlan().toString()


def test_bucketed_merge_moves_no_rows(spark):
    names = joining.bucketed_features(spark, SF, 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of real size
    try:
        merged = buckets.merge_bucketed(spark, names)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(names) == 16 and plan.count("SortMergeJoin") == 15 and "Exchange" not in plan
    assert merged.count() == spark.table(names[0]).count()


def test_bucketed_merge_moves_no_rows_in_a_plain_session(spark, monkeypatch):
    made, plain = [], buckets.write_bucketed
    monkeypatch.setattr(buckets, "write_bucketed", lambda *a, **k: made.append((a[1], k["aligned"])) or plain(*a, **k))
    names = joining.bucketed_features(spark, SF)
    assert made[0] == ("bars", True)  # bars lie by security in as many pieces as buckets
    settings = {buckets.CO_PARTITION: "true", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    want = sorted(map(str, buckets.merge_bucketed(spark, names).collect()))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        merged = buckets.merge_bucketed(spark, names)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(str, merged.collect()))
        assert spark.conf.get(buckets.CO_PARTITION) == "true"  # the caller's session stays as it is
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert plan.count("SortMergeJoin") == 15 and "Exchange" not in plan
    assert got == want and len(got) == spark.table(names[0]).count()


def test_bucketed_load_of_an_empty_table(spark, tmp_path):
    name = buckets.write_bucketed(spark.createDataFrame([], "date date, ticker long, x double"), "odd name!", str(tmp_path), 3)
    assert spark.table(name).count() == 0


# ---- fits from sums


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(6)
    n = 4000
    x = rng.normal(size=(n, 3)) @ np.array([[1, 0.6, 0], [0, 1, 0.2], [0, 0, 1]])
    y = x @ [0.3, -0.2, 0.0] + rng.normal(size=n) * 0.5 + 1
    rows = [(DAY + dt.timedelta(days=31 * (i % 24)), i, *map(float, x[i]), float(y[i]), int(i % 5)) for i in range(n)]
    rows[7] = (*rows[7][:2], None, *rows[7][3:])
    x[7, 0] = 0
    return spark.createDataFrame(rows, "date date, ticker long, a double, b double, c double, y double, fold int").repartition(4), x, y, np.arange(n)


def test_fits_equal_spark_ml(panel):
    df, *_ = panel
    feats = ["a", "b", "c"]
    grid = [("ols", 0.0, 1.0), ("lasso", 0.05, 1.0), ("enet", 0.05, 0.5)]
    for row in gram.fits(gram.moments(df, feats, "y"), feats, [], grid).collect():
        params = {"tol": 1e-12, "maxIter": 1000} | ({} if row.algo == "ols" else {"regParam": row.reg})
        model = models.fit(df, feats, "y", row.algo, **params).stages[1]
        assert np.allclose([row.intercept, *row.weights], [model.intercept, *model.coefficients], atol=1e-4), row.algo  # its descent is iterative


def test_folds_are_total_less_fold(panel):
    df, x, y, i = panel
    tried = gram.cross_validate(df, ["a", "b", "c"], "y", "fold", [("ols", 0.0, 1.0)]).collect()
    assert len(tried) == 5
    for row in tried:
        held = i % 5 == row.fold
        design = np.column_stack([np.ones(len(x)), x])
        beta = np.linalg.lstsq(design[~held], y[~held], rcond=None)[0]
        left = y[held] - design[held] @ beta
        assert np.allclose([row.intercept, *row.weights], beta) and np.isclose(row.r2, 1 - left @ left / ((y[held] - y[held].mean()) ** 2).sum())


def test_rolling_fits_read_the_panel_once(panel):
    df, x, y, i = panel
    fitted = gram.rolling_fits(df, ["a", "b", "c"], "y", [("ols", 0.0, 1.0)], n_dates=6)
    design = np.column_stack([np.ones(len(x)), x])
    rows = sorted(fitted.collect(), key=lambda r: r.model_date)
    assert len(rows) == 24
    for k, row in enumerate(rows):
        mine = (i % 24 <= k) & (i % 24 > k - 6)
        assert np.allclose([row.intercept, *row.weights], np.linalg.lstsq(design[mine], y[mine], rcond=None)[0])
    sums = gram.rolling_moments(df, ["a", "b", "c"], "y", 6)
    assert sums._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    scored = gram.predict_rolling(df, fitted, ["a", "b", "c"], ["ols"])
    one = {r.ticker: r.ols for r in scored.where("ticker in (30, 31)").collect()}
    assert np.isclose(one[30], np.array([rows[6].intercept, *rows[6].weights]) @ design[30])


def test_features_without_spread_and_no_rows(spark):
    flat = spark.createDataFrame([(1.0, 2.0, 3.0), (1.0, 3.0, 5.0), (1.0, 4.0, 7.0)], "a double, b double, y double")
    row = gram.fits(gram.moments(flat, ["a", "b"], "y"), ["a", "b"], [], [("ols", 0.0, 1.0)]).first()
    assert np.allclose([row.intercept, *row.weights], [-1, 0, 2])
    none = gram.fits(gram.moments(flat.limit(0), ["a", "b"], "y"), ["a", "b"], [], [("ols", 0.0, 1.0)]).first()
    assert none.intercept is None or np.isnan(none.intercept)


# ---- order statistics


@pytest.fixture(scope="module")
def narrow(spark):
    """40 000 values in a 0.4 % range and a few far away."""
    rng = np.random.default_rng(3)
    values = np.concatenate([1000 + 4 * rng.random(40_000), [1e-300, -5.0, 1e300, 0.0], np.full(500, 1002.0)])
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i long, x double").repartition(5), values


def test_a_narrow_range_is_spread(spark, narrow):
    df, values = narrow
    rows = df.select(F.lit(0).alias("g"), "x", order_stats.chunk_of(F.col("x")).alias("chunk"))
    counts = rows.groupBy("g", "chunk", F.col("x").alias("value")).agg(F.count("*").alias("n")).join(order_stats._chunk_counts(rows, ["g"], "x"), ["g", "chunk"])
    assert counts.groupBy("chunk").count().agg(F.max("count")).first()[0] > 30_000
    cut = order_stats.cut_of(F.col("value"), F.col("_low"), F.col("_high"))
    assert counts.groupBy("chunk", cut).count().agg(F.max("count")).first()[0] < 60  # ordered in one task
    got = {r.i: r.r for r in order_stats.avg_rank(df, "x", "r", [], spread=True).collect()}
    order = np.argsort(values, kind="stable")
    first = np.searchsorted(values[order], values, "left")
    last = np.searchsorted(values[order], values, "right")
    assert np.allclose([got[i] for i in range(len(values))], (first + 1 + last) / 2)


def test_quantiles_of_a_narrow_range(narrow):
    df, values = narrow
    probs = [0.0, 0.005, 0.25, 0.5, 0.995, 1.0]
    got = order_stats.quantiles(df, ["x"], probs, [], spread=True).first().q_x
    assert np.allclose(got[1:5], np.quantile(values, probs[1:5]), rtol=1e-12) and got[0] == -5.0 and got[5] == 1e300


# ---- appends by day


def test_appends_by_day_can_be_repeated(spark, tmp_path):
    rows = [(dt.date(2020, 1, d), "A", float(d)) for d in range(1, 6)] + [(dt.date(2020, 1, 3), "A", 3.0), (dt.date(2020, 1, 2), "B", 0.0), (dt.date(2020, 1, 2), None, 0.0)]
    df = spark.createDataFrame(rows, "date date, ticker string, x double")
    side = spark.createDataFrame([("A", 1)], "ticker string, dcm_security_id bigint")
    target, held = str(tmp_path / "t"), lambda: sorted((r.date.day, r.x) for r in writers.read_days(spark, target).collect())
    writers.append_days(spark, df.where("x <= 3").dropDuplicates(), target, side)
    writers.append_days(spark, df.where("x <= 3").dropDuplicates(), target, side)
    assert held() == [(1, 1.0), (2, 2.0), (3, 3.0)]
    # a late row of the mark's own day, twice there, and new days
    writers.append_days(spark, df, target, side)
    assert held() == [(1, 1.0), (2, 2.0), (3, 3.0), (3, 3.0), (4, 4.0), (5, 5.0)]
    # a delivery that fails halfway leaves the table as it was, and runs again
    broken = df.withColumn("x", F.when(F.col("date") == "2020-01-05", F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("x") + 1))
    with pytest.raises(Exception, match="lost"):
        writers.append_days(spark, broken, target, side)
    assert len(held()) == 6
    # a feed that brings only what is new
    writers.append_days(spark, spark.createDataFrame([(dt.date(2020, 1, 5), "A", 5.5), (dt.date(2020, 1, 6), "A", 6.0)], df.schema), target, side)
    writers.append_days(spark, df, target, side)
    assert held()[4:] == [(4, 4.0), (5, 5.0), (5, 5.5), (6, 6.0)]
