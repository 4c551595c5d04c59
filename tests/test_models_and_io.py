import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.operators import crosssec as X
from panelwright.operators import lookups as L
from panelwright.operators import models as M
from panelwright.operators import strategy as G
from panelwright.operators.recursive import seeded_ema, wilder_adx, wilder_rsi
from panelwright.sources import readers as R
from panelwright.sources import writers as O


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(3)
    rows = []
    for d in range(4):
        for i in range(30):
            a, b, c = rng.normal(size=3)
            rows.append((dt.date(2020, 1, 1 + d), i, float(a), float(b * 1000), float(c), float(2 * a - b + c), None if i == 7 else float(a * b)))
    return spark.createDataFrame(rows, "date date, ticker bigint, f1 double, f2 double, f3 double, y double, z double")


def test_neutralize_against_least_squares(panel):
    got = X.neutralize(panel, ["f1", "f2", "f3"]).toPandas().sort_values(["date", "ticker"])
    src = panel.toPandas().sort_values(["date", "ticker"])
    src["z"] = src["z"].fillna(src.groupby("date")["z"].transform("median"))
    for day, part in src.groupby("date"):
        a = np.column_stack([np.ones(len(part)), part[["f1", "f2", "f3"]]])
        for y in ("y", "z"):
            resid = part[y] - a @ np.linalg.lstsq(a, part[y], rcond=None)[0]
            mine = got[got.date == day]
            assert np.allclose(mine[y], resid, atol=1e-8)
            assert np.allclose(mine[["f1", "f2", "f3"]].T @ mine[y], 0, atol=1e-5)


def test_neutralize_with_redundant_factor(panel):
    twice = panel.withColumn("f4", 2 * F.col("f1"))
    a = X.neutralize(twice, ["f1", "f4"]).select("y").orderBy("y").toPandas()
    b = X.neutralize(panel, ["f1"], exclude=["f2", "f3"]).select("y").orderBy("y").toPandas()
    assert np.allclose(a, b, atol=1e-8)


def test_rolling_models_are_saved_and_appended(panel, tmp_path):
    args = (panel, [(2020, 1)], ["ols"], ["f1", "f2"], "y")
    first = M.fit_rolling(*args, str(tmp_path), "full_train", 1)
    again = M.fit_rolling(*args, str(tmp_path), "load", 1)
    added = M.fit_rolling(panel, [(2020, 1)], ["ols", "lasso"], ["f1", "f2"], "y", str(tmp_path), "append", 1)
    for sets in (again, added):
        assert M.model_coefficients(sets["2020-01"]["ols"], ["f1", "f2"]) == M.model_coefficients(first["2020-01"]["ols"], ["f1", "f2"])
    assert set(added["2020-01"]) == {"ols", "lasso"}


def test_linear_attribution_sums_to_the_prediction(panel):
    model = M.fit(panel, ["f1", "f3"], "y", "ols")
    coef = M.model_coefficients(model, ["f1", "f3"])
    parts = M.linear_attribution(panel.select("date", "ticker", "f1", "f3"), coef).toPandas().sort_values(["date", "ticker"])
    pred = M.predict({"ols": model}, panel, ["f1", "f3"]).toPandas().sort_values(["date", "ticker"])
    total = parts["f1"] + parts["f3"]
    assert np.allclose(total - total.mean(), pred["ols"] - pred["ols"].mean(), atol=1e-9)


def test_recursive_kernels():
    up = np.arange(1.0, 40.0)
    assert wilder_rsi(up, 14)[14] == 100.0 and np.isnan(wilder_rsi(up, 14)[13])
    assert seeded_ema(np.ones(10), 4)[3] == 1.0
    out = wilder_adx(up + 1, up - 1, up, 14)
    assert np.isnan(out[26]) and out[27] == pytest.approx(100.0)
    gap = np.r_[np.nan, np.nan, up]
    assert wilder_rsi(gap, 14)[16] == 100.0


def test_append_keeps_a_mark(spark, tmp_path):
    rows = [(dt.date(2020, 1, d), t, float(d)) for d in range(1, 9) for t in ("A", "B")] + [(dt.date(2020, 1, 3), None, 0.0)]
    df = spark.createDataFrame(rows, "date date, ticker string, x double")
    side = spark.createDataFrame([("A", 1)], "ticker string, dcm_security_id bigint")
    target = str(tmp_path / "t")
    O.append_new(spark, df.where("x <= 4"), target, side)
    for day in (5, 6, 7):  # a feed that brings one new day at a time
        O.append_new(spark, df.where(f"x <= {day}"), target, side)
        assert spark.read.parquet(target).count() == day
    O.append_new(spark, df, target, side)
    O.append_new(spark, df, target, side)
    assert spark.read.parquet(target).count() == 8


def test_empty_strategy_file(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="no content"):
        R.read_strategy(spark, str(tmp_path / "empty.csv"), "Date date, Value double")
    (tmp_path / "one.csv").write_text("Date,Value\n2020-01-01,1.5\n")
    assert R.read_strategy(spark, str(tmp_path / "one.csv"), "Date date, Value double").count() == 1


def test_required_columns_and_lineage(spark, tmp_path):
    df = spark.range(3)
    with pytest.raises(ValueError, match="missing"):
        R.require_columns(df, ["id", "x"])
    O.write_tables({"t": df}, str(tmp_path), shards=2)
    assert len(R.lineage(R.read_table(spark, str(tmp_path / "t")))) == 2


def test_metrics_need_their_columns(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError, match="lacks columns"):
        G.run_metrics(df, ["volatility"])


def test_metric_can_be_added(spark):
    @G.metric("rows_seen")
    def rows_seen(df):
        return df.agg(F.count(F.lit(1)).alias("n"))

    try:
        out = G.run_metrics(spark.range(4), ["rows_seen"]).collect()
        assert [(r.metric, r.field, r.value) for r in out] == [("rows_seen", "n", 4.0)]
    finally:
        del G.METRICS["rows_seen"]


def test_lookups_take_one_or_many(spark):
    side = spark.createDataFrame([(1, "A", "x"), (2, "B", "x"), (3, "C", "y")], "dcm_security_id bigint, ticker string, Sector string")
    assert L.ids_of(side, "A").count() == 1 and L.ids_of(side, ["A", "C"]).count() == 2
    with pytest.raises(TypeError):
        L.ids_of(side, {"A": 1})
    assert [r.ticker for r in L.peers(side, 1, include_self=False).collect()] == ["B"]
    assert L.peers(side, 1).count() == 2
