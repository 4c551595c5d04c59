import datetime as dt
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.functions import columns as C
from panelwright.operators import joins as J
from panelwright.operators import strategy as G
from panelwright.streaming import streams as ST
from panelwright.streaming.partials import Store, update_metrics

SCHEMA = "date date, ticker bigint, ensemble_qt int, ensemble double, future_ret_5B double"


def predictions(seed, days, n, rounded=3):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        ret = None if rng.random() < 0.05 else float(np.round(rng.normal(scale=0.05), rounded))
        date = None if rng.random() < 0.02 else dt.date(2020, 1, 25) + dt.timedelta(days=int(rng.integers(days)))
        rows.append((date, int(rng.integers(6)), int(rng.integers(5)), float(rng.random()), ret))
    return rows


def as_dict(df):
    return {(r.metric, r.field): r.value for r in df.collect()}


def same(got, want):
    assert set(got) == set(want)
    for key, x in want.items():
        assert got[key] == x or math.isclose(got[key], x, rel_tol=1e-9, abs_tol=1e-12), (key, got[key], x)


def test_kept_metrics_equal_those_of_all_rows(spark, tmp_path):
    """Three batches whose days overlap, with ties, nulls and repeated rows; the table itself is never read."""
    source, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    parts = [predictions(1, 60, 80), predictions(2, 20, 40), predictions(2, 20, 40)[:7] + predictions(3, 90, 60, 1)]
    schema = spark.createDataFrame([], SCHEMA).schema

    def load():
        ST.stream_metrics(ST.read_files(spark, source, schema), str(tmp_path / "no-table"), target, state).awaitTermination()

    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        load()
    made = spark.read.parquet(target)
    for i in (0, 2):
        want = as_dict(G.run_metrics(spark.createDataFrame(sum(parts[: i + 1], []), SCHEMA).coalesce(1)))
        same(as_dict(made.where(F.col("batch_id") == i)), want)
    for name in ("2", ".2.crc"):  # as if the last batch had failed after writing
        os.remove(f"{state}/commits/{name}")
    load()
    same(as_dict(spark.read.parquet(target).where("batch_id = 2")), want)


@pytest.mark.parametrize("rets", [[0.5, 0.5, 0.5], [None, None], [0.0, -0.0, 1.0, 1.0, 1.0, 1.0, 1.0, 2.0]])
def test_kept_metrics_of_hard_columns(spark, tmp_path, rets):
    rows = [(dt.date(2020, 1, 1 + i), 1, 4 if i % 2 else 0, 0.7, x) for i, x in enumerate(rets)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    names = ["return_quantiles", "runs", "volatility"]
    same(as_dict(update_metrics(df, Store(spark, str(tmp_path), 0), names)), as_dict(G.run_metrics(df, names)))


def test_own_metric_reads_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(G.METRICS, "rows", ((), lambda df: df.agg(F.count(F.lit(1)).alias("n"))))
    df = spark.createDataFrame(predictions(4, 5, 9), SCHEMA)
    df.write.parquet(str(tmp_path / "in"))
    args = ST.read_files(spark, str(tmp_path / "in"), df.schema), str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    ST.stream_metrics(*args, ["rows", "accuracy"]).awaitTermination()
    got = as_dict(spark.read.parquet(str(tmp_path / "out")))
    assert got[("rows", "n")] == got[("accuracy", "number_of_predictions")] == 9


@pytest.mark.parametrize("n", [2, 5, 7, 16])
def test_rolling_moments_forget_what_left_the_window(series, values, n):
    small = [((i * 7) % 11 - 5) / 1000 for i in range(40)]
    df = series([1e9, -3e8, *small]).withColumn("b", F.col("x") * 0.5 + F.when(F.dayofmonth("date") % 3 == 0, 0.001).otherwise(0.0))
    w = C.own().rowsBetween(-(n - 1), 0)
    got = C.rolling_moments(df, "x", "b", n)
    for name, want in (("cov", F.covar_samp("x", "b")), ("var_a", F.var_samp("x"))):
        exact = values(df.withColumn("y", want.over(w)), "y")[n + 1 :]
        assert np.allclose(values(got, name)[n + 1 :], exact, rtol=1e-9, atol=1e-15)


def test_models_in_force(spark):
    day = lambda x: dt.date(2020, 1, x)
    rows = spark.createDataFrame([(day(x), x) for x in (1, 5, 9, 10, 30, 30)], "date date, ticker bigint")
    models = spark.createDataFrame([(day(5), 1.0), (day(10), 2.0)], "model_date date, k double")
    got = J.in_force(rows, models)
    assert sorted((r.ticker, r.model_date.day, r.k) for r in got.collect()) == [(1, 5, 1.0), (5, 5, 1.0), (9, 5, 1.0), (10, 10, 2.0), (30, 10, 2.0), (30, 10, 2.0)]
    preds = rows.crossJoin(models)
    assert sorted(map(tuple, J.stitch_segments(preds, models).collect())) == sorted(map(tuple, got.select("date", "ticker", "model_date", "k").collect()))
