"""Ranks and quantiles of groups by day, and buckets by the size of the input."""

import datetime as dt

import numpy as np
import pandas as pd

from panelwright.operators import order_stats, sizes
from panelwright.plans import joining
from panelwright.plans import views as V

DAY = dt.date(2020, 1, 1)
SF = "/root/testdata/sf0.001"


def _rows(spark):
    rng = np.random.default_rng(3)
    rows = [(DAY + dt.timedelta(days=d), k, float(np.round(rng.normal(), 2))) for d in range(3) for k in range(120)]
    odd = [None, float("nan"), -0.0, 0.0, 0.0, 1e300, -1e300, 5e-324, float("inf"), float("-inf")]
    rows += [(DAY, 200 + k, x) for k, x in enumerate(odd)] + [(DAY, 300, 0.5), (DAY, 300, 0.5), (None, 301, 1.0), (None, 302, None)]
    return spark.createDataFrame(rows, "date date, ticker long, x double")


def test_day_ranks_move_rows_once(spark):
    df = _rows(spark)
    got = order_stats.avg_rank(df, "x", "r")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of real size
    try:
        plan = order_stats.avg_rank(df, "x", "r")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Exchange hashpartitioning") <= 4
    assert got.columns == ["date", "ticker", "x", "r"] and got.count() == df.count()
    for pct, out in ((False, got), (True, order_stats.avg_rank(df, "x", "r", pct=True))):
        plain = [(r.date, r.ticker, r.x, r.r) for r in out.collect()]
        assert all(r is None for d, _, _, r in plain if d is None)
        found = pd.DataFrame([p for p in plain if p[0] is not None], columns=["date", "ticker", "x", "r"])
        found["want"] = (found["x"].astype(float) + 0.0).groupby(found["date"]).rank(pct=pct)
        assert np.allclose(found["r"].astype(float), found["want"], equal_nan=True)
        assert found["r"].isna().sum() == 2


def test_day_quantiles_count_few_chunks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    values = rng.uniform(1.0, 2.0, 400)
    df = spark.createDataFrame([(DAY, k, float(x)) for k, x in enumerate(values)], "date date, ticker long, x double")
    counts, plain = [], order_stats._chunk_counts
    monkeypatch.setattr(order_stats, "_chunk_counts", lambda *a: counts.append(plain(*a)) or counts[-1])
    got = order_stats.quantiles(df, ["x"], [0.005, 0.5, 0.995]).first()["q_x"]
    assert np.allclose(got, np.quantile(values, [0.005, 0.5, 0.995]))
    assert counts[0].count() < 12  # a chunk a value, or nearly, does not shrink before it moves


def test_buckets_grow_with_the_ticks(spark, monkeypatch):
    monkeypatch.setattr(sizes, "PIECE", 1000)
    ticks = V.ticks(spark, SF).count()
    name = joining.bucketed_features(spark, SF)[0]
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert int(facts["Num Buckets"]) == max(4, -(-ticks // 1000)) != 8
