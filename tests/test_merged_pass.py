"""Columns of own rows that go over the grid with Williams %R equal the two tables joined, without a join."""

import datetime as dt
import random

from panelwright.operators import indicators as T
from panelwright.operators import joins as J


def _bars(spark):
    rng, rows = random.Random(5), []
    for ticker in (1, 2, 3, None):
        for day in range(60):
            if rng.random() < 0.6:
                low = rng.choice([None, 5.0, 5.0, rng.uniform(1, 9)])
                rows.append((dt.date(2020, 1, 1) + dt.timedelta(days=day), ticker, low, (low or 5.0) + rng.choice([0.0, 1.5]), low, low, 10.0))
    rows += [(None, 1, 3.0, 4.0, 2.0, 3.5, 1.0), (None, None, 3.0, 4.0, 2.0, 3.5, 1.0), (dt.date(2020, 2, 1), 9, None, None, None, None, None)]
    return spark.createDataFrame(rows, "date date, ticker long, open double, high double, low double, close double, volume double")


def test_one_pass_equals_the_join(spark):
    rows = _bars(spark)
    own = T.OWN_ROWS["past_returns"](rows, lags=[1, 5])
    table = T.indicators(rows, [("past_returns", {"lags": [1, 5]})])
    for n, more in ((5, {}), (14, {"fill_limit": None}), (3, {"fill_limit": 0})):
        want = J.merge_panel(table, [T.willr(rows, n, **more)])
        got = T.with_willr(own, n, **more)
        assert got.columns == want.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        assert got.where(f"WILLR_{n}_MA_3 is not null").count() > 0


def test_merge_query_has_no_join_of_large_tables(spark):
    from panelwright.plans import QUERIES

    plan = QUERIES["j01_merge_feature_tables"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lineitem") + plan.count("l_shipdate") > 0
    assert all("broadcast" in line for line in plan.splitlines() if "Join " in line), plan
