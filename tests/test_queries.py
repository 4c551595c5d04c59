"""Registered queries against their SQL at the smallest scale."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check  # noqa: E402

from panelwright.plans import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
# one query per family; tools/check.py runs them all
CHOSEN = [
    "flagship_momentum_quintiles", "s02_tick_bars", "r01_densify", "w04_pct_change", "w09_percent_rank", "x02_standardize",
    "x04_qcut_global", "x08_population_split", "t03_williams_r_63", "t05_adx", "t15_beta", "t16_correlation", "t17_liquidity",
    "j08_asof_backward", "j09_filings_asof_daily", "j15_paths_after_strikes", "c03_offset_days", "r04_transform_macro",
    "m05_ensemble", "m15_factor_return", "g02_return_summary", "g05_run_ratio", "i02_contribution_shares", "i06_waterfall", "snk03_incremental_append",
    "s02_stream_bars", "s03_stream_append", "t20_many_configurations", "t01_stochastic_rsi_14_5_3", "t05_adx_5_grid",
    "src18_lineage", "src19_intervals_from_text", "fn_percent_and_signed_text", "fn_display_names",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", CHOSEN)
def test_query(spark, con, name):
    _, text, ok = check.compare(spark, con, QUERIES[name], ORACLES[name], SF)
    assert ok, text


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
