"""Steps that several parts of a query read are made once; grids open no more cells than are read."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelwright.operators import crosssec as X
from panelwright.operators import indicators as T
from panelwright.operators.grid import densify
from panelwright.plans import QUERIES

START = dt.date(2001, 1, 1)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Ticks of six securities over 14 months."""
    rnd, folder, rows = random.Random(5), tmp_path_factory.mktemp("tables"), []
    for i in range(1200):
        day = dt.datetime.combine(START + dt.timedelta(days=rnd.randrange(420)), dt.time())
        rows.append((i, i % 50, 1 + i % 6, 1, float(rnd.randrange(1, 50)), float(rnd.randrange(1000, 90000)), 0.05, 0.02, "ANR"[i % 3], "FO"[i % 2], day))
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(rows, names).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["g13_forecast_band", "x08_population_split"])
def test_result_reads_written_tables_not_ticks(spark, tables, name):
    df = QUERIES[name](spark, tables)
    assert not [f for f in df.inputFiles() if "lineitem" in f]
    assert df.count() > 0


def test_membership_opens_only_the_days_it_may_keep(spark):
    day = lambda i: START + dt.timedelta(days=i)
    rows = [(day(0), "a", 1, 0.5), (day(3), "a", 1, None), (day(40), "a", 1, None), (day(41), "a", 1, 0.2), (day(90), "b", 2, 0.1), (day(90), "b", 2, 0.3)]
    members = spark.createDataFrame(rows, "date date, cusip string, dcm_security_id long, `wt-r1` double")
    days = spark.createDataFrame([(day(i),) for i in range(100)], "date date")
    short = densify(members, days, "cusip", lead_in=False, reach=5)
    whole = densify(members, days, "cusip", lead_in=False)
    assert short.count() < whole.count() / 4
    assert short.where("`wt-r1` is not null").count() == 4
    kept = {(r.cusip, (r.date - START).days) for r in X.fill_membership(members, days, ["wt-r1"], 5).collect()}
    assert kept == {("a", i) for i in [*range(6), *range(41, 47)]} | {("b", i) for i in range(90, 96)}


def test_cap_as_a_column_is_the_cap_of_a_table(spark):
    rows = [(START, 1, 2.0, 5.0), (START, 2, 3.0, None), (START, None, 4.0, None)]
    panel = spark.createDataFrame(rows, "date date, ticker long, close double, marketcap double")
    members = spark.createDataFrame([(START, "C1", 1, 0.4, 0.1, None)], "date date, cusip string, dcm_security_id long, `wt-r1` double, `wt-r1g` double, `wt-r1v` double")
    by_column = X.universe(panel, members, "marketcap")
    by_table = X.universe(panel.drop("marketcap"), members, panel.where("ticker is not null").select("date", "ticker", "marketcap"))
    assert by_column.columns == by_table.columns
    assert sorted(map(str, by_column.collect())) == sorted(map(str, by_table.collect()))


def test_grid_and_liquidity_order_rows_once(spark):
    rows = [(START + dt.timedelta(days=3 * i + i % 2), t, float(50 + (i * 7 + t) % 13), float(i % 4)) for t in (1, 2) for i in range(120)]
    prices = spark.createDataFrame(rows, "date date, ticker long, close double, volume double").groupBy("ticker", "date").agg(F.max("close").alias("close"), F.sum("volume").alias("volume"))
    placed = prices.repartition(4, "ticker").sortWithinPartitions("ticker", "date")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "_seq#" not in "".join(line for line in plan(densify(placed)).splitlines() if "Sort [" in line)
    out = T.liquidity(prices)
    assert plan(out).count("Window [") <= 6  # two of them number the days
    # idle days are those without volume; the row before counts
    grid = densify(prices)
    days = [r.date for r in grid.where("ticker = 1").orderBy("date").collect()]
    idle = {(r.ticker, r.date): r.zerodays for r in out.collect()}
    quiet = {(r.ticker, r.date) for r in grid.where("volume = 0").collect()}
    for i in (21, 60, len(days) - 1):
        assert idle[1, days[i]] == sum((1, d) in quiet for d in days[i - 21 : i])
    assert all((1, d) not in idle or idle[1, d] is None for d in days[:21])
