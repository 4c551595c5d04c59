import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelwright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]",
        "tests",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def series(spark):
    """One security from a list of values on consecutive days."""
    import datetime as dt

    def make(values, name="x", ticker=1, start=dt.date(2020, 1, 1)):
        rows = [(start + dt.timedelta(days=i), ticker, None if v is None else float(v)) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, f"date date, ticker bigint, {name} double")

    return make


@pytest.fixture(scope="session")
def values():
    def read(df, col, order="date"):
        return [row[col] for row in df.orderBy(order).select(col).collect()]

    return read
