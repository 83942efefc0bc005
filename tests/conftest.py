import os
import sys

import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sample_readings import patterned  # noqa: E402
from wayspan.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def grid(spark):
    """30 patterned days of 3 routes, with calendar columns."""
    from wayspan.operators.clean import with_calendar

    return with_calendar(spark.createDataFrame(patterned(30))).cache()


@pytest.fixture(scope="session")
def grid_pd():
    df = patterned(30)
    df["timestamp"] = pd.to_datetime(df[["year", "month", "day", "hour"]])
    df["day_of_week"] = df["timestamp"].dt.day_name()
    return df
