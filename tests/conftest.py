import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewatch.session import configure  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def rows():
    """Collect a DataFrame as a sorted list of tuples; nulls sort last."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted(
            (tuple(row) for row in picked.collect()),
            key=lambda row: [(value is None, str(value)) for value in row],
        )

    return collect


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
