import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def inputs(spark):
    from altigrid.plans.views import Inputs

    return Inputs(spark, SMALL)


@pytest.fixture(scope="session")
def readings(inputs):
    from altigrid.sources.points import dem_bounds

    return dem_bounds(inputs.dem())


@pytest.fixture
def lines(spark):
    def make(*text):
        return spark.createDataFrame([(t,) for t in text], "line string")

    return make


@pytest.fixture
def plan():
    """Text of the physical plan."""
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text


@pytest.fixture
def rows():
    """Rows as a sorted list of tuples."""
    def sorted_rows(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted(tuple(r) for r in picked.collect())

    return sorted_rows
