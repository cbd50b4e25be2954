import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bidlens.session import build_session  # noqa: E402
from bidlens.sources.workspace import work_dir  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark_driver_memory="6g",
                            spark_sql_shuffle_partitions="4", spark_ui_enabled="false",
                            spark_ui_showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return work_dir(spark, "test")


@pytest.fixture(scope="session")
def data(spark):
    from fixtures.views import Data

    return Data(spark, SMALL)


def rows(df, *columns):
    """Rows as sorted tuples."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=repr)
