import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from spinmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples, NULL as a value of its own."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))

    return collect


@pytest.fixture
def plan_of(spark):
    """Formatted physical plan of a DataFrame, nothing cut off."""

    def explain(df):
        return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")

    return explain
