import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from slicewise.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session("tests", settings={"spark.sql.warehouse.dir": str(folder / "warehouse")})
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(folder / "checkpoints"))
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def plan(df) -> str:
    return df._jdf.queryExecution().toString()
