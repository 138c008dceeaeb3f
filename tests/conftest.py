import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from sightline.session import session

    s = session(8, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def rows_of(df):
    """Rows as plain tuples, columns by name, in no order."""
    columns = sorted(df.columns)
    return sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect())))
