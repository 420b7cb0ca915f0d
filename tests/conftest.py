import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quantloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.driver.memory": "6g", "spark.checkpoint.dir": shared,
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def rows(df, *columns):
    """Sorted tuples of a frame."""
    names = columns or df.columns
    return sorted((tuple(r) for r in df.select(*names).collect()), key=lambda t: tuple((x is not None, x) for x in t))


def days(spark, texts):
    """A calendar of the given ISO days."""
    from quantloom.operators.calendar import session_calendar

    return session_calendar(spark.createDataFrame([(t,) for t in texts], "date string"))
