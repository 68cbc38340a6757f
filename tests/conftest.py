from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderlens.session import build_session  # noqa: E402
from orderlens.sources import COLUMNS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "orderlens-tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={"spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    """Builds a 24-column text frame from dicts that name only the columns they fill."""
    schema = ", ".join(f"`{name}` STRING" for name in COLUMNS)

    def build(rows):
        return spark.createDataFrame([[row.get(name) for name in COLUMNS] for row in rows], schema)

    return build


@pytest.fixture(scope="session")
def column(spark):
    """Evaluates a function of one column over single values."""

    def evaluate(expression, values, kind="string"):
        frame = spark.createDataFrame([(value,) for value in values], f"x {kind}")
        return [row[0] for row in frame.select(expression(frame["x"])).collect()]

    return evaluate
