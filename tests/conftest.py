"""One Spark session for all tests, and small corpora."""

from __future__ import annotations

import os

import pytest

from tagloom.fixed_values import DEFAULT_LABELS
from tagloom.session import build_session


# Predictors defined in test modules are imported by the Python workers.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [os.path.dirname(__file__), *filter(None, [os.environ.get("PYTHONPATH")])]
)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tagloom-tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def corpus(spark):
    """27 labels with ten distinct texts each."""
    rows = [
        (number * 10 + copy, f"please {label.replace('_', ' ')} number {copy}", label, f"category_{copy}")
        for number, label in enumerate(DEFAULT_LABELS)
        for copy in range(10)
    ]
    return spark.createDataFrame(rows, "row_id bigint, instruction string, intent string, category string")
