import os
import sys
from datetime import datetime, timezone

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.dirname(os.path.abspath(__file__))):
    if folder not in sys.path:
        sys.path.insert(0, folder)

from wattloom.schema import FACT_COLUMNS, FACT_DDL  # noqa: E402
from wattloom.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "wattloom-tests", "local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def events(spark):
    """Builds a fact frame from partial rows; missing columns get their empty value."""
    empty = {"string": "", "int": 0, "double": 0.0}

    def build(*rows: dict):
        full = [
            tuple(at(r["timestamp"]) if n == "timestamp" else r.get(n, empty.get(t)) for n, t in FACT_COLUMNS)
            for r in ({"event_id": f"{i:06d}", **row} for i, row in enumerate(rows))
        ]
        return spark.createDataFrame(full, FACT_DDL)

    return build
