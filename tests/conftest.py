from __future__ import annotations

import datetime as dt

import pytest

from funnelry.session import build_session

NOON = dt.datetime(2026, 3, 1, 12, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def hours(n: float) -> dt.datetime:
    """A time n hours after a fixed start."""
    return NOON + dt.timedelta(hours=n)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
