from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from millrace.session import build_session

TESTDATA = "/root/testdata"
START = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def event_log(tmp_path_factory):
    return tmp_path_factory.mktemp("event_log")


@pytest.fixture(scope="session")
def spark(event_log, tmp_path_factory):
    session = build_session(
        "local[8]",
        **{
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": str(event_log),
            "spark.eventLog.compress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def set_conf(key: str, value: str) -> None:
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_conf
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def at(minutes: float) -> datetime:
    """That many minutes after the start of 2024."""
    return START + timedelta(minutes=minutes)
