from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tripflow.session import create_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = create_session(
        {
            "spark.master": "local[8]",
            "spark.driver.memory": "6g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            # short queries gain more from a quick JIT than from an optimising one
            "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1",
            "spark.ui.showConsoleProgress": "false",
        }
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small():
    """The smallest test-table directory."""
    return "/root/testdata/sf0.001"


@pytest.fixture
def zone_of_session(spark):
    """Set the session time zone for one test."""
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda zone: spark.conf.set("spark.sql.session.timeZone", zone)
    spark.conf.set("spark.sql.session.timeZone", before)
