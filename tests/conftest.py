from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.compare import duck  # noqa: E402
from martlet.session import build_session  # noqa: E402
from martlet.sources.registry import Sources, derived_sources  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "martlet-tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "1000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def src(spark) -> Sources:
    return derived_sources(spark, SF_DIR)


@pytest.fixture(scope="session")
def con():
    return duck(SF_DIR)


@pytest.fixture
def tables(spark):
    """Sources over hand-made frames: ``tables(orders=df, ...)``."""

    def make(**frames) -> Sources:
        return Sources(spark, lambda name: frames[name])

    return make


def rows(df, *names):
    """The frame's rows as a set of tuples."""
    return {tuple(r) for r in (df.select(*names) if names else df).collect()}
