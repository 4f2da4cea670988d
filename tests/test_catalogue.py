"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from checks.compare import difference
from checks.queries import ORACLE
from martlet.plans.catalog import QUERIES


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE])
def test_query_matches_sql(src, con, name):
    assert difference(QUERIES[name](src), con, ORACLE[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() == 8
    assert set(queries()) >= set(QUERIES) and set(oracle_sql()) >= set(ORACLE)
    assert set(oracle_sql()) <= set(queries())
