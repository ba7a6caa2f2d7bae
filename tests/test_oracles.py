"""Every registered query against the same query as SQL in DuckDB."""

from __future__ import annotations

import os

import pytest

from adpulse.plans import oracles, registry
from tests.compare import connect, difference

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(registry()) == set(oracles())


@pytest.mark.parametrize("name", list(registry()))
def test_query_matches_oracle(spark, duck, name):
    got = registry()[name](spark, SF).toPandas()
    want = duck.execute(oracles()[name]).df()
    assert len(want) > 0
    assert difference(got, want) is None
