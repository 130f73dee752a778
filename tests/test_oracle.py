"""Every registered query against its SQL oracle on the small tables."""

import pytest

from oracle_check import compare, connect
from sitegauge.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    _, verdict = compare(spark, con, QUERIES[name], ORACLES.get(name), SF)
    assert verdict in ("ok", "rows-only")
