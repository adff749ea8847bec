"""Every registered query gives the rows of its DuckDB statement."""

import pytest

from fixtures.compare import connection, differences
from fixtures.oracle import pipeline_sql
from fixtures.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    with connection(sf_dir) as connected:
        yield connected


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", ["m18_returns", "m19_returns_order_lines"])
def test_first_elements_decide(con, name):
    """The shorter statement of feeds that keep one row per key gives the rows of the full one."""
    full, short = (pipeline_sql(name, rates=True, first=first) for first in (False, True))
    for a, b in ((full, short), (short, full)):
        assert con.execute(f"({a}) except all ({b})").fetchall() == []
