"""Every registered query against its DuckDB oracle on sf0.001 (exact, order-insensitive)."""

import pytest

import __spark_entry__ as E
import duck_oracle
from bidscope.plans import registry
from tests.compare import assert_same, duck
from tests.conftest import SF_SMALL

QUERIES = registry.all_queries()
SQL = duck_oracle.oracle_queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert_same(QUERIES[name](spark, SF_SMALL), con, SQL[name], name)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    r = rows[0]
    # fixture numbers recorded in FIXTURES.md (sf0.001, test day)
    assert (r.invites, r.bids, r.wins, r.clicks) == (747, 3020, 1983, 485)
    assert (r.page_exp, r.jumps, r.load_fail) == (251, 61, 30)
    assert abs(r.spend_yuan - 461.64317) < 1e-9
