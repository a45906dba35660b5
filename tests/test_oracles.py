"""Every query against its DuckDB SQL; those without SQL run."""

import oracle
import pytest

from rillflow.plans import registry

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    if name in ORACLES:
        assert oracle.differences(spark, QUERIES[name], ORACLES[name], sf) == ""
    else:
        assert QUERIES[name](spark, sf).columns


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
