"""Every query of the library that has SQL, against another engine over the same tables."""

import compare
import pytest

from quern.plans import client_queries, function_cases, io_queries, more_function_cases, operator_queries, sql_queries

SETS = (sql_queries, operator_queries, io_queries, function_cases, more_function_cases, client_queries)
QUERIES = {n: (m.QUERIES[n], m.ORACLE_SQL[n]) for m in SETS for n in m.QUERIES if n in m.ORACLE_SQL}


@pytest.fixture(scope="module")
def con():
    return compare.connect()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    query, sql = QUERIES[name]
    assert compare.difference(spark, query, sql, compare.SF_DIR, con) == ""
