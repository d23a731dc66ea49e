"""Windows with EXCLUDE over doubles that aren't whole numbers: the digits of the SQL."""

import duckdb
import pytest

from quern.plans import operator_queries


@pytest.mark.parametrize("name", ["window_exclude_any", "window_exclude_group_any", "window_exclude_ties_any", "window_exclude_none"])
def test_fractions(spark, tmp_path, name):
    con = duckdb.connect()
    con.execute(f"COPY (SELECT i % 8000 AS l_suppkey, i AS l_orderkey, round(1 + (hash(i) % 50000000) / 1e6, 6)::DOUBLE AS l_quantity FROM range(1, 40001) t(i)) TO '{tmp_path}/lineitem.parquet'")
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet'")
    columns = "l_suppkey, l_orderkey, a_sum, a_count, a_min, a_max, a_avg"
    want = con.execute(f"SELECT {columns} FROM ({operator_queries.ORACLE_SQL[name]}) ORDER BY 1, 2").fetchall()
    found = operator_queries.QUERIES[name](spark, str(tmp_path)).select(*columns.split(", ")).collect()
    assert sorted(map(tuple, found), key=lambda r: r[:2]) == want
