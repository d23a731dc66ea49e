"""Queries whose SQL means the same to Spark and to the oracle: one text serves both."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The text over the tables in sf_dir (those that it names)."""
    for t in TABLES:
        if t in text:
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    return spark.sql(text)


TEXTS: dict[str, str] = {
    # projections, filters, predicates
    "filter_and_project": "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS price FROM lineitem WHERE l_quantity BETWEEN 10 AND 12 AND l_returnflag IN ('A', 'R') AND l_discount <> 0.05",
    "three_valued_logic": "SELECT p_partkey, (CASE WHEN p_size > 25 THEN NULL ELSE p_size > 10 END) AND p_size % 2 = 0 AS a, (CASE WHEN p_size > 25 THEN NULL ELSE p_size > 10 END) OR p_size % 2 = 0 AS b, NULLIF(p_size, 7) IS DISTINCT FROM 8 AS c, (p_size > 10) IS NOT TRUE AS d FROM part",
    "case_and_coalesce": "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 1000 THEN 'low' ELSE 'high' END AS level, COALESCE(NULLIF(c_nationkey, 3), -1) AS nation FROM customer",
    "casts": "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS i, CAST(l_linenumber AS VARCHAR(10)) AS s, CAST(l_extendedprice AS DECIMAL(18,2)) AS d, CAST(l_shipdate AS DATE) AS day, TRY_CAST(l_returnflag AS INTEGER) AS n FROM lineitem",
    "alias_reuse": "SELECT p_partkey, p_size * 2 AS twice, twice + 1 AS more FROM part",
    "not_in_with_nulls": "SELECT s_suppkey FROM supplier WHERE s_nationkey NOT IN (SELECT CASE WHEN n_nationkey > 20 THEN NULL ELSE n_nationkey END FROM nation WHERE n_regionkey IN (1, 3)) OR s_nationkey = 4",
    "select_distinct": "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem",
    "group_by_all": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL",
    "values_rows": "SELECT a, b FROM (VALUES (1, 'x'), (2, 'y'), (3, NULL)) AS t(a, b)",
    # joins
    "join_inner": "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'",
    "join_left": "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 300000",
    "join_right": "SELECT c_custkey, o_orderkey FROM orders RIGHT JOIN customer ON c_custkey = o_custkey AND o_totalprice > 300000",
    "join_full": "SELECT s_suppkey, c_custkey FROM supplier FULL OUTER JOIN customer ON s_suppkey = c_custkey AND c_mktsegment = 'BUILDING'",
    "join_semi": "SELECT c_custkey FROM customer LEFT SEMI JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F'",
    "join_anti": "SELECT c_custkey FROM customer LEFT ANTI JOIN orders ON c_custkey = o_custkey",
    "join_cross": "SELECT r_name, n_name FROM region CROSS JOIN nation",
    "join_using": "SELECT l_orderkey, count(*) AS n FROM (SELECT l_orderkey, l_partkey FROM lineitem) a JOIN (SELECT o_orderkey AS l_orderkey FROM orders WHERE o_orderstatus = 'P') b USING (l_orderkey) GROUP BY l_orderkey",
    "join_natural": "SELECT * FROM (SELECT n_regionkey AS k, n_name FROM nation) a NATURAL JOIN (SELECT r_regionkey AS k, r_name FROM region) b",
    "join_null_safe": "SELECT a.x AS x, b.y AS y FROM (SELECT NULLIF(p_size, 1) AS x FROM part) a JOIN (SELECT DISTINCT NULLIF(p_size, 2) AS y FROM part) b ON a.x IS NOT DISTINCT FROM b.y",
    "join_theta": "SELECT s_suppkey, n_nationkey FROM supplier JOIN nation ON s_acctbal > n_nationkey * 400 AND s_nationkey < n_nationkey",
    "join_lateral": "SELECT c_custkey, t.o_orderkey, t.o_totalprice FROM customer, LATERAL (SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 1) t",
    # subqueries and CTEs
    "subquery_scalar": "SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT 1.5 * avg(o_totalprice) FROM orders)",
    "subquery_exists": "SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 49)",
    "subquery_not_exists": "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus <> 'O')",
    "subquery_in": "SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)",
    "subquery_not_in": "SELECT s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49 AND l_discount > 0.08)",
    "subquery_correlated": "SELECT o_orderkey FROM orders o WHERE o_totalprice >= (SELECT max(o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)",
    "cte": "WITH big AS (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey), best AS (SELECT max(total) AS top FROM big) SELECT o_custkey, round(total, 2) AS total FROM big, best WHERE total > top / 2",
    "recursive_cte": "WITH RECURSIVE t(n, f) AS (SELECT 1, CAST(1 AS BIGINT) UNION ALL SELECT n + 1, f * (n + 1) FROM t WHERE n < 15) SELECT n, f FROM t",
    # aggregation
    "aggregate_grouped": "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS q, min(l_shipdate) AS first, max(l_shipdate) AS last, count(*) AS n, round(avg(l_discount), 2) AS d FROM lineitem GROUP BY l_returnflag, l_linestatus",
    "aggregate_ungrouped": "SELECT count(*) AS n, sum(l_quantity) AS q, max(l_extendedprice) AS m FROM lineitem",
    "aggregate_distinct": "SELECT l_returnflag, count(DISTINCT l_suppkey) AS s, count(DISTINCT l_partkey) AS p, sum(DISTINCT l_linenumber) AS l FROM lineitem GROUP BY l_returnflag",
    "aggregate_filter_having": "SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS r, sum(l_quantity) FILTER (WHERE l_discount > 0.05) AS q FROM lineitem GROUP BY l_suppkey HAVING count(*) > 20",
    "grouping_sets": "SELECT l_returnflag, l_linestatus, grouping(l_returnflag) AS g, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())",
    "cube": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)",
    "rollup": "SELECT r_name, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)",
    # windows
    "window_ranks": "SELECT c_custkey, row_number() OVER w AS rn, rank() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) AS rk, dense_rank() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) AS dr, percent_rank() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) AS pr, cume_dist() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) AS cd, ntile(4) OVER w AS nt FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey)",
    "window_offsets": "SELECT o_orderkey, lag(o_totalprice, 2, -1.0) OVER w AS lg, lead(o_totalprice) OVER w AS ld, first_value(o_totalprice) OVER w AS fv, last_value(o_totalprice) OVER w AS lv, nth_value(o_totalprice, 3) OVER w AS nv FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)",
    "window_ignore_nulls": "SELECT o_orderkey, last_value(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) IGNORE NULLS OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS lv FROM orders",
    "window_rows": "SELECT l_orderkey, l_linenumber, l_partkey, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS s, round(avg(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 4) AS a FROM lineitem",
    "window_range": "SELECT l_orderkey, l_linenumber, sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_partkey RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS s FROM lineitem",
    "window_filter": "SELECT l_orderkey, l_linenumber, sum(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END) OVER (PARTITION BY l_orderkey) AS s FROM lineitem",
    # sort, limit, sets
    "order_limit_offset": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 7",
    "union_all": "SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region",
    "union_distinct": "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier",
    "intersect": "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier",
    "intersect_all": "SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier",
    "except": "SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier GROUP BY s_nationkey HAVING avg(s_acctbal) > 4500",
    "except_all": "SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier",
    # reports
    "q1_pricing_summary": "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price, round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_disc_price, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge, round(avg(l_quantity), 4) AS avg_qty, round(avg(l_extendedprice), 2) AS avg_price, round(avg(l_discount), 2) AS avg_disc, count(*) AS count_order FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus",
    "q3_shipping_priority": "SELECT l_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, o_orderdate FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE c_mktsegment = 'BUILDING' AND o_orderdate < TIMESTAMP '1995-03-15 00:00:00' AND l_shipdate > TIMESTAMP '1995-03-15 00:00:00' GROUP BY l_orderkey, o_orderdate",
    "q5_local_supplier": "SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name",
    "q6_forecast": "SELECT CAST(sum(CAST(l_extendedprice * l_discount AS DECIMAL(18,4))) AS DOUBLE) AS revenue FROM lineitem WHERE l_shipdate >= TIMESTAMP '1994-01-01 00:00:00' AND l_shipdate < TIMESTAMP '1995-01-01 00:00:00' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24",
    "q10_returns": "SELECT c_custkey, c_name, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY c_custkey, c_name",
    "q18_large_orders": "SELECT o_orderkey, o_totalprice, q FROM orders JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 250) b ON o_orderkey = l_orderkey",
    "events_by_hour": "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2",
}
#: Where the oracle spells it otherwise.
OTHER: dict[str, tuple[str, str]] = {
    "join_semi": ("LEFT SEMI JOIN", "SEMI JOIN"),
    "window_ignore_nulls": ("END) IGNORE NULLS", "END IGNORE NULLS)"),
    "join_anti": ("LEFT ANTI JOIN", "ANTI JOIN"),
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {n: (lambda spark, sf_dir, t=t: sql(spark, sf_dir, t)) for n, t in TEXTS.items()}
ORACLE_SQL: dict[str, str] = {n: t.replace(*OTHER.get(n, ("\0", ""))) for n, t in TEXTS.items()}
