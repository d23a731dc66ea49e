"""Queries over this library's own operators, next to SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import aggregates
from quern.operators import changes, joins, rows, sets, windows
from quern.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return keep


def _events(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    views = e.where("event_type = 'view'").select(F.col("event_id").alias("v_id"), F.col("user_id").alias("v_user"), F.col("ts").alias("v_ts"))
    return e.select("event_id", "user_id", "ts"), views


_VIEWS = "(SELECT event_id AS v_id, user_id AS v_user, ts AS v_ts FROM events WHERE event_type = 'view')"


@query(f"SELECT event_id, user_id, ts, v_ts FROM events ASOF LEFT JOIN {_VIEWS} v ON user_id = v_user AND ts >= v_ts")
def asof_left(spark, sf_dir):
    e, v = _events(spark, sf_dir)
    return joins.asof_join(e, v, "ts", "v_ts", [("user_id", "v_user")]).select("event_id", "user_id", "ts", "v_ts")


@query(f"SELECT event_id, v_ts FROM events ASOF JOIN {_VIEWS} v ON user_id = v_user AND ts > v_ts")
def asof_inner_strict(spark, sf_dir):
    e, v = _events(spark, sf_dir)
    return joins.asof_join(e, v, "ts", "v_ts", [("user_id", "v_user")], "inner", ">").select("event_id", "v_ts")


@query(f"SELECT event_id, v_ts FROM events ASOF JOIN {_VIEWS} v ON user_id = v_user AND ts <= v_ts")
def asof_forward(spark, sf_dir):
    e, v = _events(spark, sf_dir)
    return joins.asof_join(e, v, "ts", "v_ts", [("user_id", "v_user")], "inner", "<=").select("event_id", "v_ts")


@query(f"SELECT event_id FROM events WHERE NOT EXISTS (SELECT 1 FROM {_VIEWS} v WHERE v_user = user_id AND ts >= v_ts)")
def asof_anti(spark, sf_dir):
    e, v = _events(spark, sf_dir)
    return joins.asof_join(e, v, "ts", "v_ts", [("user_id", "v_user")], "anti").select("event_id")


@query("SELECT event_id, s_suppkey FROM events JOIN supplier ON value BETWEEN s_acctbal / 100 AND s_acctbal / 100 + 2")
def range_join(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_acctbal") / 100).alias("low"), (F.col("s_acctbal") / 100 + 2).alias("high"))
    return joins.range_join(table(spark, sf_dir, "events").select("event_id", "value"), s, "value", "low", "high", 5.0).select("event_id", "s_suppkey")


@query("SELECT a.o_orderkey AS a, b.s_suppkey AS b FROM orders a JOIN supplier b ON a.o_totalprice <= b.s_acctbal + 500 AND b.s_acctbal <= a.o_totalprice + 1000")
def overlap_join(spark, sf_dir):
    a = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("a"), F.col("o_totalprice").alias("a0"), (F.col("o_totalprice") + 1000).alias("a1"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("b"), F.col("s_acctbal").alias("b0"), (F.col("s_acctbal") + 500).alias("b1"))
    return joins.overlap_join(a, b, "a0", "a1", "b0", "b1", 2000.0).select("a", "b")


@query("SELECT n_name, s_suppkey FROM (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) AS k FROM nation) FULL JOIN (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS k FROM supplier) USING (k)")
def positional_join(spark, sf_dir):
    return joins.positional_join(table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier"), ["n_nationkey"], ["s_suppkey"]).select("n_name", "s_suppkey")


@query("SELECT c_custkey FROM customer WHERE c_acctbal > ALL (SELECT s_acctbal FROM supplier WHERE s_nationkey < 5)")
def compare_all(spark, sf_dir):
    return joins.compare_all(table(spark, sf_dir, "customer"), "c_acctbal", ">", table(spark, sf_dir, "supplier").where("s_nationkey < 5"), "s_acctbal", True).select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_acctbal < ANY (SELECT s_acctbal FROM supplier WHERE s_nationkey < 5)")
def compare_any(spark, sf_dir):
    return joins.compare_all(table(spark, sf_dir, "customer"), "c_acctbal", "<", table(spark, sf_dir, "supplier").where("s_nationkey < 5"), "s_acctbal", False).select("c_custkey")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS row_number FROM orders")
def row_numbers(spark, sf_dir):
    return rows.numbered(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"]).select("o_orderkey", "row_number")


@query("SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_totalprice DESC, o_orderkey")
def distinct_on(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return rows.distinct_on(o, ["o_custkey"], [-F.col("o_totalprice"), F.col("o_orderkey")])


@query("SELECT o_orderkey, o_custkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) <= 2")
def qualify(spark, sf_dir):
    w = windows.Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return rows.qualify(table(spark, sf_dir, "orders"), F.row_number().over(w) <= 2).select("o_orderkey", "o_custkey")


@query("SELECT * EXCLUDE (p_type) REPLACE (p_size * 2 AS p_size) RENAME (p_name AS label) FROM part")
def star_expression(spark, sf_dir):
    return rows.star(table(spark, sf_dir, "part"), ["p_type"], {"p_size": F.col("p_size") * 2}, {"p_name": "label"})


@query("SELECT COLUMNS('s_(suppkey|acctbal)') FROM supplier")
def star_columns(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return s.select(*rows.columns(s, "s_(suppkey|acctbal)"))


@query("SELECT p_partkey, unnest(range(p_size % 4)) AS a, unnest(string_split(p_type, ' ')) AS b FROM part")
def unnest(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.expr("CASE WHEN p_size % 4 > 0 THEN sequence(0L, p_size % 4 - 1L) ELSE array() END").alias("a"), F.split("p_type", " ").alias("b"))
    return rows.unnest(p, ["a", "b"])


@query("SELECT o_orderpriority, max(o_totalprice) FILTER (o_orderstatus = 'F') AS F, max(o_totalprice) FILTER (o_orderstatus = 'O') AS O, max(o_totalprice) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY o_orderpriority")
def pivot(spark, sf_dir):
    return rows.pivot(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderstatus", F.max("o_totalprice"), ["F", "O", "P"])


@query("UNPIVOT (SELECT s_suppkey, s_acctbal, s_nationkey::DOUBLE AS s_nationkey FROM supplier) ON s_acctbal, s_nationkey INTO NAME name VALUE value")
def unpivot(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", F.col("s_nationkey").cast("double"))
    return rows.unpivot(s, ["s_suppkey"], ["s_acctbal", "s_nationkey"])


@query("SELECT column_name, min, max, count FROM (SUMMARIZE (SELECT p_partkey, p_size FROM part))")
def summarize(spark, sf_dir):
    return rows.summarize(table(spark, sf_dir, "part").select("p_partkey", "p_size")).select("column_name", "min", "max", "count")


@query("SELECT s_suppkey FROM supplier ORDER BY s_acctbal, s_suppkey LIMIT 10%")
def limit_percent(spark, sf_dir):
    return rows.limit_percent(table(spark, sf_dir, "supplier"), 10, [F.col("s_acctbal"), F.col("s_suppkey")]).select("s_suppkey")


@query("SELECT count(*) AS n FROM (SELECT * FROM orders USING SAMPLE 100 ROWS)")
def sample_rows(spark, sf_dir):
    return rows.sample_rows(table(spark, sf_dir, "orders"), 100).agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_partkey GROUPS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS s FROM lineitem")
def window_groups(spark, sf_dir):
    out = windows.groups_frame(table(spark, sf_dir, "lineitem"), lambda w: F.sum("l_quantity").over(w), ["l_suppkey"], "l_partkey", -1, 1, "s")
    return out.select("l_orderkey", "l_linenumber", "s")


_SOLD = "(SELECT l_suppkey, l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_suppkey, l_orderkey)"


def _sold(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_orderkey").agg(F.sum("l_quantity").alias("q"))


@query(f"SELECT l_suppkey, l_orderkey, sum(q) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING EXCLUDE CURRENT ROW) AS s FROM {_SOLD}")
def window_exclude_row(spark, sf_dir):
    return _sold(spark, sf_dir).select("l_suppkey", "l_orderkey", windows.exclude("q", ["l_suppkey"], "l_orderkey", -2, 2, "CURRENT ROW").alias("s"))


@query(f"SELECT l_suppkey, l_orderkey, sum(q) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING EXCLUDE GROUP) AS s FROM {_SOLD}")
def window_exclude_group(spark, sf_dir):
    return _sold(spark, sf_dir).select("l_suppkey", "l_orderkey", windows.exclude("q", ["l_suppkey"], "l_orderkey", -2, 2, "GROUP").alias("s"))


@query(f"SELECT l_suppkey, l_orderkey, sum(q) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING EXCLUDE TIES) AS s FROM {_SOLD}")
def window_exclude_ties(spark, sf_dir):
    return _sold(spark, sf_dir).select("l_suppkey", "l_orderkey", windows.exclude("q", ["l_suppkey"], "l_orderkey", -2, 2, "TIES").alias("s"))


@query("SELECT s_suppkey, round(fill(CASE WHEN s_suppkey % 3 = 1 THEN s_acctbal END ORDER BY s_suppkey) OVER (PARTITION BY s_nationkey ORDER BY s_suppkey), 4) AS y FROM supplier")
def window_fill(spark, sf_dir):
    t = table(spark, sf_dir, "supplier").withColumn("y", F.expr("CASE WHEN s_suppkey % 3 = 1 THEN s_acctbal END"))
    return t.select("s_suppkey", F.round(windows.fill("y", ["s_nationkey"], "s_suppkey"), 4).alias("y"))


@query("SELECT l_orderkey, l_linenumber, sum(DISTINCT l_quantity) OVER (PARTITION BY l_suppkey) AS s FROM lineitem")
def window_distinct(spark, sf_dir):
    return windows.distinct_sum(table(spark, sf_dir, "lineitem"), "l_quantity", ["l_suppkey"], "s").select("l_orderkey", "l_linenumber", "s")


_KEYED = "(SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS k, c_nationkey, c_acctbal FROM customer)"


def _keyed(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", F.expr("CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END").alias("k"), "c_nationkey", "c_acctbal")


@query(f"SELECT c_custkey, sum(DISTINCT c_nationkey) OVER (PARTITION BY k) AS s, count(DISTINCT c_nationkey) FILTER (c_acctbal > 0) OVER (PARTITION BY k) AS n FROM {_KEYED}")
def window_distinct_null_keys(spark, sf_dir):
    one = windows.distinct_sum(_keyed(spark, sf_dir), "c_nationkey", ["k"], "s")
    return windows.distinct_aggregate(one, F.count, "c_nationkey", ["k"], "n", F.col("c_acctbal") > 0).select("c_custkey", "s", "n")


@query(f"SELECT k, round(mad(c_acctbal), 6) AS mad FROM {_KEYED} GROUP BY k")
def agg_mad_null_keys(spark, sf_dir):
    return aggregates.mad(_keyed(spark, sf_dir), ["k"], "c_acctbal").withColumn("mad", F.round("mad", 6))


_INFINITE = "(SELECT l_suppkey, l_orderkey, CASE WHEN l_orderkey % 50 = 0 THEN 'inf'::DOUBLE ELSE sum(l_quantity) END AS q FROM lineitem GROUP BY l_suppkey, l_orderkey)"


def _excluding(what: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sold = _sold(spark, sf_dir).withColumn("q", F.when(F.col("l_orderkey") % 50 == 0, F.lit(float("inf"))).otherwise(F.col("q")))
        found = [windows.exclude("q", ["l_suppkey"], "l_orderkey", -2, 2, what, how).alias(f"a_{how}") for how in ("sum", "count", "min", "max", "avg")]
        return sold.select("l_suppkey", "l_orderkey", *found).withColumn("a_avg", F.round(F.col("a_avg") * 1e6) / 1e6)  # a double is rounded there, not its digits

    return run


for _name, _what in (("window_exclude_any", "CURRENT ROW"), ("window_exclude_group_any", "GROUP"), ("window_exclude_ties_any", "TIES"), ("window_exclude_none", "NO OTHERS")):
    _frame = f"OVER (PARTITION BY l_suppkey ORDER BY l_orderkey ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING EXCLUDE {_what})"
    QUERIES[_name] = _excluding(_what)
    ORACLE_SQL[_name] = "SELECT l_suppkey, l_orderkey, " + ", ".join(f"{'round(' * (h == 'avg')}{h}(q) {_frame}{', 6)' * (h == 'avg')} AS a_{h}" for h in ("sum", "count", "min", "max", "avg")) + f" FROM {_INFINITE}"


@query(f"SELECT event_id, v_id FROM (SELECT event_id, user_id, ts FROM events WHERE event_type <> 'view') ASOF RIGHT JOIN {_VIEWS} v ON user_id = v_user AND ts >= v_ts")
def asof_right(spark, sf_dir):
    e, v = _events(spark, sf_dir)
    others = table(spark, sf_dir, "events").where("event_type <> 'view'").select("event_id", "user_id", "ts")
    return joins.asof_join(others, v, "ts", "v_ts", [("user_id", "v_user")], "right").select("event_id", "v_id")


@query(f"SELECT event_id FROM events WHERE EXISTS (SELECT 1 FROM {_VIEWS} v WHERE v_user = user_id AND ts > v_ts)")
def asof_semi(spark, sf_dir):
    e, v = _events(spark, sf_dir)
    return joins.asof_join(e, v, "ts", "v_ts", [("user_id", "v_user")], "semi", ">").select("event_id")


@query("SELECT p_partkey, unnest([[p_size, 1], [], [2]], recursive := true) AS x FROM part")
def unnest_nested(spark, sf_dir):
    none = F.array().cast("array<int>")
    return rows.unnest_recursive(table(spark, sf_dir, "part").select("p_partkey", F.array(F.array("p_size", F.lit(1)), none, F.array(F.lit(2))).alias("x")), "x")


@query("SELECT column_name, min, max, count, round(avg::DOUBLE, 4) AS mean, round(std::DOUBLE, 4) AS deviation, null_percentage::DOUBLE AS nulls FROM (SUMMARIZE (SELECT p_partkey, CASE WHEN p_size > 10 THEN p_size END AS p_size FROM part))")
def summarize_nulls(spark, sf_dir):
    found = rows.summarize(table(spark, sf_dir, "part").select("p_partkey", F.expr("CASE WHEN p_size > 10 THEN p_size END").alias("p_size")))
    number = lambda c, n: F.round(F.col(c).cast("double"), 4).alias(n)
    return found.select("column_name", "min", "max", "count", number("avg", "mean"), number("std", "deviation"), F.col("null_percentage").alias("nulls"))


_BIG = "9007199254740992"


@query(f"SELECT o_orderkey, b FROM (SELECT o_orderkey, o_custkey, o_orderkey + {_BIG} AS a FROM orders) ASOF JOIN (SELECT c_custkey, c_custkey * 3 + 1 + {_BIG} AS b, c_nationkey FROM customer) ON o_custkey % 25 = c_nationkey AND a > b")
def asof_big_numbers(spark, sf_dir):
    a = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 25).cast("int").alias("k"), (F.col("o_orderkey") + int(_BIG)).alias("a"))
    b = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 3 + 1 + int(_BIG)).alias("b"), "c_nationkey")
    return joins.asof_join(a, b, "a", "b", [("k", "c_nationkey")], "inner", ">").select("o_orderkey", "b")


_D = "(SELECT c_nationkey AS k FROM customer WHERE c_nationkey < 15)", "(SELECT s_nationkey AS k FROM supplier WHERE s_nationkey > 5)"


@query(f"(FROM {_D[0]} EXCEPT FROM {_D[1]}) UNION ALL (FROM {_D[1]} EXCEPT FROM {_D[0]})")
def symmetric_difference(spark, sf_dir):
    a = table(spark, sf_dir, "customer").where("c_nationkey < 15").select(F.col("c_nationkey").alias("k"))
    return sets.symmetric_difference(a, table(spark, sf_dir, "supplier").where("s_nationkey > 5").select(F.col("s_nationkey").alias("k")))


@query("SELECT n_nationkey AS k, n_name AS name FROM nation UNION ALL BY NAME SELECT r_name AS name, r_regionkey AS other FROM region")
def union_by_name(spark, sf_dir):
    a = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    return sets.union_by_name(a, table(spark, sf_dir, "region").select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("other")))


@query("WITH RECURSIVE t(n) AS (SELECT 1 UNION SELECT (n * 3) % 17 FROM t) SELECT n FROM t")
def recursive_union(spark, sf_dir):
    return sets.recursive_union(spark.range(1, 2).select(F.col("id").alias("n")), lambda t: t.select(((F.col("n") * 3) % 17).alias("n")))


@query("SELECT l_returnflag, histogram(l_linenumber) AS histogram FROM lineitem GROUP BY l_returnflag")
def agg_histogram(spark, sf_dir):
    return aggregates.histogram(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_linenumber")


@query("SELECT l_returnflag, round(entropy(l_linenumber), 6) AS entropy FROM lineitem GROUP BY l_returnflag")
def agg_entropy(spark, sf_dir):
    return aggregates.entropy(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_linenumber").withColumn("entropy", F.round("entropy", 6))


@query("SELECT l_returnflag, round(mad(l_extendedprice), 2) AS mad FROM lineitem GROUP BY l_returnflag")
def agg_mad(spark, sf_dir):
    return aggregates.mad(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice").withColumn("mad", F.round("mad", 2))


@query("WITH c AS (SELECT l_returnflag, l_linenumber AS v, count(*) AS n, min(l_orderkey * 10 + l_linenumber) AS o FROM lineitem GROUP BY ALL) SELECT l_returnflag, arg_min(v, (-n, o)) AS mode FROM c GROUP BY l_returnflag")
def agg_mode(spark, sf_dir):
    return aggregates.mode(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_linenumber", F.col("l_orderkey") * 10 + F.col("l_linenumber"))


@query("SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey) AS l, string_agg(o_orderstatus, '-' ORDER BY o_orderkey) AS s FROM orders GROUP BY o_custkey")
def agg_ordered(spark, sf_dir):
    f = aggregates.FUNCTIONS
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(f["agg_list"]("o_orderkey", "o_orderkey").alias("l"), f["agg_string_agg"]("o_orderstatus", "-", "o_orderkey").alias("s"))


@query("""SELECT s_suppkey, s_name, CASE WHEN s_nationkey < 5 THEN 0 ELSE s_acctbal END AS s_acctbal FROM supplier WHERE s_nationkey <> 7""")
def update_and_delete(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    out = changes.delete(changes.update(s, F.col("s_nationkey") < 5, {"s_acctbal": F.lit(0.0)}), F.col("s_nationkey") == 7)
    return out.select("s_suppkey", "s_name", "s_acctbal")


@query("""SELECT coalesce(n_nationkey, r_regionkey + 20) AS n_nationkey, CASE WHEN n_nationkey IS NULL THEN r_name WHEN r_name IS NULL THEN n_name ELSE r_name || '!' END AS n_name
FROM nation FULL JOIN region ON n_nationkey = r_regionkey + 20 WHERE n_nationkey IS NULL OR r_name IS NULL OR n_nationkey <> 22""")
def merge_into(spark, sf_dir):
    t = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    s = table(spark, sf_dir, "region").select((F.col("r_regionkey") + 20).alias("n_nationkey"), "r_name")
    return changes.merge(t, s, ["n_nationkey"], {"n_name": F.concat("s.r_name", F.lit("!"))}, F.col("t.n_nationkey") == 22, {"n_nationkey": F.col("s.n_nationkey"), "n_name": F.col("s.r_name")})


@query("SELECT r_regionkey, r_name FROM region WHERE r_regionkey <> 3 UNION ALL SELECT * FROM (VALUES (3, 'new'), (9, 'nine'))")
def insert_on_conflict(spark, sf_dir):
    new = spark.createDataFrame([("new", 3), ("nine", 9)], "r_name string, r_regionkey int")
    return changes.insert(table(spark, sf_dir, "region"), new, ["r_regionkey"], "update")
