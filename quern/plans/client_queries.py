"""The client layer's calls and verbs, next to SQL."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import client
from quern.functions.verbs import apply as v
from quern.plans.function_cases import Case
from quern.session import table

Query = Callable[[SparkSession, str], DataFrame]

CUSTOMER: dict[str, list[Case]] = {
    "verbs_numbers": [
        ("f_int", lambda: v("as_integer", F.col("c_acctbal")), "round_even(c_acctbal, 0)::INTEGER"),
        ("f_chr", lambda: v("as_character", "c_custkey"), "c_custkey::VARCHAR"),
        ("f_mod", lambda: v("%%", F.col("c_custkey") - 5, F.lit(3)), "((c_custkey - 5) % 3 + 3) % 3"),
        ("f_div", lambda: v("%/%", F.col("c_custkey") - 5, F.lit(3)), "floor((c_custkey - 5) / 3)::BIGINT"),
        ("f_pow", lambda: v("^", "c_nationkey", F.lit(2)), "c_nationkey ^ 2"),
        ("f_or", lambda: v("bitwOr", "c_nationkey", F.lit(5)), "c_nationkey | 5"),
        ("f_and", lambda: v("bitwAnd", "c_nationkey", F.lit(5)), "c_nationkey & 5"),
        ("f_xor", lambda: v("bitwXor", "c_nationkey", F.lit(5)), "xor(c_nationkey, 5)"),
        ("f_not", lambda: v("bitwNot", "c_nationkey"), "~c_nationkey"),
        ("f_left", lambda: v("bitwShiftL", "c_nationkey", 2), "c_nationkey << 2"),
        ("f_right", lambda: v("bitwShiftR", "c_nationkey", 1), "c_nationkey >> 1"),
        ("f_log", lambda: F.round(v("log", F.col("c_custkey") + 1, 3), 6), "round(ln(c_custkey + 1) / ln(3), 6)"),
        ("f_log10", lambda: F.round(v("log10", F.col("c_custkey") + 1), 6), "round(log10(c_custkey + 1), 6)"),
        ("f_round", lambda: v("round", "c_acctbal", 1), "round_even(c_acctbal, 1)"),
        ("f_finite", lambda: v("is_finite", "c_acctbal"), "isfinite(c_acctbal)"),
        ("f_distinct", lambda: v("is_distinct_from", "c_custkey", "c_nationkey"), "c_custkey IS DISTINCT FROM c_nationkey"),
        ("f_in", lambda: v("r_in", "c_nationkey", [1, 2, None]), "c_nationkey IN (1, 2)"),
        ("f_divide", lambda: F.round(v("r_/", "c_acctbal", "c_nationkey"), 6), "round(c_acctbal / c_nationkey, 6)"),
        ("f_if", lambda: v("if_else", F.col("c_nationkey") > 3, F.lit("a"), F.lit("b")), "CASE WHEN c_nationkey > 3 THEN 'a' ELSE 'b' END"),
    ],
    "verbs_strings": [
        ("f_grepl", lambda: v("grepl", "0[0-5]$", "c_name"), "regexp_matches(c_name, '0[0-5]$')"),
        ("f_expr", lambda: v("regexpr", "[1-9]", "c_name"), "CASE WHEN regexp_matches(c_name, '[1-9]') THEN length(regexp_extract(c_name, '^([^1-9]*)', 1)) + 1 ELSE -1 END"),
        ("f_replace", lambda: v("str_replace", "c_name", "0", "x"), "regexp_replace(c_name, '0', 'x')"),
        ("f_replace_all", lambda: v("str_replace_all", "c_name", "0", "x"), "regexp_replace(c_name, '0', 'x', 'g')"),
        ("f_remove", lambda: v("str_remove", "c_name", "0+"), "regexp_replace(c_name, '0+', '')"),
        ("f_squish", lambda: v("str_squish", F.concat(F.lit("  a   "), "c_name", F.lit(" "))), "trim(regexp_replace('  a   ' || c_name || ' ', '\\s+', ' ', 'g'))"),
        ("f_sentence", lambda: v("str_to_sentence", "c_mktsegment"), "upper(c_mktsegment[1]) || lower(c_mktsegment[2:])"),
        ("f_starts", lambda: v("str_starts", "c_mktsegment", "[AB]"), "regexp_matches(c_mktsegment, '^[AB]')"),
        ("f_ends", lambda: v("str_ends", "c_mktsegment", "(Y|G)"), "regexp_matches(c_mktsegment, '(Y|G)$')"),
        ("f_pad", lambda: v("str_pad", "c_mktsegment", 11, "right", "."), "rpad(c_mktsegment, greatest(length(c_mktsegment), 11)::INTEGER, '.')"),
        ("f_paste", lambda: v("paste", "c_name", "c_custkey"), "concat_ws(' ', c_name, c_custkey)"),
        ("f_paste0", lambda: v("paste0", "c_name", "c_custkey"), "concat_ws('', c_name, c_custkey)"),
        ("f_ilike", lambda: v("str_ilike", "c_mktsegment", "b%"), "c_mktsegment ILIKE 'b%'"),
    ],
}
_D = "o_orderdate::DATE"


def _day():
    return F.col("o_orderdate").cast("date")


ORDERS: dict[str, list[Case]] = {
    "verbs_dates": [
        ("f_month", lambda: v("month", _day()), f"month({_D})"),
        ("f_label", lambda: v("month", _day(), True), f"strftime({_D}, '%b')"),
        ("f_quarter", lambda: v("quarter", _day(), "year.quarter"), f"year({_D}) || '.' || quarter({_D})"),
        ("f_qday", lambda: v("qday", _day()), f"date_diff('day', date_trunc('quarter', {_D}), {_D}) + 1"),
        ("f_wday", lambda: v("wday", _day()), f"dayofweek({_D}) + 1"),
        ("f_wday_monday", lambda: v("wday", _day(), 1), f"isodow({_D})"),
        ("f_wday_label", lambda: v("wday", _day(), 7, True), f"strftime({_D}, '%a')"),
        ("f_yday", lambda: v("yday", _day()), f"dayofyear({_D})"),
        ("f_floor_month", lambda: v("floor_date", "o_orderdate", "month").cast("date"), f"date_trunc('month', {_D})::DATE"),
        ("f_floor_week", lambda: v("floor_date", _day(), "week", 1), f"date_trunc('week', {_D})::DATE"),
        ("f_add_days", lambda: v("add_days", _day(), F.lit(10)), f"{_D} + 10"),
        ("f_add_years", lambda: v("add_years", _day(), F.lit(1)), f"({_D} + INTERVAL 1 YEAR)::DATE"),
        ("f_between", lambda: v("date_count_between", _day(), F.lit("2024-01-01").cast("date")), f"date_diff('day', {_D}, DATE '2024-01-01')"),
        ("f_build", lambda: v("date_build", v("get_year", _day()), v("get_month", _day()), F.lit(1)), f"make_date(year({_D}), month({_D}), 1)"),
        ("f_days", lambda: F.col("o_orderdate") + v("days", 3), "o_orderdate + INTERVAL 3 DAYS"),
    ],
}
_X = "(SELECT l_returnflag, l_quantity, l_extendedprice, CASE WHEN l_returnflag <> 'A' OR l_linenumber < 5 THEN l_linenumber END AS x FROM lineitem)"
GROUPS: list[Case] = [
    ("f_sd", lambda: F.round(v("sd", "l_quantity"), 6), "round(stddev(l_quantity), 6)"),
    ("f_cor", lambda: F.round(v("cor", "l_quantity", "l_extendedprice"), 6), "round(corr(l_quantity, l_extendedprice), 6)"),
    ("f_median", lambda: v("median", "l_quantity"), "median(l_quantity)"),
    ("f_distinct", lambda: v("n_distinct", "x"), "count(DISTINCT x)"),
    ("f_quantile", lambda: v("quantile", "l_quantity", 0.3), "quantile_cont(l_quantity, 0.3)"),
    ("f_any", lambda: v("any", F.col("l_quantity") > 49), "bool_or(l_quantity > 49)"),
    ("f_sum", lambda: v("r_sum", "x"), "CASE WHEN count(*) = count(x) THEN sum(x) END"),
    ("f_sum_rm", lambda: v("r_sum", "x", True), "sum(x)"),
    ("f_min", lambda: v("r_min", "x"), "CASE WHEN count(*) = count(x) THEN min(x) END"),
    ("f_max_rm", lambda: v("r_max", "x", True), "max(x)"),
    ("f_r_any", lambda: v("r_any", F.col("x") > 90), "CASE WHEN bool_or(x > 90) THEN true WHEN count(*) = count(x) THEN false END"),
    ("f_r_all", lambda: v("r_all", F.col("x") > 0), "CASE WHEN NOT bool_and(x > 0) THEN false WHEN count(*) = count(x) THEN true END"),
]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
for _table, _key, _sets in (("customer", "c_custkey", CUSTOMER), ("orders", "o_orderkey", ORDERS)):
    for _name, _cases in _sets.items():
        QUERIES[_name] = lambda spark, sf_dir, t=_table, k=_key, cs=_cases: table(spark, sf_dir, t).select(k, *[make().alias(label) for label, make, _ in cs])
        ORACLE_SQL[_name] = f"SELECT {_key}, " + ", ".join(f"{sql} AS {label}" for label, _, sql in _cases) + f" FROM {_table}"


def query(sql: str) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[fn.__name__], ORACLE_SQL[fn.__name__] = fn, sql
        return fn

    return keep


@query("SELECT l_returnflag, " + ", ".join(f"{sql} AS {label}" for label, _, sql in GROUPS) + f" FROM {_X} GROUP BY l_returnflag")
def verbs_aggregates(spark, sf_dir):
    given = table(spark, sf_dir, "lineitem").withColumn("x", F.expr("CASE WHEN l_returnflag <> 'A' OR l_linenumber < 5 THEN l_linenumber END"))
    return given.groupBy("l_returnflag").agg(*[make().alias(label) for label, make, _ in GROUPS])


@query("SELECT s_nationkey, count(*) AS n FROM supplier WHERE s_acctbal > 1000 AND (s_name LIKE '%;%') IS NOT NULL GROUP BY s_nationkey")
def client_script(spark, sf_dir):
    client.register(spark, "quern_s", table(spark, sf_dir, "supplier"))
    return client.execute(spark, """
        CREATE OR REPLACE TEMPORARY VIEW quern_rich AS SELECT * FROM quern_s WHERE s_acctbal > 1000; -- a comment; with a semicolon
        SELECT s_nationkey, count(*) AS n FROM quern_rich WHERE (s_name LIKE '%;%') IS NOT NULL GROUP BY s_nationkey;
    """)


@query("SELECT s_suppkey FROM supplier WHERE s_nationkey = 3 OR s_acctbal < 0")
def client_prepared(spark, sf_dir):
    client.register(spark, "quern_s", table(spark, sf_dir, "supplier"))
    return client.Prepared(spark, "SELECT s_suppkey FROM quern_s WHERE s_nationkey = :n OR s_acctbal < :least").run(n=3, least=0)


@query("SELECT s_suppkey, s_acctbal * 1.5 + 1 AS y FROM supplier")
def client_macro(spark, sf_dir):
    client.register(spark, "quern_s", table(spark, sf_dir, "supplier"))
    client.macro(spark, "quern_grow", "x DOUBLE, by DOUBLE", "x * by + 1")
    return spark.sql("SELECT s_suppkey, quern_grow(s_acctbal, 1.5D) AS y FROM quern_s")


@query("SELECT s_suppkey, round(s_acctbal * 2, 2) AS y FROM supplier")
def client_scalar_function(spark, sf_dir):
    def twice(x: pd.Series) -> pd.Series:
        return (x * 2).round(2)

    client.scalar_function(spark, "quern_twice", twice, "double")
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.call_function("quern_twice", "s_acctbal").alias("y"))


@query("SELECT s_nationkey, max(s_suppkey) - min(s_suppkey) AS spread FROM supplier GROUP BY s_nationkey")
def client_aggregate_function(spark, sf_dir):
    spread = client.aggregate_function(spark, "quern_spread", lambda x: int(x.max() - x.min()), "long")
    return table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(spread("s_suppkey").alias("spread"))


@query("SELECT s_suppkey, unnest(string_split(s_name, '#')) AS part FROM supplier")
def client_table_function(spark, sf_dir):
    client.register(spark, "quern_s", table(spark, sf_dir, "supplier"))
    client.table_function(spark, "quern_parts", lambda s: ((p,) for p in s.split("#")), "part string")
    return spark.sql("SELECT s_suppkey, part FROM quern_s, LATERAL quern_parts(s_name)")


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA' ORDER BY n_name LIMIT 7")
def client_relations(spark, sf_dir):
    nation, region = client.rel_alias(table(spark, sf_dir, "nation"), "n"), table(spark, sf_dir, "region")
    both = client.rel_join(nation, region, [("n_regionkey", "r_regionkey")])
    kept = client.rel_filter(both, client.expr_comparison("<>", client.expr_reference("r_name"), client.expr_constant("ASIA")))
    return client.rel_limit(client.rel_order(client.rel_project(kept, F.col("n_name"), F.col("r_name")), ["n_name"]), 7)


@query("SELECT '[' || r_regionkey || ', ' || r_name || ']' AS summary FROM region")
def client_row_summary(spark, sf_dir):
    return client.row_summary(table(spark, sf_dir, "region"))


@query("SELECT s_suppkey, TRY_CAST(s_name AS INTEGER) AS a, TRY_CAST(s_suppkey::VARCHAR AS INTEGER) AS b FROM supplier")
def client_try(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", client.try_("CAST(s_name AS INT)").alias("a"), client.try_("CAST(CAST(s_suppkey AS STRING) AS INT)").alias("b"))
