"""Further functions next to SQL for the same: text, time, nested values, settings, estimates (within bounds) and macros."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import aggregates, general
from quern.functions import call as f
from quern.plans.function_cases import _KEYS, COSTLY, Case, _rows
from quern.session import table


def _true(name: str, make: Callable[[], object], sql: str) -> Case:
    """A statement that holds, for functions whose value is not the same on every run or engine."""
    return name, make, sql


_DOMAIN = ["red", "green", "blue"]
_ENUM = "ENUM ('red', 'green', 'blue')"
_STRUCT = "{'a': c_custkey, 'b': c_nationkey::BIGINT}"


def _struct():
    return F.struct(F.col("c_custkey").alias("a"), F.col("c_nationkey").cast("long").alias("b"))


def _interval(name: str) -> Case:
    return f"f_{name}", lambda: F.lit("2020-01-31 10:00:00").cast("timestamp_ntz") + f(name, F.col("c_nationkey") % 4), f"TIMESTAMP '2020-01-31 10:00:00' + {name}(c_nationkey % 4)"


CUSTOMER: dict[str, list[Case]] = {
    "fn_text_more": [
        ("f_encode", lambda: F.hex(f("encode", "c_name")), "hex(encode(c_name))"),
        ("f_parse_bytes", lambda: f("parse_formatted_bytes", F.concat(F.col("c_custkey").cast("string"), F.lit(" KiB"))), "parse_formatted_bytes(c_custkey || ' KiB')"),
        ("f_parse_bytes_10", lambda: f("parse_formatted_bytes", F.concat(F.col("c_custkey").cast("string"), F.lit("MB"))), "parse_formatted_bytes(c_custkey || 'MB')"),
        ("f_unbin", lambda: F.hex(f("unbin", F.bin(F.col("c_custkey") % 200 + 256))), "hex(unbin(bin(c_custkey % 200 + 256)))"),
        ("f_ilike_escape", lambda: f("ilike_escape", "c_name", "CUSTOMER#%1", "$"), "ilike_escape(c_name, 'CUSTOMER#%1', '$')"),
        ("f_not_ilike_escape", lambda: f("not_ilike_escape", "c_name", "CUSTOMER#%1", "$"), "not_ilike_escape(c_name, 'CUSTOMER#%1', '$')"),
        ("f_not_like_escape", lambda: f("not_like_escape", "c_name", "%$%%", "$"), "not_like_escape(c_name, '%$%%', '$')"),
        ("f_md5_upper", lambda: f("md5_number_upper", "c_name").cast("string"), "md5_number_upper(c_name)::VARCHAR"),
        ("f_md5_lower", lambda: f("md5_number_lower", "c_name").cast("string"), "md5_number_lower(c_name)::VARCHAR"),
        ("f_fdiv", lambda: f("fdiv", "c_acctbal", F.lit(7.0)), "fdiv(c_acctbal, 7.0)"),
        ("f_nullif", lambda: f("nullif", "c_mktsegment", F.lit("BUILDING")), "nullif(c_mktsegment, 'BUILDING')"),
    ],
    "fn_intervals": [
        _interval("to_centuries"),
        _interval("to_decades"),
        _interval("to_millennia"),
        _interval("to_milliseconds"),
        _interval("to_microseconds"),
        _interval("to_weeks"),
        ("f_normalized", lambda: f("normalized_interval", F.lit(1), F.col("c_nationkey") + 20, F.lit(90_000_000_000))["months"].cast("long"), "datepart('month', normalized_interval(INTERVAL 1 MONTH + to_days(c_nationkey + 20) + INTERVAL 90000 SECONDS))"),
        ("f_date_add", lambda: f("date_add", F.lit("2020-01-31").cast("date"), F.make_ym_interval(F.lit(0), F.col("c_nationkey"))), "date_add(DATE '2020-01-31', to_months(c_nationkey))"),
        _true("f_ago", lambda: f("ago", F.expr("INTERVAL 1 DAY")) < F.current_timestamp(), "ago(INTERVAL 1 DAY) < now()"),
        _true("f_now", lambda: f("now") >= F.lit("2024-01-01").cast("timestamp"), "now() >= TIMESTAMP '2024-01-01'"),
    ],
    "fn_structs_more": [
        ("f_values", lambda: f("struct_values", _struct(), ["a", "b"])["v2"], "struct_values({'a': c_custkey, 'b': c_nationkey})[2]"),
        ("f_remap", lambda: f("remap_struct", _struct(), {"x": "b", "y": "a"}, {"z": 7})["x"], "struct_pack(x := c_nationkey)['x']"),
        ("f_extract_at", lambda: f("struct_extract_at", _struct(), 2, ["a", "b"]), f"struct_extract_at({_STRUCT}, 2)"),
        ("f_position", lambda: f("struct_position", _struct(), 3, ["a", "b"]), "CASE WHEN c_custkey = 3 THEN 1 WHEN c_nationkey = 3 THEN 2 END"),
        ("f_enum_first", lambda: f("enum_first", _DOMAIN), f"enum_first(NULL::{_ENUM})"),
        ("f_enum_last", lambda: f("enum_last", _DOMAIN), f"enum_last(NULL::{_ENUM})"),
        ("f_enum_range", lambda: f("enum_range", _DOMAIN), f"enum_range(NULL::{_ENUM})::VARCHAR[]"),
        ("f_enum_boundary", lambda: f("enum_range_boundary", "red", "green", _DOMAIN), f"enum_range_boundary('red'::{_ENUM}, 'green'::{_ENUM})::VARCHAR[]"),
        ("f_from_entries", lambda: f("map_extract_value", f("map_from_entries", F.array(F.struct(F.lit("k").alias("key"), F.col("c_custkey").alias("value")))), "k"), "map_extract_value(map_from_entries([{'k': 'k', 'v': c_custkey}]), 'k')"),
        ("f_contains_value", lambda: f("map_contains_value", F.create_map(F.lit("k"), F.col("c_nationkey")), 3), "map_contains_value(MAP {'k': c_nationkey}, 3)"),
        ("f_contains_entry", lambda: f("map_contains_entry", F.create_map(F.lit("k"), F.col("c_nationkey")), "k", 3), "map_contains_entry(MAP {'k': c_nationkey}, 'k', 3)"),
        ("f_variant", lambda: f("variant_extract", F.parse_json(F.concat(F.lit('{"b": 1, "a": '), F.col("c_custkey"), F.lit("}"))), "$.a", "long"), "(('{\"a\": ' || c_custkey || '}')::JSON->>'a')::BIGINT"),
        ("f_variant_normal", lambda: F.to_json(f("variant_normalize", F.parse_json(F.lit('{"b": 1, "a": [2, null]}')))), "'{\"a\":[2,null],\"b\":1}'"),
        _true("f_variant_type", lambda: f("variant_typeof", F.parse_json(F.lit("17"))) == "BIGINT", "true"),
    ],
    "fn_system": [
        _true("f_typeof", lambda: f("typeof", "c_name") == "string", "typeof(c_name) = 'VARCHAR'"),
        _true("f_get_type", lambda: f("get_type", "c_acctbal") == "double", "typeof(c_acctbal) = 'DOUBLE'"),
        _true("f_version", lambda: F.length(f("version")) > 0, "length(version()) > 0"),
        _true("f_names", lambda: F.length(F.concat(f("current_catalog"), f("current_database"), f("current_schema"))) > 0, "length(concat(current_catalog(), current_database(), current_schema())) > 0"),
        _true("f_users", lambda: (f("current_user") == f("user")) & (f("session_user") == f("current_role")), "current_user = user AND session_user = current_role"),
        _true("f_schemas", lambda: F.size(f("current_schemas", True)) > 0, "len(current_schemas(true)) > 0"),
        _true("f_random", lambda: (f("random") >= 0) & (f("setseed", 5) < 1), "random() BETWEEN 0 AND 1"),
        _true("f_uuids", lambda: F.length(F.concat(f("uuid"), f("uuidv4"), f("gen_random_uuid"))) == 108, "length(concat(uuid(), uuidv4(), gen_random_uuid())) = 108"),
        _true("f_uuid7", lambda: f("uuid_extract_version", f("uuidv7")) == 7, "uuid_extract_version(uuidv7()) = 7"),
        _true("f_hash", lambda: f("hash", "c_name") == f("hash", "c_name"), "hash(c_name) = hash(c_name)"),
        _true("f_error", lambda: F.when(F.col("c_custkey") < 0, f("error", "never")).isNull(), "CASE WHEN c_custkey < 0 THEN error('never') END IS NULL"),
        ("f_other_bin", lambda: f("is_histogram_other_bin", F.nullif(F.col("c_nationkey"), F.lit(3))), "c_nationkey = 3"),
        ("f_bins", lambda: f("equi_width_bins", 0.0, 10.0, 5), "equi_width_bins(0.0::DOUBLE, 10.0::DOUBLE, 5, false)"),
    ],
}

_L = "list_transform(range(p_size % 7 + 1), lambda x: x * x % 5)"


def _list():
    return F.transform(F.sequence(F.lit(0).cast("long"), F.col("p_size").cast("long") % 7), lambda x: x * x % 5)


_AGGREGATES = "sem mad entropy skewness kurtosis kurtosis_pop bit_and bit_or bit_xor mode".split()
PART: dict[str, list[Case]] = {
    "fn_lists_more": [
        *[
            (f"f_{n}", lambda n=n: F.round(f(f"list_{n}", _list()), 6) if n not in ("bit_and", "bit_or", "bit_xor", "mode") else f(f"list_{n}", _list()), f"round(list_{n}({_L}), 6)" if n not in ("bit_and", "bit_or", "bit_xor", "mode") else f"list_{n}({_L})")
            for n in _AGGREGATES
        ],
        ("f_histogram", lambda: f("list_histogram", _list()), f"list_histogram({_L})"),
        ("f_aggregate", lambda: f("list_aggregate", _list(), "max"), f"list_aggregate({_L}, 'max')"),
        ("f_bools", lambda: f("list_bool_and", F.transform(_list(), lambda x: x > 0)), f"list_bool_and(list_transform({_L}, lambda x: x > 0))"),
        ("f_bool_or", lambda: f("list_bool_or", F.transform(_list(), lambda x: x > 3)), f"list_bool_or(list_transform({_L}, lambda x: x > 3))"),
        ("f_approx_count", lambda: f("list_approx_count_distinct", _list()), f"list_approx_count_distinct({_L})"),
        ("f_value", lambda: f("list_value", "p_size", F.lit(1)), "list_value(p_size, 1)"),
        ("f_array_value", lambda: f("array_value", "p_size", F.lit(1)), "array_value(p_size, 1)::INTEGER[]"),
        ("f_zip", lambda: F.transform(f("list_zip", _list(), F.array(F.lit(7))), lambda s: s["0"]), f"list_transform(list_zip({_L}, [7]), lambda s: s[1])"),
        ("f_pop_back", lambda: f("array_pop_back", _list()), f"array_pop_back({_L})"),
        ("f_pop_front", lambda: f("array_pop_front", _list()), f"array_pop_front({_L})"),
        ("f_comma", lambda: f("array_to_string_comma_default", F.split("p_type", " ")), "array_to_string_comma_default(string_split(p_type, ' '))"),
    ],
}

ORDERS: dict[str, list[Case]] = {
    "fn_times_more": [
        ("f_dayofmonth", lambda: f("dayofmonth", "o_orderdate"), "dayofmonth(o_orderdate)"),
        ("f_days_in_month", lambda: f("days_in_month", "o_orderdate"), "days_in_month(o_orderdate)"),
        ("f_make_time", lambda: f("make_time", F.lit(7), F.lit(5), F.lit(30.5)).cast("string"), "make_time(7, 5, 30.5)::VARCHAR"),
        ("f_make_ns", lambda: f("make_timestamp_ns", F.col("o_orderkey") * 1_000_000_000), "make_timestamp_ns(o_orderkey * 1000000000)::TIMESTAMP"),
        ("f_nanosecond", lambda: f("nanosecond", "o_orderdate"), "nanosecond(o_orderdate::TIMESTAMP_NS)"),
        ("f_zone", lambda: F.unix_seconds(f("timezone", "America/New_York", "o_orderdate")), "epoch(timezone('America/New_York', o_orderdate))::BIGINT"),
        ("f_zone_hour", lambda: f("timezone_hour", "o_orderdate"), "timezone_hour(o_orderdate)"),
        ("f_zone_minute", lambda: f("timezone_minute", "o_orderdate"), "timezone_minute(o_orderdate)"),
    ],
}

AGGREGATES: dict[str, list[Case]] = {
    "agg_more": [
        ("f_wavg", lambda: F.round(f("agg_weighted_avg", "l_extendedprice", "l_quantity"), 4), "round(weighted_avg(l_extendedprice, l_quantity), 4)"),
        ("f_geomean", lambda: F.round(f("agg_geomean", "l_extendedprice"), 4), "round(geomean(l_extendedprice), 4)"),
        ("f_arg_max_null", lambda: f("agg_arg_max_null", "l_linenumber", F.col("l_extendedprice") * 1000 + F.col("l_orderkey") / 1e7), "arg_max_null(l_linenumber, l_extendedprice * 1000 + l_orderkey / 1e7)"),
        ("f_arg_min_null", lambda: f("agg_arg_min_null", "l_linenumber", F.col("l_extendedprice") * 1000 + F.col("l_orderkey") / 1e7), "arg_min_null(l_linenumber, l_extendedprice * 1000 + l_orderkey / 1e7)"),
        ("f_arg_max_last", lambda: f("agg_arg_max_nulls_last", "l_linenumber", F.col("l_extendedprice") * 1000 + F.col("l_orderkey") / 1e7), "arg_max(l_linenumber, l_extendedprice * 1000 + l_orderkey / 1e7)"),
        ("f_arg_min_last", lambda: f("agg_arg_min_nulls_last", "l_linenumber", F.col("l_extendedprice") * 1000 + F.col("l_orderkey") / 1e7), "arg_min(l_linenumber, l_extendedprice * 1000 + l_orderkey / 1e7)"),
        # Estimates: whether they lie within a twentieth of the exact value.
        _true("f_approx_count", lambda: F.abs(f("agg_approx_count_distinct", "l_linenumber") - F.count_distinct("l_linenumber")) <= 1, "abs(approx_count_distinct(l_linenumber) - count(DISTINCT l_linenumber)) <= 1"),
        _true("f_approx_quantile", lambda: F.abs(f("agg_approx_quantile", "l_extendedprice", 0.5) / F.median("l_extendedprice") - 1) < 0.05, "abs(approx_quantile(l_extendedprice, 0.5) / median(l_extendedprice) - 1) < 0.05"),
        _true("f_reservoir", lambda: f("agg_reservoir_quantile", "l_extendedprice", 0.5).between(F.min("l_extendedprice"), F.max("l_extendedprice")), "reservoir_quantile(l_extendedprice, 0.5) BETWEEN min(l_extendedprice) AND max(l_extendedprice)"),
        _true("f_top", lambda: F.size(f("agg_approx_top_k", "l_linenumber", 2)), "len(approx_top_k(l_linenumber, 2))"),
    ],
}


def _groups(cases: list[Case]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(*[make().alias(label) for label, make, _ in cases])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for _table, _sets in (("customer", CUSTOMER), ("part", PART), ("orders", ORDERS)):
    for _name, _cases in _sets.items():
        QUERIES[_name] = _rows(_table, _cases, _name in COSTLY)
        ORACLE_SQL[_name] = f"SELECT {_KEYS[_table]}, " + ", ".join(f"{sql} AS {label}" for label, _, sql in _cases) + f" FROM {_table}"
for _name, _cases in AGGREGATES.items():
    QUERIES[_name] = _groups(_cases)
    ORACLE_SQL[_name] = "SELECT l_returnflag, " + ", ".join(f"{sql} AS {label}" for label, _, sql in _cases) + " FROM lineitem GROUP BY l_returnflag"


def query(sql: str) -> Callable:
    def keep(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[fn.__name__], ORACLE_SQL[fn.__name__] = fn, sql
        return fn

    return keep


@query("SELECT l_returnflag, MAP {1: count(*) FILTER (l_linenumber = 1), 3: count(*) FILTER (l_linenumber = 3), 6: count(*) FILTER (l_linenumber = 6)} AS histogram FROM lineitem GROUP BY l_returnflag")
def agg_histogram_exact(spark, sf_dir):
    return aggregates.histogram_exact(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_linenumber", [1, 3, 6])


@query("SELECT CASE WHEN p_size <= 10 THEN 10 WHEN p_size <= 30 THEN 30 END AS bin, count(*) AS count FROM part GROUP BY ALL")
def histogram_values(spark, sf_dir):
    return aggregates.histogram_values(table(spark, sf_dir, "part"), "p_size", [10, 30])


@query("SELECT p_partkey, regexp_split_to_table(p_type, ' ') AS part FROM part")
def fn_split_to_table(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", f("regexp_split_to_table", "p_type", " ").alias("part"))


@query("SELECT p_partkey, generate_subscripts(string_split(p_type, ' '), 1) AS place FROM part")
def fn_subscripts(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", f("generate_subscripts", F.split("p_type", " ")).alias("place"))


_LINE, _AREA = "01020000000200000000000000000000000000000000000000000000000000F03F0000000000000040", "01030000000100000004000000000000000000000000000000000000000000000000000840000000000000000000000000000008400000000000000840" + "0" * 32


@query(f"""SELECT s_suppkey, st_astext(st_geomfromwkb(from_hex('{_LINE}'))) AS line, st_astext(st_geomfromwkb(from_hex('{_AREA}'))) AS area, hex(st_aswkb(st_geomfromwkb(from_hex('{_LINE}')))) AS raw,
st_crs(st_setcrs(st_geomfromwkb(from_hex('{_LINE}')), 'EPSG:4326')) AS crs, st_intersects_extent(st_geomfromwkb(from_hex('{_LINE}')), st_geomfromwkb(from_hex('{_AREA}'))) AS meets,
st_intersects_extent(('POINT(' || s_suppkey || ' 1)')::GEOMETRY, st_geomfromwkb(from_hex('{_AREA}'))) AS inside FROM supplier""")
def fn_geometry(spark, sf_dir):
    shape = lambda raw: f("st_geomfromwkb", F.unhex(F.lit(raw)))
    double = F.udf(lambda x: bytearray(__import__("struct").pack("<d", x)), "binary")
    point = f("st_geomfromwkb", F.concat(F.unhex(F.lit("0101000000")), double(F.col("s_suppkey").cast("double")), F.unhex(F.lit("000000000000F03F"))))
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", f("st_astext", shape(_LINE)).alias("line"), f("st_astext", shape(_AREA)).alias("area"), F.hex(f("st_aswkb", shape(_LINE))).alias("raw"),
        f("st_crs", f("st_setcrs", shape(_LINE), "EPSG:4326")).alias("crs"), f("st_intersects_extent", shape(_LINE), shape(_AREA)).alias("meets"), f("st_intersects_extent", point, shape(_AREA)).alias("inside"),
    )


@query("SELECT event_id, (props->>'k')::BIGINT AS a, json_extract_string(props, '$.k') AS b, json_valid(props) AS c FROM events")
def json_access(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.from_json("props", "k long")["k"].alias("a"), F.get_json_object("props", "$.k").alias("b"), F.try_parse_json("props").isNotNull().alias("c"))


@query("SELECT c_custkey FROM customer WHERE c_mktsegment COLLATE NOCASE = 'building' AND strip_accents('Éa') COLLATE NOCASE = 'ea'")
def collated(spark, sf_dir):
    same = F.collate(F.col("c_mktsegment"), "UTF8_LCASE") == "building"
    return table(spark, sf_dir, "customer").where(same & (F.collate(F.lit("Éa"), "UNICODE_CI_AI") == "ea")).select("c_custkey")


@query("SELECT s_suppkey, s_acctbal > 4000 AS rich FROM supplier")
def fn_variable(spark, sf_dir):
    general.set_variable(spark, "quern_limit", 4000)
    return table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_acctbal") > f("getvariable", "quern_limit")).alias("rich"))


@query("SELECT s_suppkey, s_nationkey::VARCHAR AS a, 's_name' AS b, true AS c, [s_suppkey::VARCHAR] AS d FROM supplier")
def fn_types(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return s.select(
        "s_suppkey",
        f("cast_to_type", "s_nationkey", F.col("s_name"), s).alias("a"),
        f("alias", s, F.col("s_name")).alias("b"),
        (f("current_setting", spark, "spark.sql.session.timeZone") == f("current_setting", spark, "spark.sql.session.timeZone")).alias("c"),
        f("replace_type", F.array("s_suppkey"), "bigint", "string", s).alias("d"),
    )
