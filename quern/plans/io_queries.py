"""Sources, sinks and streams, next to SQL over what they should give back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import client
from quern.session import shared_folder, table
from quern.sources import files, sinks
from quern.streaming import windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def query(sql: str) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        ORACLE_SQL[fn.__name__] = sql
        return fn

    return keep


@query("SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def csv_round_trip(spark, sf_dir):
    path = shared_folder(spark, "csv")
    sinks.copy_to(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"), path, "csv", header="true", sep="|")
    return files.read_csv(spark, path, "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz")


@query("SELECT event_id, user_id, value FROM events")
def json_round_trip(spark, sf_dir):
    path = shared_folder(spark, "json")
    sinks.copy_to(table(spark, sf_dir, "events").select("event_id", "user_id", "value"), path, "json")
    return files.read_json(spark, path, "event_id long, user_id long, value double")


@query("SELECT event_id, event_type FROM events WHERE event_type <> 'view'")
def hive_partitions(spark, sf_dir):
    path = shared_folder(spark, "hive")
    sinks.copy_to(table(spark, sf_dir, "events").select("event_id", "event_type"), path, partition_by=["event_type"], rows_per_file=2000)
    return files.read_parquet(spark, path).where("event_type <> 'view'").select("event_id", "event_type")


@query("SELECT s_suppkey, s_name, NULL::DOUBLE AS more FROM supplier UNION ALL SELECT c_custkey, NULL, c_acctbal FROM customer")
def union_of_files(spark, sf_dir):
    path = shared_folder(spark, "union")
    sinks.copy_to(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), f"{path}/a")
    sinks.copy_to(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("s_suppkey"), F.col("c_acctbal").alias("more")), f"{path}/b")
    return files.read_parquet(spark, [f"{path}/a", f"{path}/b"], union_by_name=True).select("s_suppkey", "s_name", "more")


@query("SELECT count(*) AS n, max(c_custkey)::VARCHAR AS high FROM customer")
def parquet_footers(spark, sf_dir):
    path = shared_folder(spark, "footers")
    sinks.copy_to(table(spark, sf_dir, "customer").select("c_custkey"), path, order_by=["c_custkey"])
    return files.parquet_metadata(spark, f"{path}/*.parquet").agg(F.sum("rows").alias("n"), F.max(F.col("max").cast("long")).cast("string").alias("high"))


@query("SELECT unnest(range(5, 100, 7)) AS value")
def series_range(spark, sf_dir):
    return files.generate_series(spark, 5, 100, 7, inclusive=False)


@query("SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-03', INTERVAL 5 HOURS)) AS value")
def series_times(spark, sf_dir):
    return files.generate_times(spark, "2024-01-01 00:00:00", "2024-01-03 00:00:00", "5 HOURS")


@query("SELECT unnest(range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-03', INTERVAL 6 HOURS)) AS value")
def series_times_open(spark, sf_dir):
    return files.generate_times(spark, "2024-01-01 00:00:00", "2024-01-03 00:00:00", "6 HOURS", inclusive=False)


@query("SELECT string_agg(r_name, ' ' ORDER BY r_regionkey) AS content, sum(length(r_name) + 1)::BIGINT AS size, 1 AS files FROM region")
def text_and_glob(spark, sf_dir):
    path = shared_folder(spark, "text")
    table(spark, sf_dir, "region").orderBy("r_regionkey").select("r_name").coalesce(1).write.text(path)
    found = files.read_text(spark, f"{path}/*.txt").select(F.trim(F.translate("content", "\n", " ")).alias("content"), "size")
    n = files.glob(spark, f"{path}/*.txt").agg(F.count("*").cast("int").alias("files"))
    return found.crossJoin(F.broadcast(n))  # a row


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def csv_sniffed(spark, sf_dir):
    path = shared_folder(spark, "sniffed")
    sinks.copy_to(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), path, "csv", header="true", sep=";")
    found = files.sniff_csv(spark, path)
    return files.read_csv(spark, path, "o_orderkey long, o_orderstatus string", found["delimiter"], found["has_header"])


@query("SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def tables_by_name(spark, sf_dir):
    table(spark, sf_dir, "customer").select("c_custkey", "c_name").createOrReplaceTempView("quern_a")
    table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").createOrReplaceTempView("quern_b")
    return files.query_table(spark, ["quern_a", "quern_b"])


@query("SELECT n_nationkey, n_name FROM nation")
def arrow_scan(spark, sf_dir):
    return client.register(spark, "quern_arrow", client.fetch_arrow(table(spark, sf_dir, "nation").select("n_nationkey", "n_name")))


@query("SELECT count(*) AS rows, 1 AS columns, true AS noted FROM orders")
def parquet_file_footers(spark, sf_dir):
    path = shared_folder(spark, "footers")
    sinks.copy_to(table(spark, sf_dir, "orders").select("o_orderkey"), path)
    noted = files.parquet_kv_metadata(spark, f"{path}/*.parquet").where(F.decode("key", "UTF-8") == "org.apache.spark.version").agg((F.count("*") > 0).alias("noted"))
    found = files.parquet_file_metadata(spark, f"{path}/*.parquet").agg(F.sum("rows").alias("rows"), F.max("columns").cast("int").alias("columns"))
    return found.join(F.broadcast(noted))  # a row each


@query("SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def csv_reject_lines(spark, sf_dir):
    path = shared_folder(spark, "rejects")
    bad = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("x"), "c_custkey")).otherwise(F.col("c_custkey").cast("string"))
    sinks.copy_to(table(spark, sf_dir, "customer").select(bad.alias("k"), "c_acctbal"), path, "csv", header="true")
    return files.csv_rejects(spark, path, "k long, c_acctbal double", header="true").select(F.regexp_extract("line", "^x([0-9]+)", 1).cast("long").alias("c_custkey"))


@query("SELECT p_partkey, p_name FROM part")
def csv_with_options(spark, sf_dir):
    path = shared_folder(spark, "options")
    sinks.copy_to(table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") >= 0, F.col("p_name")).alias("p_name")), path, "csv", header="false", sep="^", nullValue="NA")
    return files.read_csv(spark, path, "p_partkey long, p_name string", "^", False, **files.csv_options(nullstr="NA", comment="#", encoding="UTF-8"))


@query("SELECT (-128)::TINYINT AS tinyint, 32767::SMALLINT AS smallint, 9223372036854775807 AS bigint, '9999-12-31 23:59:59.999999'::TIMESTAMP AS timestamp_ntz, [42, 999, NULL] AS int_array, 1 AS nulls")
def all_types(spark, sf_dir):
    t = files.all_types(spark)
    return t.agg(F.min("tinyint").alias("tinyint"), F.max("smallint").alias("smallint"), F.max("bigint").alias("bigint"), F.max("timestamp_ntz").alias("timestamp_ntz"), F.max_by("int_array", F.size("int_array")).alias("int_array"), F.count_if(F.col("date").isNull()).alias("nulls"))


@query("""SELECT start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 2 HOURS, ts), time_bucket(INTERVAL 2 HOURS, ts) - INTERVAL 2 HOURS, time_bucket(INTERVAL 2 HOURS, ts) - INTERVAL 4 HOURS]) AS start FROM events) GROUP BY ALL""")
def stream_sliding(spark, sf_dir):
    stream = windows.file_stream(spark, f"{sf_dir}/events.parquet*", EVENTS.replace("timestamp_ntz", "timestamp"))
    out = windows.run_to_folder(windows.sliding(stream, "ts", "6 hours", "2 hours", "1000 days", ["event_type"], "value"), shared_folder(spark, "sliding"))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("SELECT 7 AS a, 'x' AS b FROM range(5)")
def repeated_row(spark, sf_dir):
    return files.repeat_row(spark, {"a": 7, "b": "x"}, 5)


@query("SELECT time_bucket(INTERVAL 6 HOURS, ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def stream_tumbling(spark, sf_dir):
    stream = windows.file_stream(spark, f"{sf_dir}/events.parquet*", EVENTS.replace("timestamp_ntz", "timestamp"))
    out = windows.run_to_folder(windows.tumbling(stream, "ts", "6 hours", "1000 days", ["event_type"], "value"), shared_folder(spark, "tumbling"))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 2).alias("total"))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n FROM n GROUP BY user_id, k""")
def stream_sessions(spark, sf_dir):
    stream = windows.file_stream(spark, f"{sf_dir}/events.parquet*", EVENTS.replace("timestamp_ntz", "timestamp"))
    out = windows.run_to_folder(windows.sessions(stream, "ts", "30 minutes", "1000 days", ["user_id"]), shared_folder(spark, "sessions"))
    return out.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")
