"""The client's calls that end in the driver or in a table."""

import uuid

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern import client
from quern.functions.verbs import apply


def test_tables(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    try:
        client.write_table(spark.range(3).withColumn("v", F.lit("a")), name)
        client.write_table(spark.range(3, 4), name, append=True)
        assert client.appender(spark, name, iter([[(7, "x")], [(8, "y"), (9, "z")]]), 2) == 3
        assert sorted(client.fetch(spark.table(name))) == sorted([(0, "a"), (1, "a"), (2, "a"), (3, None), (7, "x"), (8, "y"), (9, "z")])
        client.rel_insert(spark.range(1), name)
        assert client.rel_from_table(spark, name).count() == 8
        assert client.fetch(client.execute(spark, f"ALTER TABLE {name} ADD COLUMN w INT; SELECT count(w), count(*) FROM {name}")) == [(0, 8)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_fetching(spark):
    df = spark.range(10).repartition(3)
    assert len(client.fetch(df, 4)) == 4 and sum(map(len, client.fetch_chunks(df, 3))) == 10
    assert client.fetch_arrow(df).num_rows == 10 and sum(b.num_rows for b in client.record_batches(df, 4)) == 10
    assert len(client.materialize(df, 10)) == 10
    with pytest.raises(RuntimeError):
        client.materialize(df, n_cells=9)
    assert "Range" in client.explain(df) and client.fetch(client.describe(df)) == [("id", "bigint", "NO")]


def test_sources(spark, tmp_path):
    for data in (pd.DataFrame({"a": [1, 2]}), pa.table({"a": [1, 2]})):
        assert client.fetch(client.rel_from_df(spark, data)) == [(1,), (2,)]
        assert client.register(spark, "quern_frame", data).count() == 2
    client.rel_to_parquet(spark.range(2), str(tmp_path / "x.parquet"))
    client.rel_to_csv(spark.range(2), str(tmp_path / "x.csv"))
    assert client.tbl_file(spark, str(tmp_path / "x.parquet")).count() == client.tbl_file(spark, str(tmp_path / "x.csv")).count() == 2
    assert client.rel_from_table_function(spark, "range", 3).count() == 3
    assert client.fetch(client.rel_sql(spark.range(3), "SELECT sum(id) FROM {_}")) == [(3,)]


def test_set_and_join_calls(spark):
    a, b = spark.createDataFrame([(1, 3), (2, 4)], "a int, b int"), spark.createDataFrame([(1, 3), (6, 8)], "a int, b int")
    assert client.fetch(client.rel_set_intersect(a, b)) == [(1, 3)] and client.fetch(client.rel_set_diff(a, b)) == [(2, 4)]
    assert sorted(client.fetch(client.rel_set_symdiff(a, b))) == [(2, 4), (6, 8)] and client.rel_union_all(a, b).count() == 4
    assert client.fetch(client.rel_join(a, b, [("a", "a")], "semi")) == [(1, 3)]
    assert client.rel_join(a, b, [], "cross").count() == 4 and client.rel_join(a, b, [], kind="natural").count() == 1
    up = client.rel_order(spark.createDataFrame([(None,), (2,), (1,)], "x int"), ["x"], False)
    assert client.fetch(up) == [(2,), (1,), (None,)]


def test_null_strict_verbs(spark):
    df = spark.createDataFrame([(1.0, True), (None, None), (float("nan"), False)], "x double, p boolean")
    found = df.select(apply("r_sum", "x"), apply("r_sum", "x", True), apply("r_any", "p"), apply("r_all", "p"), apply("r_all", "p", True)).first()
    assert found[0] is None and found[1] != found[1] and found[2] is True and found[3] is False and found[4] is False
    assert [r[0] for r in df.select(apply("is_na", "x")).collect()] == [False, True, False]
    one = spark.range(1).select(apply("r_/", F.lit(1), F.lit(0)), apply("r_/", F.lit(-1), F.lit(0)), apply("r_/", F.lit(0), F.lit(0))).first()
    assert one[0] == float("inf") and one[1] == float("-inf") and one[2] != one[2]
    assert spark.range(2_000_000).select(F.col("id").cast("int").alias("i")).agg(apply("r_sum", "i")).first()[0] == 1999999000000
