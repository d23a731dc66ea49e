import pytest
from pyspark.sql import functions as F

from quern.functions.registry import call
from quern.operators import changes, joins, rows, sets
from quern.sources import files, sinks
from quern.streaming import windows as streams


def values(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_asof_small(spark):
    l = spark.createDataFrame([(float(i),) for i in range(10)], "ts double")
    r = spark.createDataFrame([(2.0, 0), (4.0, 1), (6.0, 2), (8.0, 3)], "event_ts double, event_id int")
    out = {t: i for t, _, i in joins.asof_join(l, r, "ts", "event_ts").collect()}
    assert out == {0: None, 1: None, 2: 0, 3: 0, 4: 1, 5: 1, 6: 2, 7: 2, 8: 3, 9: 3}
    assert joins.asof_join(l, r, "ts", "event_ts", how="inner", op=">").count() == 7
    assert joins.asof_join(l, r, "ts", "event_ts", how="semi").count() == 8
    with pytest.raises(ValueError):
        joins.asof_join(l, r, "ts", "event_ts", op="<>")


def test_asof_outer(spark):
    l = spark.createDataFrame([(1, 5.0), (2, 5.0), (None, 7.0)], "k int, t double")
    r = spark.createDataFrame([(1, 4.0, "a"), (1, 1.0, "b"), (3, 0.0, "c")], "k2 int, t2 double, v string")
    assert values(joins.asof_join(l, r, "t", "t2", [("k", "k2")], "outer").select("k", "v")) == sorted([(1, "a"), (2, None), (None, None), (None, "b"), (None, "c")], key=str)


def test_positional_and_sets(spark):
    l, r = spark.createDataFrame([(11, 1), (12, 2), (13, 3)], "a int, b int"), spark.createDataFrame([(11, 1), (12, 2)], "c int, d int")
    assert values(joins.positional_join(l, r, ["a"], ["c"])) == [(11, 1, 11, 1), (12, 2, 12, 2), (13, 3, None, None)]
    a, b = spark.createDataFrame([(1, 3), (2, 4)], "a int, b int"), spark.createDataFrame([(1, 3), (6, 8)], "a int, b int")
    assert values(sets.symmetric_difference(a, b)) == [(2, 4), (6, 8)]


def test_recursion_using_key(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "a int, b int")
    seed = spark.createDataFrame([(1, 0)], "node int, depth int")

    def step(new, found):
        reached = new.join(edges, F.col("node") == F.col("a")).groupBy("b").agg(F.min(F.col("depth") + 1).alias("depth"))
        known = found.select(F.col("node").alias("b"), F.col("depth").alias("old"))
        return reached.join(known, "b", "left").where("old IS NULL OR depth < old").select(F.col("b").alias("node"), "depth")

    assert values(sets.recursive_using_key(seed, step, ["node"])) == [(1, 0), (2, 1), (3, 2), (4, 3)]


def test_changes(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    n = spark.createDataFrame([(2, "x"), (3, "y")], "k int, v string")
    assert values(changes.insert(t, n, ["k"], "nothing")) == [(1, "a"), (2, "b"), (3, "y")]
    assert values(changes.insert(t, n, ["k"], "update")) == [(1, "a"), (2, "x"), (3, "y")]
    with pytest.raises(ValueError):
        changes.insert(t, n, ["k"])
    assert values(changes.delete(t, F.col("v") == "a")) == [(2, "b")]
    assert values(changes.merge(t, n, ["k"], {"v": F.col("s.v")}, None, None, "delete")) == [(2, "x")]


def test_files(spark, tmp_path):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("p"), F.concat(F.lit("n"), "id").alias("name"))
    sinks.copy_to(df, str(tmp_path / "q"), partition_by=["p"])
    assert files.read_parquet(spark, str(tmp_path / "q"), filename=True, file_row_number=True).count() == 10
    assert files.parquet_metadata(spark, f"{tmp_path}/q/p=0/*.parquet").where("column = 'id'").agg(F.sum("rows")).first()[0] == 5
    sinks.copy_to(df, str(tmp_path / "c"), "csv", header="true", sep=";")
    assert files.sniff_csv(spark, str(tmp_path / "c"))["delimiter"] == ";"
    assert values(files.read_csv(spark, str(tmp_path / "c")).select("id")) == [(i,) for i in range(10)]
    rejects = files.read_csv(spark, str(tmp_path / "c"), "id date, name string", ";", True, store_rejects=True).collect()
    assert len(rejects) == 10 and all(r["_rejected"] is not None for r in rejects)
    assert files.glob(spark, f"{tmp_path}/c/*.csv").count() >= 1
    assert files.generate_series(spark, 1, 5).count() == 5
    assert files.read_text(spark, f"{tmp_path}/c/*.csv").count() >= 1


def test_streams(spark, tmp_path):
    e = spark.createDataFrame([(i, f"2024-01-01 00:{i:02d}:00", i % 3, 1.0) for i in range(60)], "id long, t string, k long, v double").withColumn("t", F.to_timestamp("t"))
    e.repartition(3).write.parquet(str(tmp_path / "in"))
    s = streams.file_stream(spark, str(tmp_path / "in"), "id long, t timestamp, k long, v double", 10)
    assert streams.run_to_memory(streams.tumbling(s, "t", "10 minutes", "1 hour", ["k"], "v"), "tumbling", "complete").agg(F.sum("n")).first()[0] == 60
    assert streams.run_to_memory(streams.running_totals(s, "k", "v"), "totals", "update").groupBy("k").agg(F.max("n").alias("n")).agg(F.sum("n")).first()[0] == 60
    assert sum(map(len, streams.chunks(e, 7))) == 60


def test_functions_that_fail(spark):
    one = spark.createDataFrame([(-1.0, 2.0)], "x double, y double")
    for name, arg in (("sqrt", "x"), ("ln", "x"), ("acos", "y")):
        with pytest.raises(Exception, match="undefined"):
            one.select(call(name, arg)).collect()
    assert rows.columns(one, "x|z") == ["x"]


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "k int, t double")
    other = spark.createDataFrame([], "k2 int, t2 double")
    assert joins.asof_join(empty, other, "t", "t2", [("k", "k2")]).count() == 0
    assert rows.numbered(empty, ["t"]).count() == 0
    assert rows.distinct_on(empty, ["k"], [F.col("t")]).count() == 0
