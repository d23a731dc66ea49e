"""Range and overlap joins: the same pairs whatever meets in lists, and a product of rows that takes little space in files."""

import datetime
import random
from pathlib import Path

import pytest

from quern.operators import joins


@pytest.fixture(params=["as it is", "small lists, no broadcast"])
def sizes(request, monkeypatch):
    if request.param != "as it is":
        for name, value in (("LIST_ROWS", 4), ("TASK_ROWS", 16), ("MOST_TASKS", 5), ("BROADCAST_ROWS", -1)):
            monkeypatch.setattr(joins, name, value, raising=False)


def intervals(seed, n, longest):
    r = random.Random(seed)
    rows = [(i, low, low + r.randint(-1, longest)) for i in range(n) for low in [r.randint(-40, 40)]]
    return rows + rows[:3] + [(-1, None, 3), (-2, 3, None), (-3, None, None), (-4, 7, 7), (-5, 7, 6), (-6, -40, 45)]


@pytest.mark.parametrize(("n", "m"), [(150, 20), (20, 150), (0, 5)])
def test_every_pair_once(spark, sizes, n, m):
    a, b = intervals(1, n, 9), intervals(2, m, 30)
    left, right = spark.createDataFrame(a, "i int, a0 int, a1 int"), spark.createDataFrame(b, "k int, b0 int, b1 int")
    known = [[r for r in rows if None not in r and r[1] <= r[2]] for rows in (a, b)]
    both = sorted(x + y for x in known[0] for y in known[1] if x[1] <= y[2] and y[1] <= x[2])
    met = joins.overlap_join(left, right, "a0", "a1", "b0", "b1", 5.0)
    assert met.columns == ["i", "a0", "a1", "k", "b0", "b1"]
    assert sorted(map(tuple, met.collect())) == both
    inside = sorted(x + y for x in a if x[1] is not None for y in known[1] if y[1] <= x[1] <= y[2])
    met = joins.range_join(left, right, "a0", "b0", "b1", 5.0)
    assert met.columns == ["i", "a0", "a1", "k", "b0", "b1"]
    assert sorted(map(tuple, met.collect()), key=str) == sorted(inside, key=str)


def test_points_that_are_no_common_numbers(spark, sizes):
    points = spark.createDataFrame([(x,) for x in (float("inf"), float("-inf"), float("nan"), 1.0, None)], "t double")
    spans = spark.createDataFrame([(0.0, 2.0), (1.0, 1.0), (2.0, 0.0)], "low double, high double")
    assert sorted(map(tuple, joins.range_join(points, spans, "t", "low", "high", 1.0).collect())) == [(1.0, 0.0, 2.0), (1.0, 1.0, 1.0)]
    day = datetime.date(2024, 1, 1)
    days = spark.createDataFrame([(day, {"a": 1}), (day + datetime.timedelta(9), {"b": 2})], "t date, m map<string,int>")
    spans = spark.createDataFrame([(day, day + datetime.timedelta(2))], "t0 date, t1 date")
    assert [r["m"] for r in joins.range_join(days, spans, "t", "t0", "t1", 86400.0).collect()] == [{"a": 1}]


def test_product_takes_little_space(spark, tmp_path):
    r = random.Random(3)
    points = spark.createDataFrame([(i, 50 + r.random()) for i in r.sample(range(10**9), 4000)], "i long, t double")
    spans = spark.createDataFrame([(k, 40 + r.random(), 60 + r.random()) for k in r.sample(range(10**9), 500)], "k long, low double, high double")
    for name, met in (
        ("range", joins.range_join(points, spans, "t", "low", "high", 5.0)),
        ("overlap", joins.overlap_join(points.withColumn("t1", points["t"] + 1), spans, "t", "t1", "low", "high", 5.0)),
    ):
        met.select("i", "k").write.parquet(str(tmp_path / name))
        assert spark.read.parquet(str(tmp_path / name)).distinct().count() == 4000 * 500
        assert sum(p.stat().st_size for p in Path(tmp_path / name).glob("*.parquet")) < 0.5 * 4000 * 500
