"""Range and overlap joins: however many rows a bin has, a list meets no more than a chunk of them at once."""

import random
import re

import pytest

from quern.operators import joins


@pytest.mark.parametrize("broadcast", [True, False])
def test_full_bin(spark, monkeypatch, broadcast):
    monkeypatch.setattr(joins, "LIST_ROWS", 8)
    monkeypatch.setattr(joins, "CHUNK_ROWS", 16)
    if not broadcast:
        monkeypatch.setattr(joins, "BROADCAST_ROWS", -1)
    r = random.Random(5)
    a = [(i, x, x + r.randint(0, 4)) for i in range(600) for x in [r.choice([7, r.randint(0, 30)])]]
    b = [(k, x, x + r.randint(0, 9)) for k in range(300) for x in [r.choice([6, r.randint(-3, 30)])]]
    left, right = spark.createDataFrame(a, "i int, a0 int, a1 int"), spark.createDataFrame(b, "k int, b0 int, b1 int")
    both = sorted(x + y for x in a for y in b if x[1] <= y[2] and y[1] <= x[2])
    inside = sorted(x + y for x in a for y in b if y[1] <= x[1] <= y[2])
    for width in (100.0, 5.0):  # one bin for all, and rows that begin before theirs
        met = joins.overlap_join(left, right, "a0", "a1", "b0", "b1", width)
        assert sorted(map(tuple, met.collect())) == both
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"Join \[[^\]]*_in#", plan)  # lists and rows meet by chunk, not by bin alone
        assert sorted(map(tuple, joins.overlap_join(right, left, "b0", "b1", "a0", "a1", width).collect())) == sorted(y + x for x, y in ((p[:3], p[3:]) for p in both))
        assert sorted(map(tuple, joins.range_join(left, right, "a0", "b0", "b1", width).collect())) == inside
