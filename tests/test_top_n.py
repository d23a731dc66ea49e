"""The n largest and smallest, and discrete quantiles, without a group's values in one place."""

import math
import random

import duckdb

from quern.functions import aggregates
from quern.plans import function_cases

KINDS = "k string, x long, y double"


def test_no_group_is_gathered(spark):
    plan = function_cases.QUERIES["agg_positions"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "percentile" not in plan.replace("percentile_approx", "") and "WindowGroupLimit" in plan
    gathered = plan.split("== Physical Plan ==")[1].split("collect_list(")[1:]
    assert gathered and all(g.startswith(("struct(place", "named_struct(place", "struct(i,", "named_struct(i,")) for g in gathered)


def test_top_n(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice([None, rng.randint(0, 99)]), rng.choice([None, float(rng.randint(-5, 5)), rng.uniform(-9, 9), math.inf])) for k in ("a", "b", None) for _ in range(400)]
    rows += [("few", 1, 2.0), ("few", None, 9.0), ("few", 3, None), ("none", None, None)]
    df = spark.createDataFrame(rows, KINDS).repartition(7)
    for largest in (True, False):
        want = {}
        for k in {k for k, x, y in rows if x is not None and y is not None}:
            known = sorted((-y if largest else y, x) for g, x, y in rows if g == k and x is not None and y is not None)
            want[k] = [x for _, x in known[:3]]
        assert {r["_m_k"]: r["top"] for r in aggregates.top_n(df, ["k"], "x", "y", 3, largest).collect()} == want
    assert aggregates.top_n(df, [], "y", "y", 2).first()["top"] == [math.inf, math.inf]
    odd = spark.createDataFrame([("n", 1, math.nan), ("n", 2, 5.0), ("n", 3, math.inf)], KINDS)
    assert aggregates.top_n(odd, ["k"], "x", "y", 2).first()["top"] == [1, 3]  # as in SQL, NaN is the largest


def test_discrete_quantiles(spark, monkeypatch):
    """Groups of 1 to 60 rows, as the SQL has them, also where a sketch is off."""
    fractions = [0.0, 0.1, 0.3, 0.5, 0.9, 1.0]
    rows = [(f"g{n}", i, float(random.Random(n * 100 + i).randint(-40, 40))) for n in range(1, 61) for i in range(n)]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k VARCHAR, x BIGINT, y DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    want = {r[0]: list(r[1:]) for r in con.execute(f"SELECT k, {', '.join(f'quantile_disc(y, {q})' for q in fractions)} FROM t GROUP BY k").fetchall()}
    df = spark.createDataFrame(rows, KINDS)
    found = lambda: {r["_m_k"]: r["quantiles"] for r in aggregates.quantiles(df, ["k"], "y", [0.5], fractions).collect()}
    assert {k: v[1:] for k, v in found().items()} == want
    monkeypatch.setattr(aggregates, "AROUND", (0.6, 0.7))
    assert {k: v[1:] for k, v in found().items()} == want
