"""Exact medians without a group's values in one place."""

import math
import random
import statistics

import duckdb

from quern.functions import aggregates
from quern.plans import function_cases


def _mad(rows):
    out = {}
    for k in {k for k, _ in rows}:
        xs = [x for g, x in rows if g == k and x is not None]
        if xs:
            middle = statistics.median(xs)
            out[k] = statistics.median([abs(x - middle) for x in xs])
    return out


def test_mad(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(k, rng.choice([None, rng.uniform(-9, 9), 2.5, -1e300])) for k in ("a", "b", None) for _ in range(3001)]
    rows += [("two", 1.0), ("two", 4.0), ("one", 7.0), ("none", None), *[("four", float(i)) for i in range(4)], *[("far", math.inf)] * 2, *[("far", float(i)) for i in range(5)]]
    df = spark.createDataFrame(rows, "k string, x double")
    run = lambda: aggregates.mad(df, ["k"], "x")
    assert "percentile(" not in run()._jdf.queryExecution().toString() and "median(" not in run()._jdf.queryExecution().toString()
    want = _mad(rows)
    assert {r["k"]: r["mad"] for r in run().collect()} == want
    monkeypatch.setattr(aggregates, "AROUND", (0.6, 0.7))  # a sketch that is off
    assert {r["k"]: r["mad"] for r in run().collect()} == want
    assert aggregates.mad(df, [], "x").first()["mad"] == _mad([(0, x) for _, x in rows])[0]
    assert aggregates.mad(df.where("k = 'none'"), ["k"], "x").count() == 0


def test_quantiles(spark, tmp_path):
    """Groups of 1 to 120 rows, prices in cents: to the last digit, and rounded, as the SQL has them."""
    con = duckdb.connect()
    made = "SELECT l_orderkey, l_orderkey % 97 AS l_partkey, 1 AS l_linenumber, round(900 + (hash(l_orderkey) % 10000000) / 100.0, 2)::DOUBLE AS l_extendedprice, l_returnflag"
    con.execute(f"COPY ({made} FROM (SELECT (g * 1000 + j)::BIGINT AS l_orderkey, 'g' || g AS l_returnflag FROM range(1, 121) a(g), range(120) b(j) WHERE j < g)) TO '{tmp_path}/lineitem.parquet'")
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet'")
    want = {r[0]: r[1:] for r in con.execute(f"SELECT l_returnflag, f_quantile_cont, f_quantile_conts FROM ({function_cases.ORACLE_SQL['agg_positions']})").fetchall()}
    found = function_cases.QUERIES["agg_positions"](spark, str(tmp_path)).collect()
    assert {r["l_returnflag"]: (r["f_quantile_cont"], r["f_quantile_conts"]) for r in found} == want
    odd = spark.createDataFrame([("far", math.inf), ("far", 1.0), ("far", 3.0), ("none", None), (None, 2.0), (None, -math.inf)], "k string, x double")
    assert {r["_m_k"]: r["quantiles"] for r in aggregates.quantiles(odd, ["k"], "x", [0.0, 0.25, 0.5, 1.0]).collect()} == {"far": [1.0, 2.0, 3.0, math.inf], None: [-math.inf, -math.inf, -math.inf, 2.0]}
