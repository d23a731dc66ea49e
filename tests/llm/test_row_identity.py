"""Rows that share a doc_id, or have none, are documents of their own where their texts differ."""

import pytest
from pyspark.sql import functions as F

from quern.llm import lines, substrings

SHARED = " ".join(f"shared{i}" for i in range(30))


@pytest.mark.parametrize("doc_id", [7, None])
def test_substrings_of_one_id(spark, doc_id):
    rows = [(doc_id, SHARED + " " + " ".join(f"a{i}" for i in range(300))), (doc_id, "short " + SHARED), (doc_id, None), (9, SHARED)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = substrings.drop_repeats(df).collect()
    assert len(out) == 4 and next(r for r in out if r["doc_id"] == 9)["n_removed"] == 30
    removed = sorted(r["n_removed"] for r in out if r["doc_id"] == doc_id)
    assert removed == [0, 0, 30]
    for r in out:
        if r["n_words"] == 330:
            assert r["kept"].split()[-300:] == [f"a{i}" for i in range(300)]
    twice = substrings.drop_repeats(df.unionByName(df)).collect()  # the same rows again are the same documents
    assert sorted(map(str, twice)) == sorted(map(str, out + out))


@pytest.mark.parametrize("doc_id", [7, None])
def test_lines_of_one_id(spark, doc_id):
    rows = [(doc_id, "x only\nA shared line of all of them"), (doc_id, "A shared line of all of them\nprecious different words"), *[(i, f"own{i} words{i} of{i}\nA shared line of all of them") for i in range(10, 16)]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = [r["text"] for r in lines.drop_lines(df).where(F.col("doc_id").eqNullSafe(F.lit(doc_id))).collect()]
    assert sum("shared" in t for t in out) == 1 and any("x only" in t for t in out) and any("precious" in t for t in out)
    assert sum("shared" in r["text"] for r in lines.drop_lines(df).collect()) == 1


def test_short_lines(spark):
    rows = [(i, f"Yes.\nPage {i} of 40\n17\n\nunlike{i}") for i in range(6)]
    out = {r["doc_id"]: r["text"] for r in lines.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0] == rows[0][1] and all(out[i] == f"17\n\nunlike{i}" for i in range(1, 6))
