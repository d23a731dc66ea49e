"""A benchmark too large for every task: the join of n-grams gives what the scan gives; null ids and repeated rows."""

import os

import pytest
from pyspark.sql import functions as F

from quern.llm import decontaminate

SF_DIR = os.environ.get("QUERN_SF_DIR", "/root/testdata/sf0.001")


def test_join_equals_scan(spark, monkeypatch):
    docs, benchmark = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    item = benchmark.first()["text"].split()
    edited = " ".join(w if i % 5 else "zzz" for i, w in enumerate(item))
    more = spark.createDataFrame([(None, edited), (-1, edited + " after"), (-1, edited + " after"), (-2, None), (-3, "")], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(more)
    scanned = sorted(map(str, decontaminate.find(both, benchmark).collect()))
    clean = sorted(map(str, decontaminate.drop_contaminated(both, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 10)
    assert sorted(map(str, decontaminate.find(both, benchmark).collect())) == scanned and len(scanned) > 3
    assert sorted(map(str, decontaminate.drop_contaminated(both, benchmark).collect())) == clean
    assert decontaminate.find(both.limit(0), benchmark).count() == 0
    assert decontaminate.find(both.where(F.col("doc_id") < -1), benchmark).count() == 0


@pytest.mark.parametrize("every", [4, 5, 6, 8])
def test_recall_of_edited_items(spark, every):
    """All items with one word in so many replaced: those that score high enough by a whole alignment are found."""
    benchmark = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    edited = {-1 - i: (item, " ".join(w if k % every != every - 1 else "zzz" for k, w in enumerate(text.split()))) for i, (item, text) in enumerate(benchmark)}
    items = decontaminate.Items.of(benchmark)
    want = set()
    for doc, (item, text) in edited.items():
        k = items.ids.index(item)
        if decontaminate.align(items.number(text), items.words[k])[0] >= decontaminate.LEAST * decontaminate.MATCH * len(items.words[k]):
            want.add((doc, item))
    both = docs.unionByName(spark.createDataFrame([(d, "so it begins " + t + " and ends") for d, (_, t) in edited.items()], "doc_id long, text string"))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find(both, spark.createDataFrame(benchmark, "item_id long, text string")).collect()}
    assert len(want) >= 0.9 * len(benchmark) and want <= found
