"""Labels and scores of the license scan against a brute-force version, and repeated passages."""

import re

import pytest

from quern.llm import licenses


def brute(text):
    """Labels and score from all diagonals of all templates."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.encode().lower().decode())
    labels, score = set(), 0.0
    for t, (passage, label) in enumerate(licenses.PHRASES + licenses.PASSAGES):
        own = passage.split()
        k = licenses.SHORT_GRAM if len(own) <= licenses.SHORT else licenses.LONG_GRAM
        hits = {}
        for p in range(len(words) - k + 1):
            for a in range(len(own) - k + 1):
                if words[p : p + k] == own[a : a + k]:
                    hits.setdefault(p - a, set()).add(a)
        whole = {d for d, ats in hits.items() if len(ats) == len(own) - k + 1}
        shares = [1.0] * bool(whole)
        if t >= len(licenses.PHRASES):
            for d in hits.keys() - whole:
                near = [ats for e, ats in hits.items() if abs(e - d) <= licenses.NEAR and e not in whole]
                shares.append(len({a + i for ats in near for a in ats for i in range(k)}) / len(own))
        best = max(shares, default=0.0)
        if best >= licenses.SHARE:
            labels.add(label)
            score = max(score, best)
    return ",".join(sorted(labels)), score


def test_labels(spark):
    mit, bsd = licenses.PASSAGES[0][0], licenses.PASSAGES[8][0]
    edited = mit.split()
    del edited[20]
    edited[60:60] = ["really", "so"]
    edited[100] = "changed"
    texts = [
        "All rights reserved.",
        "All rights reserved. All rights reserved.",
        " ".join(["All rights reserved."] * 5),
        "rights reserved, all rights reserved",
        mit, mit + " " + mit, " ".join(edited), mit[: len(mit) // 2], mit[: len(mit) * 2 // 3], bsd + " " + " ".join(edited),
        "of the software and the use of the software " * 20, "", "MIT License",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(docs).collect()}
    for i, text in enumerate(texts):
        labels, score = brute(text)
        assert found[i][0] == labels, text
        assert found[i][1] == pytest.approx(score), text
    assert all("all-rights-reserved" in found[i][0] for i in range(4)) and "mit" in found[6][0]


def test_table(spark):
    import os

    docs = spark.read.parquet(os.environ.get("QUERN_SF_DIR", "/root/testdata/sf0.001") + "/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(docs).collect()}
    for r in rows:
        labels, score = brute(r["text"])
        assert found[r["doc_id"]] == (labels, pytest.approx(score))
