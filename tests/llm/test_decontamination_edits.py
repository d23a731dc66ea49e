"""Edited copies of test items are found however many there are, in small and large tables."""

import random

import pytest
from test_llm_operators import SCHEMA, slow_align

from quern.llm import decontaminate

RNG = random.Random(8)
ITEMS = [(i, " ".join(f"w{RNG.randrange(300)}" for _ in range(RNG.choice((15, 40))))) for i in range(6)]
EDITS = {
    "inserts every third": lambda w: [x for i, y in enumerate(w) for x in ([y, "zzz"] if i % 3 == 2 else [y])],
    "substitutions every fifth": lambda w: [y if i % 5 != 4 else "zzz" for i, y in enumerate(w)],
}


@pytest.mark.parametrize("edit", sorted(EDITS))
@pytest.mark.parametrize(("copies", "size"), [(1, 300), (20, 300), (1, 10_000), (20, 10_000)])
def test_edits(spark, edit, copies, size):
    rows, want = [], set()
    for item, text in ITEMS:
        words = EDITS[edit](text.split())
        for _ in range(copies):
            want.add((len(rows), item))
            rows.append((len(rows), "start of it " + " ".join(words) + " its end", "en", "a", 1))
    rows += [(i, " ".join(f"w{RNG.randrange(300)}" for _ in range(20)), "en", "a", 1) for i in range(len(rows), size)]
    docs, benchmark = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find(docs, benchmark).collect()} == want
    left = {r["doc_id"] for r in decontaminate.drop_contaminated(docs, benchmark).select("doc_id").collect()}
    assert left == {r[0] for r in rows} - {i for i, _ in want}


def test_texts_left_out_score_too_low():
    """What the bound on words in common leaves out is below the least score over the whole text, too."""
    rng = random.Random(4)
    for _ in range(200):
        item = " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(5, 12)))
        text = " ".join(rng.choice("abcdefgh") for _ in range(40)) if rng.random() < 0.5 else " ".join(x for y in item.split() for x in ([y, "q"] if rng.random() < 0.3 else [y]))
        items = decontaminate.Items.of([(1, item)])
        words = items.number(text)
        size = len(items.known) + 1
        share = slow_align(words.tolist(), items.words[0].tolist()) / (2 * len(items.words[0]))
        seeded = set(decontaminate._grams(words, size).tolist()) & set(items.grams.tolist())
        found = decontaminate.matches(text, items)
        assert not found or found[0][1] == share >= decontaminate.LEAST
        if share >= decontaminate.LEAST and seeded and len(words) < 20:
            assert found
