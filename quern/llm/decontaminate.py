"""Benchmark decontamination: n-gram seeds join texts to test items, Smith-Waterman alignment scores them.

All word n-grams of a test item are its seeds, however many documents hold them: an n-gram's count says how
often the item leaked as much as how common its words are.  Where a text holds a seed, the stretch around it
is aligned with the item, word by word; the score is the local alignment's, as a share of what the whole item
against itself would get.  The stretch is as long as the score LEAST leaves room for gaps, and is left out
only where the item's words that it holds, matched in any order, can't reach that score.

A benchmark of at most BLOCK_WORDS words goes to the tasks whole, which then scan the texts once and shuffle nothing.
A larger one stays a table: Spark joins the n-grams of the texts to those of the items, and then the pairs of text
and item that share one to their words, for the same alignment.  Texts that are alike are one there.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import checkpointed, map_arrow

#: Words of a seed.
N = 3
#: Alignment: match, mismatch, gap.  Share of the full score from which a text is contaminated.
MATCH, MISMATCH, GAP, LEAST = 2, -1, -1, 0.6
BLOCK_WORDS = 2_000_000
WORD = re.compile(r"\w+")


@dataclass
class Items:
    """Test items: ids, their words as numbers (from 1), and where each n-gram stands."""

    ids: list[int]
    words: list[np.ndarray]
    known: dict[str, int]
    grams: np.ndarray
    item: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Items:
        known: dict[str, int] = {}
        words = [np.array([known.setdefault(w, len(known) + 1) for w in WORD.findall(t.lower())], np.int64) for _, t in rows]
        size = len(known) + 1
        found = [_grams(w, size) for w in words]
        grams = np.concatenate([np.zeros(0, np.int64), *found])
        item = np.repeat(np.arange(len(rows)), [len(f) for f in found])
        at = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(f)) for f in found]])
        order = np.argsort(grams, kind="stable")
        return cls([i for i, _ in rows], words, known, grams[order], item[order], at[order])

    def number(self, text: str | None) -> np.ndarray:
        """The words of a text; 0 for a word of no item."""
        get = self.known.get
        return np.array([get(w, 0) for w in WORD.findall((text or "").lower())], np.int64)


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    """Each n-gram as a number; -1 where it has a word of no item.  size: words known, and one."""
    n = len(words) - N + 1
    if n < 1:
        return np.zeros(0, np.int64)
    out, whole = np.zeros(n, np.int64), np.ones(n, bool)
    for i in range(N):
        out = out * size + words[i : n + i]
        whole &= words[i : n + i] > 0
    return np.where(whole, out, -1)


def align(text: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of the item in the text: score, first word, and the word after its last."""
    steps = np.arange(1, len(text) + 1) * -GAP
    row, begin = np.zeros(len(text) + 1, np.int64), np.arange(len(text) + 1)
    best = (0, 0, 0)
    for word in item.tolist():
        diagonal = row[:-1] + np.where(text == word, MATCH, MISMATCH)
        down = row[1:] + GAP
        score = np.maximum(np.maximum(diagonal, down), 0)
        start = np.where(score == 0, np.arange(1, len(text) + 1), np.where(score == diagonal, begin[:-1], begin[1:]))
        raised = score + steps
        top = np.maximum.accumulate(raised)
        source = np.maximum.accumulate(np.where(raised == top, np.arange(len(text)), 0))
        across = top - steps
        start = np.where(across > score, start[source], start)
        row = np.concatenate(([0], np.maximum(score, across)))
        begin = np.concatenate(([0], start))
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), int(begin[j]), j)
    return best


def _in_common(text: np.ndarray, item: np.ndarray) -> int:
    """Words of the item that the text holds, each as often as it does; no alignment matches more."""
    own, counts = np.unique(item, return_counts=True)
    at = np.minimum(np.searchsorted(own, text), len(own) - 1)
    return int(np.minimum(np.bincount(at[own[at] == text], minlength=len(own)), counts).sum())


def matches(text: str | None, items: Items, least: float = LEAST) -> list[tuple[int, float, int, int]]:
    """(item, score, first word, word after the last) of each item that the text holds with ``least`` or more, at its best place."""
    words = items.number(text)
    grams = _grams(words, len(items.known) + 1)
    places = np.nonzero(grams >= 0)[0]
    if not len(places) or not len(items.grams):
        return []
    low, high = np.searchsorted(items.grams, grams[places], "left"), np.searchsorted(items.grams, grams[places], "right")
    counts = high - low
    hits = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    if not len(hits):
        return []
    item, origin = items.item[hits], np.repeat(places, counts) - items.at[hits]
    order = np.lexsort((origin, item))
    item, origin = item[order], origin[order]
    out: dict[int, tuple[int, float, int, int]] = {}
    new = np.concatenate(([True], (item[1:] != item[:-1]) | (origin[1:] - origin[:-1] > 8)))  # stretches apart
    for begin, end in zip(np.nonzero(new)[0], [*np.nonzero(new)[0][1:], len(item)], strict=True):
        k = int(item[begin])
        size = len(items.words[k])
        room = int(MATCH * (1 - least) * size / -GAP) + 1  # more gaps take the score below least
        a = max(0, int(origin[begin]) - room)
        b = min(len(words), int(origin[end - 1]) + size + room)
        if _in_common(words[a:b], items.words[k]) / size < least:
            continue
        score, first, last = align(words[a:b], items.words[k])
        share = score / (MATCH * size)
        if share >= least and (k not in out or share > out[k][1]):
            out[k] = (items.ids[k], share, a + first, a + last)
    return list(out.values())


def _items(benchmark: DataFrame) -> DataFrame:
    """(item_id, text) of the test items.  Null ids and texts are no items."""
    return benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), F.col("text").cast("string"))


def _small(items: DataFrame) -> Items | None:
    """All items, in the order of id, if their words are few enough for every task to have them."""
    size = items.agg(F.sum(F.size(F.split("text", r"\W+")))).first()[0] or 0  # not fewer than the words
    if size > BLOCK_WORDS:
        return None
    return Items.of([(i, t) for i, t in items.orderBy("item_id", "text").collect() if WORD.search(t)])


def _n_grams(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(key, gram): the distinct n-grams of each text, as hashes."""
    keys, grams = [], []
    for i, text in enumerate(batch.column(1).to_pylist()):
        words = WORD.findall((text or "").lower())
        found = {xxhash.xxh64_intdigest(" ".join(words[k : k + N])) for k in range(len(words) - N + 1)}
        grams.append(np.fromiter(found, np.uint64, len(found)))
        keys.append(np.full(len(found), i))
    columns = [batch.column(0).take(pa.array(np.concatenate(keys).astype(np.int64))), pa.array(np.concatenate(grams).view(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["key", "gram"])


def _joined(docs: DataFrame, items: DataFrame, least: float) -> DataFrame:
    """(key, item_id, score, first_word, last_word) of the texts (key, text), by a join of n-grams."""
    of_texts = map_arrow(docs.select("key", "text"), _n_grams, "key string, gram long").distinct()
    of_items = map_arrow(items, _n_grams, "key long, gram long").withColumnRenamed("key", "item_id")
    pairs = of_texts.join(of_items, "gram").select("key", "item_id").distinct()
    texts = docs.join(pairs.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"]).select("key", "text")
    both = pairs.join(texts, "key").join(items.withColumnRenamed("text", "item"), "item_id").select("key", "text", "item_id", "item")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = [(k, *m) for k, t, i, item in zip(*(c.to_pylist() for c in batch.columns), strict=True) for m in matches(t, Items.of([(i, item)]), least)]
        if not rows:
            return None
        kinds = [pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["key", "item_id", "score", "first_word", "last_word"])

    found = map_arrow(both, run, "key string, item_id long, score double, first_word long, last_word long")
    return checkpointed(found)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("string")).where("text is not null").withColumn("key", F.sha2("text", 256))


def find(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word): a row per text and test item that it holds, edited or not.

    Null and empty texts and items match nothing, nor do items of fewer words than a seed.  Repeated rows match
    each; an empty table gives no rows.  Other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    items = _items(benchmark)
    small = _small(items)
    if small is None:
        keyed = _keyed(docs)
        return keyed.join(_joined(keyed, items, least), "key").select("doc_id", "item_id", "score", "first_word", "last_word")
    shared = docs.sparkSession.sparkContext.broadcast(small)

    def search(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found = [(i, m) for i, t in enumerate(batch.column(1).to_pylist()) for m in matches(t, shared.value, least)]
        if not found:
            return None
        which, rows = zip(*found, strict=True)
        ids, scores, first, last = zip(*rows, strict=True)
        columns = [batch.column(0).take(pa.array(which)), pa.array(ids, pa.int64()), pa.array(scores), pa.array(first, pa.int64()), pa.array(last, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "score", "first_word", "last_word"])

    return map_arrow(docs.select("doc_id", F.col("text").cast("string")), search, f"doc_id {kind}, item_id long, score double, first_word long, last_word long")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with their columns."""
    items = _items(benchmark)
    small = _small(items)
    names = [f"_doc_{i}" for i in range(len(docs.columns))]
    given = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)], F.col("text").cast("string").alias("_text"))
    back = [F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)]
    if small is None:
        keys = _joined(_keyed(docs), items, least).select(F.col("key").alias("_key")).distinct()
        return given.withColumn("_key", F.coalesce(F.sha2("_text", 256), F.lit(""))).join(keys, "_key", "left_anti").select(*back)
    shared = docs.sparkSession.sparkContext.broadcast(small)

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = shared.value
        return batch.filter(pa.array([not matches(t, own, least) for t in batch.column(batch.num_columns - 1).to_pylist()], pa.bool_()))

    kept = map_arrow(given, clean, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema))
    return kept.select(*back)
