"""Substring dedup: repeated word windows found through prefix-partitioned suffix trees.

Suffixes are of words, and sparse: of the eleven runs of ten words in a window of twenty, the one with the
lowest hash is the window's anchor, so equal windows have equal anchors at equal places, and only one word
in six starts a suffix.  A suffix is partitioned by a prefix of variable length:

* its first ten words (as a 64-bit hash) bring suffixes together.  Those of the same span, which is all words
  of the windows that they anchor (told apart by another 64 bits), fall into one leaf; all but the first
  repeat it.  A slice of documents folds its own before the shuffle.  Spans alone with their prefix are done.
* the first of each span of a prefix with several carries its words to a memory-sized part, in which each
  prefix is a subtree: the sorted suffixes with their common prefix lengths.  An internal node at depth
  20 - l, split by the l words to the left, holds the repeats of a window that starts l words before the anchor.
* prefixes with more than GROUP spans are lengthened to the whole window; such a group is a single node,
  whose occurrences Spark sorts.

A hot span leaves one row per slice of documents; Spark's sort, which spills, orders these.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import SLICE, as_bytes, checkpointed, map_arrow, with_ties

#: Words of a window and of the least prefix; offsets of an anchor in its window.
WINDOW, PREFIX = 20, 10
OFFSETS = WINDOW - PREFIX + 1
#: Most spans of one prefix that a subtree takes; spans of a part, about.
GROUP, PART = 20_000, 5_000
#: Stands for a null doc_id.
NO_ID = -(1 << 63)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """64-bit hashes of words, remembered in ``known``."""
    if len(known) > 500_000:
        known.clear()
    get, digest = known.get, xxhash.xxh3_64_intdigest
    out = []
    for w in words:
        h = get(w)
        if h is None:
            h = known[w] = digest(w)
        out.append(h)
    return np.array(out, np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each anchor of a text of at least WINDOW words: prefix hash, span hash, first window start, windows, offset."""
    n = len(hashes) - PREFIX + 1
    runs = np.zeros(n, np.uint64)
    for i in range(PREFIX):
        runs = runs * _MIX + hashes[i : i + n]
    runs ^= runs >> np.uint64(29)
    runs *= np.uint64(0xBF58476D1CE4E5B9)
    runs ^= runs >> np.uint64(32)
    starts = np.arange(len(hashes) - WINDOW + 1)
    offset = np.lib.stride_tricks.sliding_window_view(runs, OFFSETS).argmin(axis=1)
    place = offset + starts
    first = np.nonzero(np.concatenate(([True], place[1:] != place[:-1])))[0]
    size = np.diff(np.concatenate((first, [len(starts)])))
    # The span's hash: a polynomial over its words, from sums over all words before it.
    powers = _powers(_BASE, len(hashes) + 1)
    inverse = _powers(_INVERSE, len(starts) + 1)
    before = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * powers[:-1])))
    span = (before[first + size + WINDOW - 1] - before[first]) * inverse[first]
    span = (span ^ (size * 16 + offset[first]).astype(np.uint64)) * _MIX
    return runs[place[first]], span, first, size, offset[first]


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(prefix, span, doc, tie, code, again) of each anchor.  again: its span starts earlier in the same slice of rows."""
    known: dict[bytes, int] = {}
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE):
            batch = whole.slice(at, SLICE)
            ids, ties, parts = *(batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1)), []
            for i, text in enumerate(as_bytes(batch.column(2))):
                words = text.split()
                if len(words) >= WINDOW:
                    prefix, span, start, size, offset = anchors(word_hashes(words, known))
                    parts.append((prefix, span, np.full(len(start), ids[i]), np.full(len(start), ties[i]), (start << 8) | (size << 4) | offset))
            if not parts:
                continue
            prefix, span, doc, tie, code = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((code, tie, doc, span, prefix))
            prefix, span, doc, tie, code = prefix[order], span[order], doc[order], tie[order], code[order]
            head = np.concatenate(([True], (prefix[1:] != prefix[:-1]) | (span[1:] != span[:-1])))
            lead = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
            again = (doc != doc[lead]) | (tie != tie[lead]) | (code != code[lead])
            prefix = np.where(again, (doc.view(np.uint64) * _MIX) ^ code.astype(np.uint64), prefix)  # dealt out evenly
            yield pa.RecordBatch.from_arrays(
                [pa.array(prefix.view(np.int64)), pa.array(span.view(np.int64)), pa.array(doc), pa.array(tie), pa.array(code), pa.array(again)],
                ["prefix", "span", "doc", "tie", "code", "again"],
            )


def _lists(texts: DataFrame, group: int) -> DataFrame:
    """(doc, tie, repeats, spans): codes of anchors whose windows all repeat; (prefix, code, large) of spans to compare."""
    rows = texts.mapInArrow(_suffixes, "prefix long, span long, doc long, tie long, code long, again boolean")
    by_span = Window.partitionBy("prefix", "again").orderBy("span", "doc", "tie", "code")
    place = F.struct("span", "doc", "tie", "code")
    marked = rows.withColumn("_new", F.when(~F.lag("span").over(by_span).eqNullSafe(F.col("span")), place))
    marked = marked.withColumn("_lead", F.last("_new", ignorenulls=True).over(by_span.rowsBetween(Window.unboundedPreceding, 0)))
    same = place == F.col("_lead")
    leads = Window.partitionBy("prefix", "again")
    marked = marked.withColumn("_spans", F.sum(F.col("_new").isNotNull().cast("int")).over(leads))
    repeats = F.col("again") | ~same
    kept = marked.where(repeats | (F.col("_spans") > 1))
    return kept.groupBy("doc", "tie").agg(
        F.collect_set(F.when(repeats, F.col("code"))).alias("repeats"),
        F.collect_set(F.when(~repeats, F.struct("prefix", "code", (F.col("_spans") > group).alias("large")))).alias("spans"),
    )


def _contexts(batches: Iterator[pa.RecordBatch], parts: int, large: bool) -> Iterator[pa.RecordBatch]:
    """The words of the spans to compare; for large groups the digest of each window."""
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE):
            batch = whole.slice(at, SLICE)
            out = []
            for doc, tie, packed, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = zlib.decompress(packed).split()
                for s in spans:
                    if s["large"] != large:
                        continue
                    code = s["code"]
                    start, size = code >> 8, (code >> 4) & 15
                    if large:
                        for i in range(start, start + size):
                            digest = hashlib.blake2b(b" ".join(words[i : i + WINDOW]), digest_size=16).digest()
                            out.append((0, 0, doc, tie, i << 8, digest))
                    else:
                        out.append((s["prefix"] % parts, s["prefix"], doc, tie, code, b" ".join(words[start : start + size + WINDOW - 1])))
            if out:
                part, prefix, docs, ties, codes, text = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), pa.array(prefix, pa.int64()), pa.array(docs, pa.int64()), pa.array(ties, pa.int64()), pa.array(codes, pa.int64()), pa.array(text, pa.binary())],
                    ["part", "prefix", "doc", "tie", "code", "words"],
                )


def subtrees(prefix: np.ndarray, doc: np.ndarray, code: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(doc, window start) of the windows that also start earlier, among spans given with all their words."""
    ids: dict[bytes, int] = {}
    start, size, offset = code >> 8, (code >> 4) & 15, code & 15
    left, right = OFFSETS - 1, WINDOW
    grid = np.full((len(texts), left + right), -1, np.int64)  # the anchor's words begin at column ``left``
    for i, text in enumerate(texts):
        row = [ids.setdefault(w, len(ids)) for w in text.split()]
        at = left - int(offset[i])
        row = row[: left + right - at]
        grid[i, at : at + len(row)] = row
    order = np.lexsort((*grid[:, left:].T[::-1], prefix))
    grid, prefix, doc, start, size, offset = grid[order], prefix[order], doc[order], start[order], size[order], offset[order]
    equal = grid[1:, left:] == grid[:-1, left:]
    common = np.where(prefix[1:] == prefix[:-1], np.cumprod(equal, axis=1).sum(axis=1), -1)
    docs, starts = [], []
    for l in range(OFFSETS):  # windows that start l words before the anchor
        has = np.nonzero((offset >= l) & (offset - l < size))[0]
        if len(has) < 2:
            continue
        node = np.concatenate(([0], np.cumsum(common < WINDOW - l)))[has]
        at = start[has] + offset[has] - l
        keys = [grid[has, left - 1 - i] for i in range(l)] + [node]
        by = np.lexsort((at, doc[has], *keys))
        differs = np.zeros(len(by) - 1, bool)
        for k in keys:
            differs |= k[by][1:] != k[by][:-1]
        head = np.concatenate(([True], differs))
        lead = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
        d, a = doc[has][by], at[by]
        again = (d != d[lead]) | (a != a[lead])
        docs.append(d[again])
        starts.append(a[again])
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(docs), np.concatenate(starts)


def _repeated(texts: DataFrame, lists: DataFrame, group: int) -> DataFrame:
    """(doc, starts): windows that repeat, found by comparing the spans."""
    n, large = lists.agg(F.sum(F.size("spans")), F.max(F.exists("spans", lambda s: s["large"]))).first()
    parts = max(1, (n or 0) // PART)
    spans = texts.join(lists.where(F.size("spans") > 0).select("doc", "tie", "spans"), ["doc", "tie"]).select("doc", "tie", "packed", "spans")
    schema = "part int, prefix long, doc long, tie long, code long, words binary"

    def build(table: pa.Table) -> pa.Table:
        ids, ties = (table.column(c).to_numpy() for c in ("doc", "tie"))
        order = np.lexsort((ties, ids))
        new = np.concatenate(([False], (np.diff(ids[order]) != 0) | (np.diff(ties[order]) != 0)))
        document = np.empty(len(ids), np.int64)
        document[order] = np.cumsum(new[: len(ids)])  # its place among the documents of the part
        first = order[np.concatenate(([True], new[1:]))[: len(ids)]]
        found, at = subtrees(table.column("prefix").to_numpy(), document, table.column("code").to_numpy(), table.column("words").to_pylist())
        return pa.table({"doc": pa.array(ids[first[found]], pa.int64()), "tie": pa.array(ties[first[found]], pa.int64()), "at": pa.array(at, pa.int64())})

    found = spans.mapInArrow(partial(_contexts, parts=parts, large=False), schema).groupBy("part").applyInArrow(build, "doc long, tie long, at long")
    if large:
        nodes = spans.mapInArrow(partial(_contexts, parts=parts, large=True), schema)
        place = F.struct("doc", "tie", "code")
        by_node = Window.partitionBy("words").orderBy("doc", "tie", "code").rowsBetween(Window.unboundedPreceding, 0)
        again = nodes.withColumn("lead", F.first(place).over(by_node)).where(place != F.col("lead"))
        found = found.unionByName(again.select("doc", "tie", F.shiftright("code", 8).alias("at")))
    return found.groupBy("doc", "tie").agg(F.collect_set("at").alias("starts"))


def _pack(batch: pa.RecordBatch) -> pa.RecordBatch:
    packed = [zlib.compress(t, 1) for t in as_bytes(batch.column(2))]
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["doc", "tie", "packed"])


def _remove(batch: pa.RecordBatch) -> pa.RecordBatch:
    out = []
    for doc, packed, repeats, starts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        words = zlib.decompress(packed).split()
        change = np.zeros(len(words) + WINDOW + OFFSETS + 1, np.int32)
        if repeats:
            codes = np.array(repeats, np.int64)
            np.add.at(change, codes >> 8, 1)
            np.add.at(change, (codes >> 8) + ((codes >> 4) & 15) + WINDOW - 1, -1)
        if starts:
            at = np.array(starts, np.int64)
            np.add.at(change, at, 1)
            np.add.at(change, at + WINDOW, -1)
        gone = np.cumsum(change)[: len(words)] > 0
        kept = b" ".join(itertools.compress(words, (~gone).tolist()))
        out.append((doc, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept))
    doc, n, removed, digest, kept = zip(*out, strict=True)
    columns = [pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest), pa.array(kept, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["doc", "n_words", "n_removed", "kept_sha256", "kept"])


def drop_repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) of each row: its text without words that a repeat covers.

    A word goes if a window of 20 words covers it whose words also start earlier: in a smaller doc_id, or
    before in the same one.  Null texts have no words; texts of fewer than 20 words lose none.  A null doc_id
    comes before all others.  Rows that repeat a doc_id and text are the same document and get the same result;
    rows that share a doc_id with other texts are documents of their own, in the order of a hash of their texts.
    Other columns are not read; an empty table gives no rows.
    """
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc")
    texts = with_ties(docs.select(id_, F.col("text").cast("string"))).select("doc", "tie", "text")
    lists = checkpointed(_lists(texts, group))
    packed = map_arrow(texts, _pack, "doc long, tie long, packed binary")
    repeated = checkpointed(_repeated(packed, lists, group))
    both = packed.join(lists.select("doc", "tie", "repeats"), ["doc", "tie"], "left").join(repeated, ["doc", "tie"], "left")
    out = map_arrow(both.select("doc", "packed", "repeats", "starts"), _remove, "doc long, n_words long, n_removed long, kept_sha256 string, kept string")
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_words", "n_removed", "kept_sha256", "kept")
