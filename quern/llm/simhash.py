"""SimHash near-duplicates found through a vantage-point tree over the fingerprints.

A fingerprint has 64 bits; two are linked when they differ in at most ``radius`` of them.  A node of the tree
has a vantage point of its own, one of its fingerprints, and splits the others by their Hamming distance to it:
up to the median distance they go inside, the rest outside.  By the triangle inequality a branch can hold a
fingerprint's links only if its distance to the vantage point is within ``radius`` of the branch's distances.

The upper levels of the tree, built from a sample that is as small as the number of shards, deal the distinct
fingerprints to shards (its leaves).  A fingerprint is also sent, as a query, to each later shard that its radius
overlaps.  Within a task the tree goes on: both sides of a node, and only the boundaries of its two sides with one
another.  What is left is compared exactly, so no link is missed.

Copies share a fingerprint and are folded before the search.  A task returns a forest over its links,
not its pairs; components then come from star contraction in Spark.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import BROADCAST_IDS, as_bytes, checkpointed, connected_components, map_arrow

SEED = 42
#: Distinct fingerprints of a shard, about; least number of shards; fingerprints of a sample for each shard.
SHARD, SHARDS, SAMPLE = 100_000, 16, 32
#: Pairs that are compared at once without further pruning.
DIRECT = 1 << 20


def fingerprint(text: bytes, width: int = 4) -> int:
    """64-bit SimHash of the ``width``-word shingles of ``text``, A-Z lower-cased; no word: 0."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    n = len(words) - width + 1
    hashes = np.fromiter(
        (digest(joined[s:e], SEED) for s, e in zip(starts[:n].tolist(), ends[width - 1 :].tolist(), strict=True)), np.uint64, n
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        bits = np.unpackbits(hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(batch: pa.RecordBatch, width: int) -> pa.RecordBatch:
    fps = np.fromiter((fingerprint(t, width) for t in as_bytes(batch.column(1))), np.uint64, batch.num_rows)
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row, as a signed long.  A null text counts as empty."""
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), partial(_fingerprints, width=width), "doc_id long, fp long")


@dataclass
class Node:
    """A node of the tree's upper levels: inside are the fingerprints up to ``reach`` from the vantage point.  A leaf has a number only."""

    vantage: np.uint64 = np.uint64(0)
    reach: int = 0
    inside: Node | None = None
    outside: Node | None = None
    shard: int = -1


def distances(fps: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(fps ^ vantage)


def plant(sample: np.ndarray, shards: int) -> Node:
    """The upper levels of the tree, down to about ``shards`` leaves."""
    leaves = itertools.count()

    def grow(own: np.ndarray, want: int) -> Node:
        if want > 1 and len(own) > 1:
            vantage = own[len(own) // 2]  # of a sample in random order
            d = distances(own, vantage)
            reach = int(np.median(d))
            inside = d <= reach
            if not inside.all():
                part = max(1, min(want - 1, round(want * float(inside.mean()))))
                return Node(vantage, reach, grow(own[inside], part), grow(own[~inside], want - part))
        return Node(shard=next(leaves))

    return grow(sample, shards)


def shards_of(tree: Node, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(place in fps, shard) of each fingerprint in each shard that ``radius`` overlaps; radius 0: its own shard alone."""
    places, shards = [], []
    todo = [(tree, np.arange(len(fps)))]
    while todo:
        node, own = todo.pop()
        if not len(own):
            continue
        if node.inside is None:
            places.append(own)
            shards.append(np.full(len(own), node.shard, np.int32))
            continue
        d = distances(fps[own], node.vantage).astype(np.int16)
        todo.append((node.inside, own[d - radius <= node.reach]))
        todo.append((node.outside, own[d + radius > node.reach]))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(places), np.concatenate(shards)


def _send(batches: Iterator[pa.RecordBatch], tree: Broadcast, radius: int) -> Iterator[pa.RecordBatch]:
    """Each fingerprint to its own shard (home) and, as a query, to the later ones that it overlaps."""
    for batch in batches:
        whole = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(whole), 4096):
            fps = whole[at : at + 4096]
            home = np.zeros(len(fps), np.int32)
            place, shard = shards_of(tree.value, fps.view(np.uint64), 0)
            home[place] = shard
            place, shard = shards_of(tree.value, fps.view(np.uint64), radius)
            later = shard >= home[place]
            place, shard = place[later], shard[later]
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(fps[place]), pa.array(shard == home[place])], ["shard", "fp", "home"])


def _forest(left: np.ndarray, right: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the matrix ``near`` connects, a few per row and column at most."""
    if np.count_nonzero(near) <= 4 * sum(near.shape):
        i, j = np.nonzero(near)
        return left[i], right[j]
    rows, cols = near.any(axis=1), near.any(axis=0)
    left, right, near = left[rows], right[cols], near[rows][:, cols]
    mark = np.arange(len(left), dtype=np.int32)  # the lowest row that reaches each row
    while True:
        low = np.where(near, mark[:, None], np.int32(len(left))).min(axis=0)
        new = np.minimum(mark, np.where(near, low[None, :], np.int32(len(left))).min(axis=1))
        if (new == mark).all():
            break
        mark = new[new]
    return np.concatenate((left, right)), np.concatenate((left[mark], left[low]))


def near_pairs(homes: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (not all of them, but all that connectivity needs) among homes and from queries to homes."""
    out_a, out_b = [], []

    def direct(h: np.ndarray, q: np.ndarray | None) -> None:
        other = h if q is None else q
        step = max(1, DIRECT // max(1, len(h)))
        for at in range(0, len(other), step):
            some = other[at : at + step]
            near = np.bitwise_count(some[:, None] ^ h[None, :]) <= radius
            if q is None:
                near &= np.arange(at, at + len(some))[:, None] < np.arange(len(h))[None, :]
            if near.any():
                a, b = _forest(some, h, near)
                out_a.append(a)
                out_b.append(b)

    # Pairs of sets still to compare; q None: h within itself.
    todo: list[tuple[np.ndarray, np.ndarray | None]] = [(homes, None), (homes, queries)]
    while todo:
        h, q = todo.pop()
        if len(h) < 1 + (q is None) or (q is not None and not len(q)):
            continue
        if len(h) * len(h if q is None else q) <= DIRECT // 4:
            direct(h, q)
            continue
        vantage = h[len(h) // 2]
        d = distances(h, vantage).astype(np.int16)
        reach = int(np.median(d))
        inside = d <= reach
        if inside.all():
            reach -= 1
            inside = d <= reach
        if not inside.any():  # all at one distance: no vantage point splits them
            direct(h, q)
            continue
        if q is None:
            todo += [(h[inside], None), (h[~inside], None), (h[inside & (d > reach - radius)], h[~inside & (d <= reach + radius)])]
        else:
            of_q = distances(q, vantage).astype(np.int16)
            todo += [(h[inside], q[of_q - radius <= reach]), (h[~inside], q[of_q + radius > reach])]
    if not out_a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(out_a), np.concatenate(out_b)


def links(distinct: DataFrame, radius: int = 4) -> DataFrame:
    """(a, b): links among the distinct fingerprints of column fp, enough to connect all that are linked."""
    spark, n = distinct.sparkSession, distinct.count()
    if n < 2:
        return spark.createDataFrame([], "a long, b long")
    shards = max(SHARDS, n // SHARD)
    # A sample by hash, the same on every run; a lone fingerprint where the hash leaves out all.
    chosen = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(max(1, n // (shards * SAMPLE)))) == 0).select("fp")
    sample = np.sort(np.array([r["fp"] for r in chosen.collect()], np.int64).view(np.uint64))  # about SAMPLE a shard
    tree = spark.sparkContext.broadcast(plant(np.random.default_rng(SEED).permutation(sample), shards))
    sent = distinct.select("fp").mapInArrow(partial(_send, tree=tree, radius=radius), "shard int, fp long, home boolean")

    def search(table: pa.Table) -> pa.Table:
        home = table.column("home").to_numpy()
        fps = table.column("fp").to_numpy().view(np.uint64)
        a, b = near_pairs(fps[home], fps[~home], radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return sent.groupBy("shard").applyInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = 4, width: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) for each row: the smallest doc_id that links lead to, its own included.

    Null and empty texts have fingerprint 0 and link like any other.  A null doc_id keeps its row and never
    becomes a component id unless the component has no other.  Repeated rows stay; an empty table gives none.
    Other columns of ``docs`` are not read.
    """
    fps = checkpointed(fingerprints(docs, width))
    nodes = checkpointed(fps.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = checkpointed(connected_components(links(nodes, radius)))
    linked = nodes.join(roots, nodes["fp"] == roots["node"]).select("fp", "low", "root")
    lows = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    if roots.count() <= BROADCAST_IDS:  # no more components than that; a large one's rows then stay where they are
        lows = F.broadcast(lows)
    linked = linked.join(lows, "root").select(F.col("fp").alias("_fp"), "component_id")
    groups = nodes.join(linked, F.col("fp") == F.col("_fp"), "left").select("fp", F.when(F.col("_fp").isNull(), F.col("low")).otherwise(F.col("component_id")).alias("component_id"))
    return fps.join(groups, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, radius: int = 4, width: int = 4) -> DataFrame:
    """The rows of ``docs`` that stand for their group: those whose doc_id is its component id, once each.

    Rows with a null doc_id stay only where their whole group has no doc_id.  Rows that repeat a doc_id and text are
    one; of a doc_id with several texts those stay whose group has that id.
    """
    found = near_duplicates(docs, radius, width).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = found.select(F.col("doc_id").alias("_kept_id")).distinct()
    same = docs["doc_id"].eqNullSafe(keep["_kept_id"])
    return docs.join(keep, same, "left_semi").dropDuplicates(["doc_id", "text"])
