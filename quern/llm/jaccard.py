"""Near duplicates by the Jaccard similarity of word shingles: a vantage-point tree and MinHash bands find candidates,
exact sets decide.

Two texts are linked when their sets of WIDTH-word shingles have at least LEAST of their union in common.  Texts of one
set are folded first.  The search has two steps, since few pairs at that similarity are within the tree's radius:

The vantage-point tree of ``simhash`` finds the fingerprints within RADIUS bits of each other.  Each text is compared with
the least one that the tree connects it to.

Texts that share a band, ROWS MinHashes of BANDS * ROWS, are the other candidates; a pair at similarity 0.8 shares none
with probability (1 - 0.8 ** ROWS) ** BANDS, 2.6e-5.  Bands that the tree's links connect whole are done.  In the others
each text is compared with one of its bands' least texts, that of most of them, and after that only those that the links
found so far don't connect.  Where that leaves a band at most HOT pairs a text, they are joined.  Texts of other bands
(hundreds of copies of a text with edits that differ, say) come together in blocks instead: each task compares two blocks,
whole sets with whole sets, and gives the links only; pairs of a group that comes in blocks aren't joined for its smaller
bands.  So no link that connectivity needs is left out.  The comparisons of such a group still grow with the square of its
texts that the first steps don't connect.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import simhash
from quern.llm.common import BROADCAST_IDS, as_bytes, checkpointed, connected_components, map_arrow
from quern.llm.simhash import _forest

#: Words of a shingle; least similarity, as a fraction; bands and MinHashes of a band.
WIDTH, LEAST = 5, (4, 5)
BANDS, ROWS = 20, 4
#: Bits in which fingerprints differ at most that the tree brings together.
RADIUS = 4
#: Pairs a text that a band may leave to a join; texts and shingles of a block.
HOT, BLOCK, BLOCK_GRAMS = 16, 2048, 1 << 20
#: Shingles that are hashed for all bands at once; shingles whose texts are compared at once.
CHUNK, COLUMNS = 8192, 2048
SEED = 42
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
SHIFTS = np.random.default_rng(SEED + 1).integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64)
NO_ID = -(1 << 63)


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of the distinct ``width``-word shingles, A-Z lower-cased; fewer words are one shingle, none is none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
    if len(words) <= width:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - width + 1
    spans = zip(starts[:n].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.unique(np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, n))


def bands(grams: np.ndarray) -> list[int]:
    """The keys of a set's bands, as signed longs; an empty set has none."""
    if not len(grams):
        return []
    low = np.full(BANDS * ROWS, ~np.uint64(0))
    for at in range(0, len(grams), CHUNK):
        low = np.minimum(low, (grams[at : at + CHUNK, None] * FACTORS + SHIFTS).min(axis=0))
    keys = [xxhash.xxh64_intdigest(band.tobytes(), k) for k, band in enumerate(low.reshape(BANDS, ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def _signed(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = as_bytes(batch.column(2))
    found = [shingles(t) for t in texts]
    prints = np.fromiter((simhash.fingerprint(t) for t in texts), np.uint64, len(texts)).view(np.int64)
    nodes = np.fromiter((xxhash.xxh64_intdigest(g.tobytes(), SEED) for g in found), np.uint64, len(found)).view(np.int64)
    columns = [pa.array(nodes), pa.array([len(g) for g in found], pa.int64()), pa.array([bands(g) for g in found], pa.list_(pa.int64())), pa.array(prints)]
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "hash", "node", "n", "bands", "fp"])


def _sets(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [shingles(t).view(np.int64) for t in as_bytes(batch.column(1))]
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "grams"])


def _alike(part: str, n: str, m: str) -> str:
    """part: shingles in common, of sets of n and m."""
    return f"{LEAST[1]} * {part} >= {LEAST[0]} * ({n} + {m} - {part})"


def _small(df: DataFrame) -> DataFrame:
    """``df``, of a few numbers a row, marked for a broadcast where it is small, so that the sets it is joined to stay where they are."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets are alike."""
    left, right = sets.toDF("a", "a_grams"), sets.toDF("b", "b_grams")
    both = _small(pairs).join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("a_grams", "b_grams")))
    return checkpointed(both.where(_alike("common", "size(a_grams)", "size(b_grams)")).select("a", "b"))


def _from_tree(nodes: DataFrame) -> DataFrame:
    """(a, b): each text b with the least text a that the vantage-point tree connects its fingerprint to, if their sizes allow them to be alike."""
    prints = nodes.where("n > 0").select("node", "n", "fp")  # a text without words is like no other
    near = checkpointed(connected_components(simhash.links(checkpointed(prints.select("fp").distinct()), RADIUS)))
    near = _small(near.select(F.col("node").alias("_fp"), "root"))
    placed = prints.join(near, F.col("fp") == F.col("_fp"), "left").select("node", "n", F.coalesce("root", "fp").alias("root"))
    leads = placed.groupBy("root").agg(F.min(F.struct("node", "n")).alias("lead"), F.count("*").alias("size")).where("size > 1").select("root", "lead")
    pairs = placed.join(_small(checkpointed(leads)), "root").where(f"node <> lead.node and {_alike('least(n, lead.n)', 'n', 'lead.n')}")
    return checkpointed(pairs.select(F.col("lead.node").alias("a"), F.col("node").alias("b")))


def _pairs(rooted: DataFrame) -> DataFrame:
    """(a, b): pairs of texts that share a band, aren't connected nor of one group, and whose sizes allow them to be alike."""
    x, y = rooted.alias("x"), rooted.alias("y")
    apart = f"x.node < y.node and x.root <> y.root and coalesce(x.group <> y.group, true) and {_alike('least(x.n, y.n)', 'x.n', 'y.n')}"
    both = x.join(y, F.expr(f"x.key = y.key and {apart}"))
    return both.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _compare(table: pa.Table) -> pa.Table:
    """(a, b): links among two blocks of texts (one, where both are the same) that connect what is alike there."""
    root, first, own = table.column("root").to_numpy(), table.column("first").to_numpy(), table.column("lo").to_numpy() == table.column("hi").to_numpy()
    node, lists = table.column("node").to_numpy(), table.column("grams").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    grams, counts = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)[1:]
    column = np.cumsum(counts > 1) - 1  # a shingle of one text is in no two
    row, used = np.repeat(np.arange(len(node)), sizes), counts[grams] > 1
    row, at = row[used], column[grams[used]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    left, right = np.nonzero(first | own)[0], np.nonzero(~first | own)[0]
    common = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
        a, b = np.searchsorted(at, [low, low + COLUMNS])
        part = np.zeros((len(node), COLUMNS), np.float32)
        part[row[a:b], at[a:b] - low] = 1
        common += part[left] @ part[right].T
    near = LEAST[1] * common >= LEAST[0] * (sizes[left][:, None] + sizes[right][None, :] - common)
    near &= root[left][:, None] != root[right][None, :]
    a, b = _forest(node[left], node[right], near)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _groups(hot: DataFrame) -> DataFrame:
    """(node, group, n, root) of the texts of hot bands.  Texts that bands bring together, also by way of others, are a group."""
    least = hot.groupBy("key").agg(F.min("node").alias("least"))
    groups = connected_components(hot.join(least, "key").select("node", "least").distinct(), "node", "least").withColumnRenamed("root", "group")
    return checkpointed(groups.join(hot.select("node", "n", "root").distinct(), "node"))


def _in_blocks(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links among the texts of each group that connect what is alike there."""
    blocks = members.groupBy("group").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    placed = members.join(blocks, "group").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).drop("n")
    sent = _small(checkpointed(placed)).join(sets, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = sent.select("group", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") <= F.col("other")).alias("first"), "node", "root", "grams")
    return checkpointed(sent.groupBy("group", "lo", "hi").applyInArrow(_compare, "a long, b long"))


def _components(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, component_id, keep) of each row; hash: of its text; keep: it, or a row like it, stands for its component."""
    given = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("hash"), F.col("text").cast("string"))
    signed = checkpointed(map_arrow(given, _signed, "doc_id long, hash long, node long, n long, bands array<long>, fp long"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "hash")
    nodes = checkpointed(signed.groupBy("node").agg(F.min("doc_id").alias("low"), F.min(place).alias("first"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands"), F.min("fp").alias("fp")))
    near = _from_tree(nodes)

    entries = nodes.select("node", "n", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").drop("size")
    entries = checkpointed(entries.join(shared, "key"))

    wanted = entries.select("node").unionByName(near.select(F.col("a").alias("node"))).unionByName(near.select(F.col("b").alias("node"))).distinct().join(nodes.select("node", "first"), "node").select("node", F.col("first.id").alias("id"), F.col("first.hash").alias("hash"))
    # Texts move once, for repeated rows and the join alike.
    texts = given.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "hash", "text").dropDuplicates(["id", "hash"])
    sets = checkpointed(map_arrow(wanted.join(texts, ["id", "hash"]).select("node", "text"), _sets, "node long, grams array<long>"))

    links = _linked(near, sets)
    stars = links.select(F.col("b").alias("node"), F.col("a").alias("root"))  # a text has one link at most here, to a least one
    entries = entries.join(stars, "node", "left").withColumn("root", F.coalesce("root", "node"))
    leads = entries.groupBy("key").agg(F.min(F.struct("node", "n", "root")).alias("lead"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    entries = checkpointed(entries.join(leads.select("key", "lead"), "key"))
    pairs = entries.where(f"root <> lead.root and {_alike('least(n, lead.n)', 'n', 'lead.n')}").groupBy("node", F.col("lead.node").alias("a")).count()
    pairs = pairs.groupBy("node").agg(F.max(F.struct("count", "a"))["a"].alias("a")).select("a", F.col("node").alias("b"))
    links = links.unionByName(_linked(checkpointed(pairs), sets))
    roots = checkpointed(connected_components(links))
    rooted = entries.drop("root").join(roots, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root"))
    counts = rooted.groupBy("key", "root").agg(F.count("*").cast("double").alias("n")).groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"))
    mixed = counts.withColumn("pairs", (F.col("n") * F.col("n") - F.col("same")) / 2).where("pairs > 0").select("key", (F.col("pairs") > HOT * F.col("n")).alias("hot"))
    rooted = checkpointed(rooted.join(mixed, "key"))
    members = _groups(rooted.where("hot"))
    links = links.unionByName(_in_blocks(members, sets))
    cold = rooted.where("not hot").join(members.select("node", "group"), "node", "left")
    links = links.unionByName(_linked(checkpointed(_pairs(cold)), sets))
    roots = connected_components(links)
    roots = checkpointed(roots)
    linked = nodes.join(roots, "node").select(F.col("node").alias("_node"), "low", "first", "root")
    lows = linked.groupBy("root").agg(F.min("low").alias("component_id"), F.min("first").alias("stands"))
    if roots.count() <= BROADCAST_IDS:  # no more components than that; a large one's rows then stay where they are
        lows = F.broadcast(lows)
    linked = linked.join(lows, "root").select("_node", "component_id", "stands")
    alone = F.col("_node").isNull()
    groups = nodes.join(linked, F.col("node") == F.col("_node"), "left").select(
        "node", F.when(alone, F.col("low")).otherwise(F.col("component_id")).alias("component_id"), F.when(alone, F.col("first")).otherwise(F.col("stands")).alias("stands")
    )
    return signed.join(groups, "node").select("doc_id", "hash", "component_id", (place == F.col("stands")).alias("keep"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, component_id) for each row: the smallest doc_id that links lead to, its own included.

    Null and texts without words are copies of each other.  A null doc_id keeps its row and never becomes a
    component id unless the component has no other.  Repeated rows stay; an empty table gives none.
    """
    return _components(docs).select("doc_id", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their component, one each: that of the smallest doc_id (null after all others), of
    several texts of it the one whose hash is lowest.  Rows of one doc_id with texts that aren't alike all stay.
    """
    keep = _components(docs).where("keep").select(F.col("doc_id").alias("_kept_id"), F.col("hash").alias("_kept_hash")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(keep["_kept_id"]) & (F.xxhash64(docs["text"].cast("string")) == keep["_kept_hash"])
    return docs.join(keep, same, "left_semi").dropDuplicates(["doc_id", "text"])
