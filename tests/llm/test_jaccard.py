"""Near duplicates by Jaccard similarity against brute force over all pairs."""

import random

import corpus_pipeline
import pyarrow as pa
from test_llm_operators import ODD, SCHEMA

from quern.llm import common, jaccard, simhash


def slow_set(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_components(rows):
    """For each row the smallest doc_id of its group."""
    sets, group = [slow_set(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if group[i] != group[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return [min((r[0] for r, h in zip(rows, group, strict=True) if h == g and r[0] is not None), default=None) for g in group]


def edited(rng, words, share):
    return [rng.choice("uvwxyz") * 5 if rng.random() < share else w for w in words]


def test_edited_copies(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice((30, 120, 600)))]
        for share in (0, 0.004, 0.008, 0.012, 0.02, 0.04):
            rows.append((len(rows), " ".join(edited(rng, words, share))))
    sets = [slow_set(t) for _, t in rows]
    near = sum(0.8 <= len(sets[i] & sets[j]) / len(sets[i] | sets[j]) < 1 for i in range(len(rows)) for j in range(i))
    assert near > 80
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA).repartition(4)
    assert sorted((r["doc_id"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()) == list(zip(range(len(rows)), slow_components(rows), strict=True))
    stay = sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert stay == sorted(set(slow_components(rows)))


def test_odd(spark):
    odd = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    rows = [(r[0], r[1]) for r in ODD]
    want = sorted(map(str, zip([r[0] for r in rows], slow_components(rows), strict=True)))
    assert sorted(str((r["doc_id"], r["component_id"])) for r in jaccard.near_duplicates(odd).collect()) == want
    assert sorted(r["doc_id"] for r in jaccard.drop_near_duplicates(odd).collect()) == [1, 3, 5, 6, 7]
    assert jaccard.near_duplicates(odd.limit(0)).count() == 0


def test_hot_group(spark, monkeypatch):
    """Hundreds of near copies, few of them alike: the result is that of all pairs, most of which no join makes."""
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = [(i, " ".join(edited(rng, base, rng.choice((0.005, 0.01, 0.02))))) for i in range(400)] + [(400 + i, " ".join(f"v{rng.randrange(5000)}" for _ in range(60))) for i in range(200)]
    compared = []
    linked = jaccard._linked
    monkeypatch.setattr(jaccard, "_linked", lambda pairs, sets: compared.append(pairs.count()) or linked(pairs, sets))
    monkeypatch.setattr(jaccard, "BLOCK", 100)
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA).repartition(4)
    assert sorted((r["doc_id"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()) == list(zip(range(len(rows)), slow_components(rows), strict=True))
    assert sum(compared) < 20 * len(rows), compared  # of 79,800 pairs


def test_tree_finds_copies(spark, monkeypatch):
    """The vantage-point tree brings near copies together by itself, and whole sets decide about what it brings."""
    rng = random.Random(7)
    base = [[f"w{rng.randrange(5000)}" for _ in range(400)] for _ in range(20)]
    rows = [(2 * i, " ".join(words)) for i, words in enumerate(base)] + [(2 * i + 1, " ".join([*words[:399], "end"])) for i, words in enumerate(base)]
    rows += [(100, " ".join(f"v{i}" for i in range(20)) + " x y z" * 400), (101, " ".join(f"u{i}" for i in range(20)) + " x y z" * 400)]  # like by fingerprint alone
    assert (simhash.fingerprint(rows[-1][1].encode()) ^ simhash.fingerprint(rows[-2][1].encode())).bit_count() <= jaccard.RADIUS
    signed = jaccard._signed
    monkeypatch.setattr(jaccard, "_signed", lambda batch: signed(batch).set_column(4, "bands", pa.array([[]] * batch.num_rows, pa.list_(pa.int64()))))
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA).repartition(4)
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [*range(0, 40, 2), 100, 101]


def test_hot_group_moves_little(spark, monkeypatch):
    """Each text of a large group is compared with two others at most before blocks; what blocks compare isn't joined again."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = [(i, " ".join(edited(rng, base, rng.choice((0.005, 0.01, 0.02))))) for i in range(600)]
    compared = []
    linked = jaccard._linked
    monkeypatch.setattr(jaccard, "_linked", lambda pairs, sets: compared.append(pairs.count()) or linked(pairs, sets))
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA).repartition(4)
    assert sorted((r["doc_id"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()) == list(zip(range(len(rows)), slow_components(rows), strict=True))
    assert sum(compared) < 4 * len(rows), compared


def test_components_in_few_partitions(spark, monkeypatch):
    """A few links don't keep as many partitions as a shuffle has: a round's files would take more than their rows."""
    parts = []
    kept = common.checkpointed
    monkeypatch.setattr(common, "checkpointed", lambda df: (out := kept(df), parts.append(out.rdd.getNumPartitions()))[0])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (5, 5)], "a long, b long")
        found = sorted((r["node"], r["root"]) for r in common.connected_components(edges).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == [(i, 0) for i in range(41)] + [(100, 100), (101, 100), (102, 100)]
    assert max(parts[1:]) <= common.PARTS, parts  # after the first, which is as the links come
