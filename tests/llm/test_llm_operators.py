"""Each operator against a brute-force version over whole tables, and over odd inputs."""

import collections
import hashlib
import os
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from quern.llm import chat, coder, decontaminate, langid, licenses, lines, pieces, quality, queries, simhash, substrings, tokens

SF_DIR = os.environ.get("QUERN_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (None, "one two three " * 30, "en", None, 5),
    (3, "one two three " * 30, None, "a", 5),
    (3, "one two three " * 30, None, "a", 5),
    (4, "\n \t\n", "de", "b", 3),
    (5, "x" * 70_000, "de", "b", 1),
    (6, " ".join(f"w{i}" for i in range(9000)), "en", "a", 1),
    (7, "Ünï ▁ ​ </s> \\[INST] 🤦🏼 mit license\x00", "fr", "b", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def clash(df):
    """Extra columns with names that the operators use inside."""
    for name in ("fp", "words", "row", "tokens", "_doc_0", "line", "text_", "label", "n_words", "kept", "score"):
        df = df.withColumn(name, F.lit(7))
    return df


def texts(df):
    return sorted(((r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r))


# 1
def slow_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, radius=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_simhash(docs):
    found = {r["doc_id"]: r for r in queries.op1_simhash_near_dedup(docs.sparkSession, SF_DIR).collect()}
    rows = texts(docs)
    fps = [slow_fingerprint(t) for _, t in rows]
    lowest = {}
    roots = components(fps)
    for (i, _), root in zip(rows, roots, strict=True):
        lowest[root] = min(i, lowest.get(root, i))
    for (i, _), fp, root in zip(rows, fps, roots, strict=True):
        assert found[i]["fingerprint"] == f"{fp:016x}"
        assert found[i]["component_id"] == lowest[root]


def test_near_pairs_find_all_components():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    flips = [base]
    for _ in range(6):
        flips.append(base ^ (np.uint64(1) << rng.integers(0, 64, 150, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 150, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 150, dtype=np.uint64)))
    fps = np.unique(np.concatenate(flips))
    want = components([int(f) for f in fps])
    old, simhash.DIRECT = simhash.DIRECT, 64
    try:
        a, b = simhash.near_pairs(fps, fps[:0], 4)
    finally:
        simhash.DIRECT = old
    index = {int(f): i for i, f in enumerate(fps)}
    links = [[] for _ in fps]
    for x, y in zip(a, b, strict=True):
        links[index[int(x)]].append(index[int(y)])
        links[index[int(y)]].append(index[int(x)])
    seen = [-1] * len(fps)
    for i in range(len(fps)):
        todo = [i] if seen[i] < 0 else []
        while todo:
            x = todo.pop()
            if seen[x] < 0:
                seen[x] = i
                todo += links[x]
    assert len(set(zip(seen, want, strict=True))) == len(set(seen)) == len(set(want))


def test_simhash_in_several_shards(docs, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 4)
    deep = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    monkeypatch.undo()
    assert deep == {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}


def test_tree_meets_all_links():
    """Of two linked fingerprints the one at home in the earlier shard is sent to the other's shard; shards differ in vantage points."""
    rng = np.random.default_rng(5)
    fps = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))
    near = fps ^ (np.uint64(1) << rng.integers(0, 64, len(fps), dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, len(fps), dtype=np.uint64))
    tree = simhash.plant(fps[:500], 20)
    place, shard = simhash.shards_of(tree, fps, 0)
    assert sorted(place.tolist()) == list(range(len(fps))) and len(set(shard.tolist())) == 20
    home = dict(zip(place.tolist(), shard.tolist(), strict=True))
    visits = set(zip(*(x.tolist() for x in simhash.shards_of(tree, near, 2)), strict=True))
    assert all((i, home[i]) in visits for i in range(len(fps))) and len(visits) < 18 * len(fps)
    assert len({int(n.vantage) for n in (tree, tree.inside, tree.outside)}) == 3


# 2
def slow_repeats(rows):
    seen, out = set(), {}
    for i, text in rows:
        words = text.encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            key = tuple(words[k : k + 20])
            if key in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(key)
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("group", [1, substrings.GROUP])
def test_substrings(docs, odd, group):
    both = docs.unionByName(odd.where("doc_id IS NULL OR doc_id > 3").withColumn("doc_id", -F.col("doc_id")))
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.drop_repeats(both, group).collect()}
    assert found == slow_repeats(texts(both))


# 3
def test_chat(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    more = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (-8, None, None, None), (-8, 1, "tool]", "a\\[ROLE]<"), (-8, 1, "tool]", "a\\[ROLE]<"), (None, 0, "assistant", "")]
    rows = clash(rows.unionByName(spark.createDataFrame(more, rows.schema)))
    found = {r["conv_id"]: r for r in chat.read_chat(chat.format_chat(rows)).collect()}
    talks = collections.defaultdict(list)
    for r in rows.select("conv_id", "turn", "role", "text").collect():
        talks[r["conv_id"]].append((-1 if r["turn"] is None else r["turn"], r["role"] or "", r["text"] or ""))
    assert set(found) == set(talks)
    for c, turns in talks.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert found[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert (found[c]["n_turns"], found[c]["loss_chars"], found[c]["loss_sha256"]) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert found[-7]["n_violations"] == 0 and found[-7]["ends_well"] and found[-8]["n_violations"] == 3
    assert chat.read_chat(chat.format_chat(rows.limit(0))).count() == 0


# 4
def test_lines(spark, odd, none):
    rows = [(i, f"Page {i} of this long book\n{' '.join('abcdefgh'[i] * k for k in range(1, 8))}\nA shared line of all", "en", "s", 1) for i in range(8)]
    df = clash(spark.createDataFrame(rows, SCHEMA))
    out = {r["doc_id"]: r["text"] for r in lines.drop_lines(df).collect()}
    assert out[0] == rows[0][1]
    assert all(out[i] == rows[i][1].split("\n")[1] for i in range(1, 8))
    assert lines.drop_lines(df).columns == df.columns
    report = lines.line_report(odd).collect()
    assert len(report) == len(ODD) and all(r["n_dropped"] == 0 for r in report)
    assert lines.drop_lines(none).count() == 0


# 5
@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 3000])
def test_coder(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 49408, n), np.minimum(rng.geometric(0.05, n), 400), np.zeros(n, np.int64)):
        block = coder.pack(np.array([5, 6]), np.array([n, 0]), ids)
        doc_ids, counts, back = coder.unpack(block)
        assert doc_ids.tolist() == [5, 6] and counts.tolist() == [n, 0] and np.array_equal(back, ids)
        broken = bytearray(block)
        broken[len(block) // 2] ^= 1
        with pytest.raises(coder.BlockError):
            coder.unpack(bytes(broken))


def test_token_blocks(spark, docs, odd, monkeypatch, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "BLOCK_IDS", 500)
    file = public_tokenizers.path("word_bpe_49k.json")
    both = clash(docs.unionByName(odd.withColumn("doc_id", -F.col("doc_id"))))
    tokens.write(both, str(tmp_path / "ids"), file)
    found = collections.Counter((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in tokens.read(spark, str(tmp_path / "ids")).collect())
    tokenizer, start, want = Tokenizer.from_file(file), 0, collections.Counter()
    for i, text in texts(both):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        want[(i, start, len(ids), zlib.crc32(ids.tobytes()))] += 1
        start += len(ids)
    assert found == want


# 6 (n best: test_pieces.py)
def test_pieces_decode(docs, odd, none):
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.encode(clash(docs.unionByName(odd)), model, 4, True).collect()
    assert all(r["round_trip"] and r["extra_costs"] == sorted(r["extra_costs"]) and r["extra_costs"][0] == 0 for r in rows)
    assert all(len(set(r["nbest_crc32"])) == len(r["nbest_crc32"]) and len(r["ids"]) == r["n_pieces"] for r in rows)
    assert len(rows) == docs.count() + len(ODD)
    assert pieces.encode(none, model).count() == 0


# 7
def slow_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(triples)
    covered = {k for i, t in enumerate(triples) if often[t] > 1 for k in range(i, i + 3)}
    rows = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(rows) - len(set(rows)), len(covered), failed


def test_quality(docs, odd, none):
    both = clash(docs.unionByName(odd.withColumn("doc_id", -F.col("doc_id"))))
    found = collections.defaultdict(list)
    for r in quality.judge(both).collect():
        found[r["doc_id"]].append((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]))
        assert not (r["kept"] and r["base_failed"])
    want = collections.defaultdict(list)
    for i, t in texts(both):
        want[i].append(slow_base(t))
    assert found == want
    kept = quality.keep_good(both)
    assert kept.columns == both.columns
    assert sorted(map(str, kept.select("doc_id").collect())) == sorted(map(str, quality.judge(both).where("kept").select("doc_id").collect()))
    assert quality.judge(none).count() == 0 and quality.keep_good(none).count() == 0


def quartiles(values):
    values = sorted(2 ** max(int(v).bit_length() - 6, 0) * (v // 2 ** max(int(v).bit_length() - 6, 0)) for v in values)
    return [next(v for k, v in enumerate(values, 1) if round(values_upto(values, v) / len(values), 9) >= q) for q in (0.25, 0.5, 0.75)]


def values_upto(values, v):
    return sum(x <= v for x in values)


def test_quality_verdict(docs):
    """The cut-offs again, from all values of each group and language."""
    measured = quality.features(docs).withColumns(quality.signals()).withColumn("failed", quality.base_failed()).toPandas()
    kept = {}
    for (lang, _), group in measured.groupby(["lang", "source"]):
        limits = {}
        for signal, (least, low_too) in quality.SIGNALS.items():
            if group.failed.all():
                continue
            g, la = quartiles(group[~group.failed][signal]), quartiles(measured[(measured.lang == lang) & ~measured.failed][signal])
            middle = 0.75 * g[1] + 0.25 * la[1]
            low = middle - quality.SPREADS * max(min(g[1] - g[0], la[1] - la[0]), least) if low_too else 0
            limits[signal] = (low, middle + quality.SPREADS * max(min(g[2] - g[1], la[2] - la[1]), least))
        for r in group.to_dict("records"):
            kept[r["doc_id"]] = not r["failed"] and all(a <= r[s] <= b for s, (a, b) in limits.items())
    assert kept == {r["doc_id"]: r["kept"] for r in quality.judge(docs).collect()}


@pytest.mark.parametrize("share", [0.15, 0.3])
def test_junk_in_a_hot_source(spark, share):
    """A third of all rows in one source, a good part of them junk: the junk goes, all else stays."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(900):
        source = "hot" if i % 3 == 0 else f"s{i % 7}"
        words = [f"w{k}" + "abcdefg"[: k % 6] for k in rng.integers(0, 400, 120).tolist()]
        junk = source == "hot" and rng.random() < share
        if junk:
            words[::2] = [w + "#$%" for w in words[::2]]
        rows.append((i, " ".join(words), "en", source, int(junk)))
    found = quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    junk = {r[0] for r in rows if r[4]}
    assert {r["doc_id"] for r in found if not r["kept"]} == junk


def test_quality_recall(spark):
    """Labelled documents: junk that passes the base rules goes, what passes them and is good stays."""
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.judge(docs).join(labels, "doc_id").where("NOT base_failed").collect()
    good, bad = [r["kept"] for r in found if r["quality"]], [not r["kept"] for r in found if not r["quality"]]
    assert sum(good) >= 0.99 * len(good) and sum(bad) >= 0.9 * len(bad)


# 8
def slow_align(text, item):
    best, score = 0, [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    for i in range(1, len(item) + 1):
        for j in range(1, len(text) + 1):
            score[i][j] = max(0, score[i - 1][j - 1] + (2 if item[i - 1] == text[j - 1] else -1), score[i - 1][j] - 1, score[i][j - 1] - 1)
            best = max(best, score[i][j])
    return best


def test_alignment():
    rng = np.random.default_rng(0)
    for _ in range(300):
        text, item = rng.integers(0, 5, rng.integers(1, 25)), rng.integers(0, 5, rng.integers(1, 15))
        score, first, last = decontaminate.align(text, item)
        assert score == slow_align(text.tolist(), item.tolist())
        assert slow_align(text[first:last].tolist(), item.tolist()) == score


def test_decontamination(spark, docs, odd, none):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    item = benchmark.orderBy("item_id").first()
    words = item["text"].split()
    edited = " ".join(w if i % 6 else "zzz" for i, w in enumerate(words))
    more = spark.createDataFrame([(-1, "before it " + edited + " after it", "en", "a", 1)], SCHEMA)
    both = clash(docs.unionByName(odd.withColumn("doc_id", F.col("doc_id") * -10)).unionByName(more))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find(both, clash(benchmark)).collect()}
    want = {(i, b["item_id"]) for b in benchmark.collect() for i, t in texts(both) if b["text"] in t}
    assert want <= found and (-1, item["item_id"]) in found
    clean = decontaminate.drop_contaminated(both, benchmark)
    assert clean.columns == both.columns and clean.count() == both.count() - len({i for i, _ in found})
    assert decontaminate.find(none, benchmark).count() == 0 and decontaminate.find(docs, benchmark.limit(0)).count() == 0


# 9
def test_licenses(spark, docs, odd, none):
    more = [(-1, "MIT LICENSE mit-license, the MIT  license; GNU General Public\x00License", "en", "a", 1), (-2, licenses.PASSAGES[0][0].replace("person", "man").upper(), "en", "a", 1)]
    both = clash(docs.unionByName(odd.withColumn("doc_id", F.col("doc_id") * -10)).unionByName(spark.createDataFrame(more, SCHEMA)))
    want, found = collections.Counter(), collections.Counter()
    for i, t in texts(both):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.encode().lower().decode())
        at = [(k, label) for p, label in licenses.PHRASES for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        want[(i, len(words), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at})))] += 1
    rows = licenses.scan(both).collect()
    for r in rows:
        found[(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])] += 1
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert found == want
    assert next(r for r in rows if r["doc_id"] == -2)["labels"] == "mit"
    assert licenses.scan(none).count() == 0


# 10
def test_language(docs, odd, none):
    model = langid.fit(docs)
    rows = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out(F.col("doc_id"))).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    found = {r["doc_id"]: r["lang_pred"] for r in langid.predict(clash(odd), model).collect()}
    assert found[1] == found[2] == found[4] == "und" and found[6] in {r["lang"] for r in model.collect()}
    assert langid.predict(docs.limit(3), langid.fit(none)).where("lang_pred = 'und'").count() == 3


def test_code_lengths_by_hand():
    """Each byte's code length, from dictionaries of contexts."""
    samples = {"a": b"the cat sat on the mat the end", "b": b"das ist ein satz und noch ein satz"}
    trees = []
    for sample in samples.values():
        p = b"\0\0\0" + sample
        counted = collections.Counter(int.from_bytes(p[i : i + 4], "big") for i in range(len(sample)))
        trees.append(langid.Tree.of(np.array(list(counted)), np.array(list(counted.values()))))
    model = langid.Model(list(samples), [langid.Tree.load(t.dump()) for t in trees])
    text = b"the satz is new"
    for k, s in enumerate(samples.values()):
        p, bits = b"\0\0\0" + s, 0.0
        t = b"\0\0\0" + text
        for i in range(3, len(t)):
            add = 0.0
            for order in (3, 2, 1, 0):
                context = t[i - order : i]
                after = collections.Counter(p[j] for j in range(3, len(p)) if p[j - order : j] == context)
                n, d = sum(after.values()), len(after)
                if n == 0:
                    continue
                if after[t[i]]:
                    add -= np.log2(after[t[i]] / (n + d))
                    break
                add -= np.log2(d / (n + d))
            else:
                add += 8
            bits += add
        assert model.code_lengths([text])[0, k] == pytest.approx(bits, rel=1e-4)
        assert model.code_lengths([b"", text, b"x", text])[[1, 3], k] == pytest.approx(bits, rel=1e-4)


def test_language_in_groups(docs, monkeypatch):
    trees = langid.fit(docs)
    want = {r["doc_id"]: (r["lang_pred"], round(r["score"], 6)) for r in langid.predict(docs, trees).collect()}
    monkeypatch.setattr(langid, "GROUP_BYTES", 1)
    monkeypatch.setattr(langid, "STRETCH", 50)
    assert want == {r["doc_id"]: (r["lang_pred"], round(r["score"], 6)) for r in langid.predict(docs, trees).collect()}


# all
def test_near_duplicates_odd(docs, odd, none):
    rows = simhash.near_duplicates(clash(odd)).collect()
    assert len(rows) == len(ODD)
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2, 4)} == {1}
    assert {r["component_id"] for r in rows if r["doc_id"] in (None, 3)} == {3}
    assert sorted(str(r["doc_id"]) for r in simhash.drop_near_duplicates(clash(odd)).collect()) == ["1", "3", "5", "6", "7"]
    assert simhash.near_duplicates(none).count() == 0


def five_grams(text):
    words = text.lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def similar_components(rows):
    """Brute force: the smallest id reachable over pairs of Jaccard 0.8 or more; texts without words are copies."""
    sets = [five_grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if (not sets[a] and not sets[b]) or 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both) > 0:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    lowest = {}
    for k, (i, _) in enumerate(rows):
        lowest[find(k)] = min(i, lowest.get(find(k), i))
    return {i: lowest[find(k)] for k, (i, _) in enumerate(rows)}


def test_pipeline(spark, docs):
    """Each stage again: by brute force where there is a short one, else by its operator."""
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    good = {r["doc_id"] for r in quality.judge(docs).where("kept").collect()}
    two = lines.drop_lines(docs.where(F.col("doc_id").isin(list(good))))
    rows = texts(two)
    stay = set(similar_components(rows).values())
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    held = {i for i, t in rows if i in stay and any(b["text"] in t for b in benchmark.collect())}
    edited = {r["doc_id"] for r in decontaminate.find(two.where(F.col("doc_id").isin(list(stay))), benchmark).collect()}
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    left = {r["doc_id"] for r in out}
    assert held <= edited and left == stay - edited and all(r["round_trip"] for r in out) and len(out) == len(left)


def test_pipeline_odd(spark, docs, odd, none, tmp_path):
    """The stages over nulls, repeated rows, clashing columns and an empty table; an id's other text is a document of its own."""
    good = docs.orderBy("doc_id").limit(60)
    twice = good.withColumn("text", F.concat(F.reverse(F.split("text", " "))[0], F.lit(" "), "text")).where("doc_id % 7 = 0")
    for name, given in {"odd": clash(good.unionByName(odd).unionByName(twice).unionByName(good.where("doc_id % 5 = 0").withColumn("doc_id", F.lit(None).cast("long")))), "none": none}.items():
        folder = tmp_path / name
        given.write.parquet(str(folder / "documents.parquet"))
        spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(str(folder / "benchmark.parquet"))
        df = spark.read.parquet(str(folder / "documents.parquet"))
        for stage_name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, str(folder))
            assert out.columns == df.columns, stage_name
        found = corpus_pipeline.run(spark, str(folder)).collect()
        assert all(r["round_trip"] for r in found) and (name == "odd") == bool(found)
