"""Empty tables, clashing columns, and rows that share a doc_id, for operators whose own tests don't cover them."""

import collections

from pyspark.sql import functions as F
from test_llm_operators import SCHEMA, SF_DIR, clash, quartiles

from quern.llm import jaccard, langid, licenses, pieces, quality, simhash, substrings, tokens

SHARED = " ".join(f"shared{i}" for i in range(30))


def test_substrings_odd(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert substrings.drop_repeats(none).count() == 0
    rows = [(1, SHARED, "en", "a", 1), (2, "own " + SHARED, "en", "a", 1), (3, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(str, substrings.drop_repeats(clash(df)).collect())) == sorted(map(str, substrings.drop_repeats(df).collect()))


def test_token_blocks_empty(spark, tmp_path):
    import public_tokenizers

    tokens.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"), public_tokenizers.path("word_bpe_49k.json"))
    assert tokens.read(spark, str(tmp_path / "none")).count() == 0


def test_one_id_with_several_texts(spark):
    """Operators that judge each row by its own text give each its own result."""
    rows = [(7, "the mit license of the house", "en", "a", 1), (7, "rien de plus", "fr", "b", 1), (None, "mit license", "en", "a", 1), (None, "", None, None, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r["base_labels"] for r in licenses.scan(df).where("doc_id = 7").collect()) == ["", "mit"]
    trees = langid.fit(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    assert langid.predict(df, trees).count() == 4 and langid.predict(df, trees).where("lang_pred = 'und'").count() == 1
    assert quality.judge(df).count() == 4 and simhash.near_duplicates(df).count() == 4
    assert jaccard.drop_near_duplicates(df).count() == 4
    import public_tokenizers

    assert pieces.encode(df, public_tokenizers.path("piece_bpe_32k.model")).where("round_trip").count() == 4


def test_fit_on_ids_with_several_texts(spark):
    ids = [i for i, in spark.range(200).where(~langid.held_out(F.col("id"))).limit(4).collect()]
    rows = [(i, t, lang, "a", 1) for i in ids for t, lang in (("the cat sat on the mat", "en"), ("das ist der hund und", "de"))] + [(None, "the", "en", "a", 1)]
    trees = langid.fit(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r["lang"] for r in trees.collect()) == ["de", "en"]


def test_quality_null_groups(spark):
    """Null languages and sources are groups of their own."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = docs.withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.col("lang"))).withColumn("source", F.when(F.col("doc_id") % 5 > 0, F.col("source")))
    measured = [r.asDict() for r in quality.features(odd).withColumns(quality.signals()).withColumn("failed", quality.base_failed()).collect()]
    groups, langs = collections.defaultdict(list), collections.defaultdict(list)
    for r in measured:
        if not r["failed"]:
            groups[r["lang"], r["source"]].append(r)
            langs[r["lang"]].append(r)
    want = {}
    for r in measured:
        kept = not r["failed"]
        for signal, (least, low_too) in quality.SIGNALS.items() if kept else ():
            g, la = quartiles([x[signal] for x in groups[r["lang"], r["source"]]]), quartiles([x[signal] for x in langs[r["lang"]]])
            middle = 0.75 * g[1] + 0.25 * la[1]
            low = middle - quality.SPREADS * max(min(g[1] - g[0], la[1] - la[0]), least) if low_too else 0
            kept = kept and low <= r[signal] <= middle + quality.SPREADS * max(min(g[2] - g[1], la[2] - la[1]), least)
        want[r["doc_id"]] = kept
    assert {r["doc_id"]: r["kept"] for r in quality.judge(odd).collect()} == want
