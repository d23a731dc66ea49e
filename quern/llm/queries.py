"""The registered queries of this subpackage: thin views over the operators' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import chat, decontaminate, langid, licenses, lines, pieces, quality, simhash, substrings, tokens


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), radius=4, width=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.drop_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    text = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], rows.schema)
    return chat.read_chat(chat.format_chat(rows.unionByName(own)))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.line_report(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = tokens.shared_folder(spark, "ids")
    tokens.write(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return tokens.read(spark, path)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), n_best=4)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judge(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs)).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_blocks": op5_token_blocks,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_quality_rules": op7_quality_rules,
    "op8_decontamination": op8_decontamination,
    "op9_license_scan": op9_license_scan,
    "op10_language_id": op10_language_id,
}

#: SQL where SQL can express the query, over tables whose ids are unique and not null.
ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": rf"""
WITH raw AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
ln AS (SELECT doc_id, unnest(range(len(ls))) AS line, unnest(ls) AS t FROM raw),
tk AS (
  SELECT doc_id, line, string_split_regex(trim(regexp_replace(t, '[^ \t\r\x0b\x0c]*[0-9][^ \t\r\x0b\x0c]*', '<*>', 'g'),
         ' ' || chr(9) || chr(13) || chr(11) || chr(12)), '[ \t\r\x0b\x0c]+') AS tok
  FROM ln),
lf AS (SELECT *, len(tok) AS n, tok[1:{lines.DEPTH}] AS path FROM tk WHERE tok[1] <> ''),
un AS (SELECT doc_id, line, n, path, unnest(range(n)) AS pos, unnest(tok) AS token FROM lf),
often AS (SELECT n, path, pos, token FROM un GROUP BY ALL HAVING count(*) >= {lines.MIN_DOCS} AND token <> '<*>'),
shape AS (
  SELECT u.doc_id, u.line, string_agg(CASE WHEN o.token IS NULL THEN '<*>' ELSE u.token END, ' ' ORDER BY u.pos) AS template
  FROM un u LEFT JOIN often o ON u.n = o.n AND u.path = o.path AND u.pos = o.pos AND u.token = o.token
  GROUP BY u.doc_id, u.line, u.n HAVING count(o.token) > 0 AND count(o.token) >= CASE WHEN u.n < {lines.SHORT} THEN 0.5 ELSE {lines.CONSTANT} END * u.n),
recurring AS (SELECT template, min(doc_id) AS first FROM shape GROUP BY template HAVING count(DISTINCT doc_id) >= {lines.MIN_DOCS}),
gone AS (SELECT doc_id, line FROM shape JOIN recurring USING (template) WHERE doc_id > first),
kept AS (
  SELECT ln.doc_id, string_agg(CASE WHEN g.line IS NULL THEN t END, chr(10) ORDER BY ln.line) AS text, count(*) AS n_lines, count(g.line) AS n_dropped
  FROM ln LEFT JOIN gone g ON ln.doc_id = g.doc_id AND ln.line = g.line GROUP BY ln.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
""",
}
