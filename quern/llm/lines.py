"""Line dedup by a log-template tree, with DataFrame operations only.

A line's tokens lead it down a tree of fixed depth: the number of tokens, then the first DEPTH tokens; a token
with a digit is a variable field anywhere.  In a leaf, a token that fewer than MIN_DOCS of the leaf's lines have
at its place is a variable field, too.  What is left, with the fields as wildcards, is the line's template.  A
template is boilerplate if it keeps at least CONSTANT of its tokens (half of them, where a line has fewer than SHORT)
and lines of MIN_DOCS documents have it; its lines are dropped from all documents but the first (by doc_id), so
nothing that is said is lost altogether.  Lines without a token are left alone.

Leaves that hold lines of one document only, or fewer lines than MIN_DOCS, are dropped by one sum over
fixed-size keys before any text moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import checkpointed, with_ties

#: Leading tokens in a path; documents that make a template recurrent; least constant share; tokens of a line that isn't short.
DEPTH, MIN_DOCS, CONSTANT, SHORT = 3, 5, 0.7, 5
#: White space inside lines, and what stands for a variable field.
SPACE, FIELD = " \t\r\x0b\x0c", "<*>"
#: Leaves (8 bytes each) and templates (48 bytes each) that may be broadcast.
BROADCAST_LEAVES, BROADCAST_TEMPLATES = 1_000_000, 400_000
NO_ID = -(1 << 63)


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))


def _tokens(line: Column) -> Column:
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, f"[^{SPACE}]*[0-9][^{SPACE}]*", FIELD)).otherwise(line)
    return F.split(F.trim(masked, F.lit(SPACE)), f"[{SPACE}]+")


def _lines(docs: DataFrame) -> DataFrame:
    """(doc, tie, line, leaf, text) of the lines with a token, of rows (doc, tie, text)."""
    rows = docs.select("doc", "tie", F.posexplode(F.split("text", "\n", -1)).alias("line", "text"))
    rows = rows.withColumn("tokens", _tokens(F.col("text"))).where(F.col("tokens")[0] != "")
    return rows.select("doc", "tie", "line", F.xxhash64(F.size("tokens"), F.slice("tokens", 1, DEPTH)).alias("leaf"), "text")


def dropped_lines(identified: DataFrame) -> DataFrame:
    """(doc, tie, lines): numbers (from 0) of each document's lines to drop; documents without any are absent."""
    lines = _lines(identified)
    document = F.struct("doc", "tie")
    leaves = lines.groupBy("leaf").agg(F.count("*").alias("n"), F.min(document).alias("low"), F.max(document).alias("high"))
    leaves = checkpointed(leaves.where((F.col("n") >= MIN_DOCS) & (F.col("low") < F.col("high"))).select("leaf"))
    if leaves.count() <= BROADCAST_LEAVES:  # more are joined by a shuffle of the lines
        leaves = F.broadcast(leaves)
    lines = checkpointed(lines.join(leaves, "leaf", "left_semi"))
    tokens = lines.select("doc", "tie", "line", "leaf", F.posexplode(_tokens(F.col("text"))).alias("at", "token"))
    often = tokens.groupBy("leaf", "at", "token").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_DOCS).withColumn("constant", F.lit(1)).drop("n")
    parts = tokens.join(often, ["leaf", "at", "token"], "left").withColumn("constant", F.coalesce(F.when(F.col("token") == FIELD, 0), "constant", F.lit(0)))
    field = F.when(F.col("constant") == 1, F.col("token")).otherwise(FIELD)
    # A template's digest: sums over hashes of its places, so that a line's tokens need no gathering.
    digest = F.sum(F.xxhash64("at", field).cast("decimal(20,0)"))
    check = F.bit_xor(F.xxhash64(field, "at", F.lit(7)))
    shapes = parts.groupBy("doc", "tie", "line", "leaf").agg(digest.alias("digest"), check.alias("check"), F.sum("constant").alias("constant"), F.count("*").alias("n"))
    share = F.when(F.col("n") < SHORT, 0.5).otherwise(CONSTANT)
    shapes = shapes.where((F.col("constant") > 0) & (F.col("constant") >= share * F.col("n"))).drop("constant", "n")
    key = ["leaf", "digest", "check"]
    shapes = checkpointed(shapes)
    recurring = shapes.groupBy(*key).agg(F.count_distinct("doc", "tie").alias("docs"), F.min(document).alias("first")).where(F.col("docs") >= MIN_DOCS)
    recurring = checkpointed(recurring.select(*key, "first"))
    if recurring.count() <= BROADCAST_TEMPLATES:  # a template may have very many lines, which then stay where they are
        recurring = F.broadcast(recurring)
    gone = shapes.join(recurring, key).where(document > F.col("first"))
    return gone.groupBy("doc", "tie").agg(F.collect_set("line").alias("lines"))


def drop_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns, texts without the lines that recur across documents.

    A null text stays null.  A text whose lines all go becomes empty and its row stays.  A null doc_id comes
    before all others.  Rows that repeat a doc_id and text are one document and lose the same lines; rows that
    share a doc_id with other texts are documents of their own, in the order of a hash of their texts.
    Columns of other names pass through, whatever they are called.  An empty table gives no rows.
    """
    return _applied(docs)[0]


def _applied(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    names = [f"_doc_{i}" for i in range(len(docs.columns))]
    text, doc = names[docs.columns.index("text")], names[docs.columns.index("doc_id")]
    given = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)])
    given = given.withColumn("_key", F.coalesce(F.col(doc).cast("long"), F.lit(NO_ID))).withColumn("_text", F.col(text).cast("string"))
    given = with_ties(given, "_key", "_text")
    gone = dropped_lines(given.select(F.col("_key").alias("doc"), "tie", F.col("_text").alias("text")))
    gone = gone.select(F.col("doc").alias("_key"), "tie", F.col("lines").alias("_gone"))
    lines = F.split("_text", "\n", -1)
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("_gone", i)), "\n")
    joined = given.join(gone, ["_key", "tie"], "left").withColumn("_n", F.size(lines)).withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(kept))
    back = [F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)]
    counted = joined.select(
        F.col(doc).alias("doc_id"),
        F.greatest("_n", F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.col(text).alias("text"),
    )
    return joined.select(*back), counted


def line_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) of each row; a null text has no lines."""
    return _applied(docs.select("doc_id", "text"))[1].withColumn("n_dropped", F.greatest("n_dropped", F.lit(0)).cast("long"))
