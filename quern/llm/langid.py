"""Language identification by prediction by partial matching (PPM).

Each language has a byte context tree of orders 0 to 3 with frozen counts.  A symbol's code length is that
of the longest context that has seen it, plus the escapes (method C: as many as the context has distinct
symbols) of the longer ones that have not; below order 0 every byte takes 8 bits.  The language whose tree
codes a text in the fewest bits is predicted.

The trees are fitted on at most SAMPLE documents per language (those with the smallest id hashes), and keep every
context of these.  Spark counts the strings and a task builds each language's tree; trees go to the tasks in groups
of at most GROUP_BYTES, and with more than one group each adds its languages to a text's result so far.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import checkpointed, map_arrow

#: Most labelled documents per language that a model is fitted on.
SAMPLE = 2_000
#: Trees that are broadcast at once, in bytes (a single larger tree goes alone); bytes of text that are coded at once.
GROUP_BYTES, STRETCH = 200_000_000, 4_000_000
UNKNOWN = "und"


@dataclass
class Tree:
    """One language's code lengths: of strings of four and three bytes that were seen (their last byte, after the others),
    of a context's escape (0 where it was never seen), and whole ones of order 1 and below."""

    four: np.ndarray
    four_bits: np.ndarray
    three: np.ndarray
    three_bits: np.ndarray
    context: np.ndarray
    escape_three: np.ndarray
    escape_two: np.ndarray
    low: np.ndarray

    @classmethod
    def of(cls, grams: np.ndarray, counts: np.ndarray) -> Tree:
        """From distinct strings of four bytes as numbers (first byte highest; 0 bytes stand before a text) and their counts."""
        order = np.argsort(grams)
        four, n = grams[order].astype(np.int64), counts[order].astype(np.float64)
        zero = np.bincount(four & 255, n, 256)
        zero_bits = _bits(zero[None, :], np.full((1, 256), 8.0))
        one_bits = _bits(np.bincount(four & 0xFFFF, n, 1 << 16).reshape(256, 256), zero_bits)
        three, at = np.unique(four & 0xFFFFFF, return_inverse=True)
        three_bits, contexts, escapes = _sparse(three, np.bincount(at, n))
        escape_two = np.zeros(1 << 16)
        escape_two[contexts] = escapes
        four_bits, context, escape_three = _sparse(four, n)
        small = lambda a: a.astype(np.float32)
        return cls(four.astype(np.uint32), small(four_bits), three.astype(np.uint32), small(three_bits), context.astype(np.uint32), small(escape_three), small(escape_two), small(one_bits.ravel()))

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Code lengths of the last bytes of strings of four bytes."""
        three = grams & np.uint32(0xFFFFFF)
        at, seen = _find(self.three, three)
        out = np.where(seen, self.three_bits[at], self.low[three & np.uint32(0xFFFF)] + self.escape_two[three >> np.uint32(8)])
        at, known = _find(self.context, grams >> np.uint32(8))
        out += np.where(known, self.escape_three[at], 0)
        at, seen = _find(self.four, grams)
        return np.where(seen, self.four_bits[at], out)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **vars(self))
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Tree:
        return cls(**np.load(io.BytesIO(raw)))


def _bits(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Code lengths of each symbol (columns) in each context (rows), given those after an escape."""
    n, d = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n == 0, lower, np.where(counts > 0, -np.log2(counts / (n + d)), lower - np.log2(d / (n + d))))


def _sparse(strings: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code lengths of sorted strings' last bytes; the contexts before these, and their escapes."""
    contexts, at = np.unique(strings >> 8, return_inverse=True)
    n, d = np.bincount(at, counts), np.bincount(at)
    return np.log2((n + d)[at] / counts), contexts, np.log2((n + d) / d)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of what is wanted among sorted keys, and whether it is there."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class Model:
    """Trees of some languages, in the order of their names."""

    langs: list[str]
    trees: list[Tree]

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits that each language's tree takes for each text."""
        out = np.zeros((len(texts), len(self.langs)))
        held: list[tuple[int, bytes]] = []  # a text's number and a stretch of it, after the three bytes before
        size = 0
        for i, text in enumerate(texts):
            for at in range(0, len(text), STRETCH):
                held.append((i, (bytes(3) + text[:STRETCH]) if at == 0 else text[at - 3 : at + STRETCH]))
                size += len(held[-1][1])
                if size >= STRETCH:
                    self._add(held, out)
                    held, size = [], 0
        if held:
            self._add(held, out)
        return out

    def _add(self, held: list[tuple[int, bytes]], out: np.ndarray) -> None:
        b = np.frombuffer(b"".join(t for _, t in held), np.uint8).astype(np.uint32)
        grams = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
        ends = np.cumsum([len(t) for _, t in held])
        begins = ends - [len(t) for _, t in held]
        distinct, of = np.unique(grams, return_inverse=True)
        which = [i for i, _ in held]
        for k, tree in enumerate(self.trees):
            sums = np.concatenate(([0.0], np.cumsum(tree.bits(distinct)[of], dtype=np.float64)))
            np.add.at(out[:, k], which, sums[ends - 3] - sums[begins])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) over a partition."""
    have: dict[str, list[np.ndarray]] = {}

    def fold(lang: str) -> None:
        grams, counts = np.concatenate([g for g, _ in have[lang]]), np.concatenate([c for _, c in have[lang]])
        unique, at = np.unique(grams, return_inverse=True)
        have[lang] = [(unique, np.bincount(at, counts, len(unique)).astype(np.int64))]

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            b = np.frombuffer(b"\0\0\0" + (text or b""), np.uint8).astype(np.int64)
            if len(b) > 3:
                grams = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
                have.setdefault(lang, []).append((grams, np.ones(len(grams), np.int64)))
                if sum(len(g) for g, _ in have[lang]) > 1 << 21:
                    fold(lang)
    for lang in have:
        fold(lang)
        grams, counts = have[lang][0]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams), pa.array(counts)], ["lang", "gram", "n"])


def _tree(table: pa.Table) -> pa.Table:
    raw = Tree.of(table.column("gram").to_numpy(), table.column("n").to_numpy()).dump()
    return pa.table({"lang": table.column("lang")[:1], "tree": pa.array([raw], pa.large_binary()).cast(pa.binary()), "size": pa.array([len(raw)], pa.int64())})


def held_out(doc_id: Column) -> Column:
    """True for the rows that nothing is learned from: crc32 of the id as text is 2 modulo 4.  Null id: false."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(lang, tree, size): a row per language, fitted on the rows with a language, a text and an id that are not held out, ``sample`` a language at most."""
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    hashed = rows.select("doc_id", "lang", F.xxhash64("doc_id").alias("_hash")).withColumn("_bucket", F.shiftright("_hash", 52))
    # A language may have most rows: counts of 2^12 ranges of hashes tell where its sample ends, and no more is ranked.
    counts = hashed.groupBy("lang", "_bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("_bucket")) - F.col("n")
    cuts = counts.withColumn("_before", before).where(F.col("_before") < sample).groupBy(F.col("lang").alias("_lang")).agg(F.max("_bucket").alias("_cut"))
    cuts = checkpointed(cuts)
    if cuts.count() <= 100_000:  # a row a language
        cuts = F.broadcast(cuts)
    near = hashed.join(cuts, (F.col("lang") == F.col("_lang")) & (F.col("_bucket") <= F.col("_cut")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_hash", "doc_id"))
    ids = checkpointed(near.select("doc_id", "lang", "_hash").withColumn("_rank", rank).where(F.col("_rank") <= sample).select("doc_id").distinct())
    if ids.count() <= 100_000:  # beyond it (many languages) Spark joins by a shuffle
        ids = F.broadcast(ids)
    texts = rows.select("doc_id", F.col("lang").cast("string"), "text").join(ids, "doc_id", "left_semi").select("lang", "text")
    grams = texts.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return checkpointed(grams.groupBy("lang").applyInArrow(_tree, "lang string, tree binary, size long"))


def _groups(trees: DataFrame) -> list[list[str]]:
    """Languages in the order of their names, in groups whose trees take GROUP_BYTES at most."""
    groups: list[list[str]] = [[]]
    total = 0
    for lang, size in trees.select("lang", "size").orderBy("lang").collect():  # a row a language
        if groups[-1] and total + size > GROUP_BYTES:
            groups.append([])
            total = 0
        groups[-1].append(lang)
        total += size
    return groups


def load(trees: DataFrame, langs: list[str]) -> Model:
    """The trees of some languages, of GROUP_BYTES as a rule."""
    rows = trees.where(F.col("lang").isin(langs)).select("lang", "tree").orderBy("lang").collect()
    return Model([r["lang"] for r in rows], [Tree.load(bytes(r["tree"])) for r in rows])


def predict(docs: DataFrame, trees: DataFrame) -> DataFrame:
    """(doc_id, lang_pred, score) of each row.  Only the text is read for a prediction.

    score: the probability of the language when all are as likely beforehand.  A text that is null or has no
    letter gets ``und`` and 0, and so does every text when the model has no language.  Equal code lengths go
    to the first language by name.  Repeated rows get a row each.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    # So far: the best language, its bits, and the sum over languages of 2 ** (best bits - bits).
    sofar = docs.select("doc_id", F.col("text").cast("string"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(float("inf")).alias("bits"), F.lit(0.0).alias("whole"))
    groups = _groups(trees)
    for group in groups:
        shared = spark.sparkContext.broadcast(load(trees, group))

        def run(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            m = shared.value
            texts = batch.column(1).to_pylist()
            which = [i for i, t in enumerate(texts) if m.langs and t is not None and any(map(str.isalpha, t))]
            names = batch.column(2).to_pylist()
            least, whole = (batch.column(c).to_numpy(zero_copy_only=False).copy() for c in (3, 4))
            if which:
                bits = m.code_lengths([texts[i].encode() for i in which])
                best = bits.argmin(axis=1)
                low = bits.min(axis=1)
                old, new = least[which], np.minimum(least[which], low)
                shrunk = np.where(np.isinf(old), 0, whole[which] * np.exp2(-np.minimum(np.where(np.isinf(old), 0, old) - new, 1000)))
                whole[which] = shrunk + np.exp2(-np.minimum(bits - new[:, None], 1000)).sum(axis=1)
                least[which] = new
                for i, b, better in zip(which, best.tolist(), (low < old).tolist(), strict=True):
                    if better:
                        names[i] = m.langs[b]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names), pa.array(least), pa.array(whole)], batch.schema.names)

        sofar = map_arrow(sofar, run, f"doc_id {kind}, text string, lang_pred string, bits double, whole double")
        if group is not groups[-1]:
            sofar = checkpointed(sofar)  # so that one group's trees are in memory at a time
    return sofar.select("doc_id", "lang_pred", F.when(F.col("whole") > 0, 1 / F.col("whole")).otherwise(0.0).alias("score"))
