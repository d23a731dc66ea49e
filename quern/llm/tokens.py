"""Token ids of a corpus in block files, and back.

Spark deals the documents to ranges of doc_id and sorts each, so the files' order is that of doc_id.  A task
tokenizes its range, fills blocks of whole documents with ids (see coder) and hands them to Spark's Parquet writer,
whose commit protocol keeps one copy of each, also when executors are lost.  Reading decodes and checks each
block by itself; where a block begins comes from the numbers of ids of those before it, summed up by range first.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm import coder
from quern.llm.common import SLICE, ensure_checkpoint_dir, ragged
from quern.llm.substrings import _BASE, _INVERSE, _powers

#: Ids from which a block is closed.
BLOCK_IDS = coder.LANES * 512
#: Units that a worker remembers of late (as many again from before); units that the tokenizer gets as one text;
#: characters that are encoded at once; longest unit that is known by its hashes.
REMEMBERED, TOGETHER, CHARACTERS, LONGEST = 300_000, 128, 2_000_000, 64
#: White space to Python alone.
ODD = "\x1c\x1d\x1e\x1f"
#: Holds a unit of each kind.
PROBE = "The Quick-brown fox's 3rd café: ÀÉß ŁŐ $$$ 12!? nº «x» don't 日本\n Σας"
NO_ID = -(1 << 63)
BLOCKS = "range int, number int, n_docs long, n_ids long, block binary"


SPACE, LETTER, DIGIT, OTHER, STRANGE = range(5)
#: Code points that are told apart; all above, and some below, are strange.
LIMIT = 0x2060


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of each code point up to LIMIT.

    Letters are Latin ones whose lower case and composition are the character's own affair.  An apostrophe is strange,
    since it may begin a contraction.
    """
    kind, lower = np.full(LIMIT + 1, STRANGE, np.uint8), np.arange(LIMIT + 1)
    kind[[*b" \t\n\r\x0b\x0c"]] = SPACE
    for c in [*range(0x21, 0x7F), 0xD7, 0xF7, *range(0x2010, 0x2028), *range(0x2030, 0x205F)]:
        kind[c] = OTHER
    for c in [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x130), *range(0x131, 0x234)]:
        kind[c], lower[c] = LETTER, ord(chr(c).lower())
    kind[0x30:0x3A] = DIGIT
    kind[0x27] = STRANGE
    return kind, lower


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones themselves, the others from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordTokenizer:
    """A tokenizer that drops white space and splits before its merges, applied to each distinct unit once.

    A unit is what the tokenizer's splitter makes of plain words: a run of letters, a digit, a run of other signs.  It
    goes to the library's model as the bytes that the splitter would hand on, and is known by two 64-bit hashes, which
    are sums over its characters and so come from one pass over a whole batch.  A word with a strange character, or a long one, is a unit
    as it stands and goes through the whole of the library's tokenizer.  The end of a unit shows in its last token,
    which alone has END.
    """

    END = "</w>"

    def __init__(self, file: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole, self.merges = Tokenizer.from_file(file), Tokenizer.from_file(file)
        self.merges.normalizer = normalizers.Sequence([])
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(self.END)]] = True
        self.special = [*ODD, *(t.content for t in self.whole.get_added_tokens_decoder().values())]
        self.letters = _byte_letters() | {32: " "}
        self.kind, self.lower = _kinds()
        values = np.random.default_rng(42).integers(0, 1 << 64, (2, LIMIT + 1), np.uint64)
        self.first, self.second = values[0][self.lower], values[1][self.lower]
        self.powers = self.inverse = np.ones(1, np.uint64)
        #: By hash: the second hash and the ids, as bytes; strange words by themselves.
        self.known: dict[int | str, bytes] = {}
        self.before: dict[int | str, bytes] = {}
        #: Whether this tokenizer is of the kind described; texts of any other go to the library as they are.
        self.by_units = bool(self.ends.any())
        self.by_units = self.by_units and np.array_equal(self.encode([PROBE])[0], self.whole.encode(PROBE, add_special_tokens=False).ids)

    def _units(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of each unit, and whether it stands as it is."""
        kind = self.kind[np.minimum(codes, LIMIT)]
        space = kind == SPACE
        before = np.concatenate(([True], space[:-1]))
        begin = ~space & (before | (kind == DIGIT) | (np.concatenate(([SPACE], kind[:-1])) != kind))
        word = ~space & before
        strange = np.nonzero(kind == STRANGE)[0]
        if len(strange):
            words = np.cumsum(word, dtype=np.int32)
            as_is = np.zeros(int(words[-1]) + 1, bool)
            as_is[words[strange]] = True
            begin &= word | ~as_is[words]
        end = ~space & np.concatenate((space[1:] | begin[1:], [True]))
        begins, ends = np.nonzero(begin)[0], np.nonzero(end)[0] + 1
        stands = ends - begins > LONGEST
        if len(strange):
            stands |= as_is[words[begins]]
        return begins, ends, stands

    def _hashes(self, codes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.powers) <= len(codes):
            size = 2 * len(codes)
            self.powers, self.inverse = _powers(_BASE, size), _powers(_INVERSE, size)
        at = np.minimum(codes, LIMIT)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(self.first[at] * self.powers[: len(codes)], out=sums[1:])
        one = (sums[ends] - sums[begins]) * self.inverse[begins]
        np.cumsum(self.second[at], out=sums[1:])
        return one ^ (one >> np.uint64(29)), sums[ends] - sums[begins]

    def _recall(self, keys: list) -> tuple[list[bytes | None], list[int]]:
        """What is known of the keys, of late or from before, and the places of those that aren't."""
        found = list(map(self.known.get, keys))
        rest = []
        for i in [i for i, f in enumerate(found) if f is None]:
            if (old := self.before.get(keys[i])) is None:
                rest.append(i)
            else:
                found[i] = self.known[keys[i]] = old
        return found, rest

    def _learn(self, keys: list[int], checks: np.ndarray, units: list[str]) -> None:
        texts = [" ".join(units[at : at + TOGETHER]) for at in range(0, len(units), TOGETHER)]
        texts = [t if t.isascii() else t.encode().decode("latin-1").translate(self.letters) for t in texts]
        own, at, known = checks.tobytes(), 0, self.known
        for e in self.merges.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(e.ids, np.int32)
            raw, low = ids.tobytes(), 0
            for high in ((np.nonzero(self.ends[ids])[0] + 1) * 4).tolist():
                known[keys[at]] = own[8 * at : 8 * at + 8] + raw[low:high]
                low, at = high, at + 1

    def _group(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = "\n".join(texts) + "\n"
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        begins, ends, stands = self._units(codes)
        one, two = self._hashes(codes, begins, ends)
        raw = np.nonzero(stands)[0]
        one[raw] = 0
        distinct, which, of = np.unique(one, return_index=True, return_inverse=True)
        keys = distinct.tolist()
        if len(raw):  # strange words get places of their own after the others
            names = [text[a:b] for a, b in zip(begins[raw].tolist(), ends[raw].tolist(), strict=True)]
            place: dict[str, int] = {}
            of[raw] = [place.setdefault(n, len(keys) + len(place)) for n in names]
            strange = list(place)
        else:
            strange = []
        found, missing = self._recall(keys)
        rest = np.array(missing, np.int64)
        rest = rest[~stands[which[rest]]]
        lower = self.lower
        spans = zip(begins[which[rest]].tolist(), ends[which[rest]].tolist(), strict=True)
        low = lower[np.minimum(codes, LIMIT)].astype(np.uint32).tobytes().decode("utf-32-le")
        self._learn(distinct[rest].tolist(), two[which[rest]], [low[a:b] for a, b in spans])
        for i in missing:  # the place of strange words stays empty
            found[i] = self.known.get(keys[i], bytes(8))
        as_is, missing = self._recall(strange)
        new = [strange[i] for i in missing]
        for i, e in zip(missing, self.whole.encode_batch_fast(new, add_special_tokens=False), strict=True):
            as_is[i] = self.known[strange[i]] = bytes(8) + np.array(e.ids, np.int32).tobytes()
        found += as_is
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, starts = np.frombuffer(b"".join(found), np.int32), np.cumsum(sizes) - sizes
        checks = np.stack((flat[starts], flat[starts + 1]), axis=1).view(np.uint64).ravel()
        if ((checks[of] != two) & ~stands).any():  # two units of one hash
            whole = [np.array(e.ids, np.int32) for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
            return np.concatenate(whole), np.array([len(w) for w in whole])
        counts = sizes[of] - 2
        ids = flat[ragged(starts[of] + 2, counts)]
        upto = np.concatenate(([0], np.cumsum(counts)))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        return ids, np.diff(upto[np.searchsorted(begins, np.concatenate(([0], np.cumsum(lengths))))])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if not self.by_units:
            return [np.array(e.ids, np.int32) for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            if len(self.known) > REMEMBERED:
                self.known, self.before = {}, self.known
            upto, size = at, 0
            while upto < len(texts) and (upto == at or size + len(texts[upto]) <= CHARACTERS):
                size += len(texts[upto])
                upto += 1
            ids, counts = self._group(texts[at:upto])
            out += np.split(ids, np.cumsum(counts)[:-1])
            at = upto
        for i, text in enumerate(texts):
            if any(c in text for c in self.special):
                out[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.int32)
        return out


_loaded: dict[str, WordTokenizer] = {}


def _tokenizer(file: str) -> WordTokenizer:
    if file not in _loaded:
        _loaded[file] = WordTokenizer(file)
    return _loaded[file]


def _blocks(docs: DataFrame, file: str, end_id: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, place, number = _tokenizer(file).encode, TaskContext.get().partitionId(), 0
        docs: list[int] = []
        ids: list[np.ndarray] = []
        total = 0
        end = np.array([end_id], np.int32)

        def close() -> pa.RecordBatch:
            block = coder.pack(np.array(docs, np.int64), np.array([len(i) for i in ids], np.int64), np.concatenate(ids))
            columns = [pa.array([place], pa.int32()), pa.array([number], pa.int32()), pa.array([len(docs)], pa.int64()), pa.array([total], pa.int64()), pa.array([block], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["range", "number", "n_docs", "n_ids", "block"])

        for whole in batches:
            for at in range(0, whole.num_rows, 8 * SLICE):
                batch = whole.slice(at, 8 * SLICE)
                for doc, own in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                    docs.append(doc)
                    ids.append(np.concatenate((own, end)))
                    total += len(ids[-1])
                    if total >= BLOCK_IDS:
                        yield close()
                        docs, ids, total, number = [], [], 0, number + 1
        if docs:
            yield close()

    return docs.mapInArrow(run, BLOCKS)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that driver and executors share."""
    ensure_checkpoint_dir(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/quern-{name}-{uuid.uuid4().hex}"


def write(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 1) -> None:
    """Tokenize ``docs`` (doc_id, text) and write their ids, each document's followed by ``end_id``.

    Null texts are empty.  A null doc_id comes first and is kept as the smallest number.  Rows that share a doc_id
    are documents of their own, in the order of their texts.  An empty table makes no blocks.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    _blocks(ordered, tokenizer_file, end_id).write.mode("errorifexists").parquet(path)


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of each document in the files at ``path``."""
    blocks = spark.read.parquet(path)
    sizes = blocks.select("range", "number", "n_ids")
    ranges = sizes.groupBy("range").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("n_ids").over(Window.partitionBy("range").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.withColumn("inside", inside).join(ranges.select("range", before.alias("before")), "range")
    starts = starts.select("range", "number", (F.col("before") + F.col("inside")).alias("begin"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, number, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                docs, counts, ids = coder.unpack(block)
                ends = np.cumsum(counts)
                raw = ids.astype("<u4")
                sums = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                columns = [pa.array(np.full(len(docs), place, np.int32)), pa.array(np.full(len(docs), number, np.int32)), pa.array(docs), pa.array(ends - counts), pa.array(counts), pa.array(sums, pa.int64())]
                names = ["range", "number", "doc_id", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "range int, number int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    found = blocks.select("range", "number", "block").mapInArrow(run, schema).join(starts, ["range", "number"])
    extra = ["ids"] if with_ids else []
    return found.select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), (F.col("begin") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *extra)
