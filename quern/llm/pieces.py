"""SentencePiece encoding to the N best segmentations, and decoding.

The pieces of a public model span a lattice over a text; a segmentation costs the sum of its pieces' costs
(whole micro-nats, from the pieces' ranks by Zipf's law, since a merge model has no probabilities).  Bytes
stand for what no piece covers, so decoding gives back every text exactly.

Forward Viterbi costs are the exact heuristic of a backward A-star search: paths come out in the order of
their cost, and nothing off the N best is completed.  The lattice falls apart where no piece can hold two
adjacent characters (after a run of letters, say); the forward pass of each part keeps its two lowest costs.  A text's N best differ from
the best only in the N - 1 parts whose second segmentation costs least more, so only these are searched.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
import zlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import SLICE

#: Parts that a worker remembers of late, and as many from before.
REMEMBERED = 200_000
UNIT, SHIFT, BYTE_EXTRA = 1_000_000, 2.7, 2.0

Path = tuple[int, tuple[int, ...]]


class Lattice:
    """Pieces with costs, and the segmentations of texts over them."""

    def __init__(self, pieces: dict[str, tuple[int, int]], byte_ids: list[int], byte_cost: int) -> None:
        """pieces: text (with plain spaces) to (id, cost).  byte_ids: the id of each byte."""
        self.pieces, self.byte_ids, self.byte_cost = pieces, byte_ids, byte_cost
        self.longest = max(map(len, pieces), default=1)
        if any(re.search("[^ ] ", p) for p in pieces):
            raise ValueError("a piece goes on after an inner space")
        alone = {c for c in pieces if len(c) == 1}
        never = "".join(sorted({"\n", "\r", "\t"} - {c for p in pieces if len(p) > 1 for c in p}))
        sticky = ""  # letters that a piece holds before something else, as superscripts before a full stop
        while more := {m[0][0] for p in pieces for m in re.finditer(rf"[^\W\d_{sticky}][\W\d_{sticky}]", p)}:
            sticky += "".join(sorted(map(re.escape, more)))
        letter, other = rf"[^\W\d_{sticky}]", rf"(?:[^\w {never}]|[\d_{sticky}])"
        self.chunk = re.compile(rf" *{letter}+| *{other}+{letter}*| +" + (f"|[{never}]" if never else ""))
        self.covered = alone.issuperset
        self.matches = ahocorasick.Automaton()
        for p, (i, cost) in pieces.items():
            self.matches.add_word(p, (len(p), i, cost))
        self.matches.make_automaton()
        self.known: dict[str, tuple[bytes, int]] = {}
        self.before: dict[str, tuple[bytes, int]] = {}
        self.alternatives: dict[tuple[str, int], list[Path]] = {}
        self.decoded = {i: p.encode() for p, (i, _) in pieces.items()} | {i: bytes([b]) for b, i in enumerate(byte_ids)}

    @classmethod
    def load(cls, model_file: str) -> Lattice:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        worst = max([-model.get_score(i) for i in plain if model.get_score(i) > -1e8], default=0.0) + 1
        rank = {i: min(-model.get_score(i), worst) for i in plain}
        total = sum(1 / (r + SHIFT) for r in rank.values())
        cost = lambda r: round(UNIT * math.log((r + SHIFT) * total))
        pieces = {model.id_to_piece(i).replace("▁", " "): (i, cost(rank[i])) for i in plain}
        byte_ids = [i for i in range(size) if model.is_byte(i)]
        return cls(pieces, byte_ids, cost(worst) + round(UNIT * BYTE_EXTRA))

    def edges(self, text: str, end: int) -> Iterator[tuple[int, tuple[int, ...], int]]:
        """(start, ids, cost) of what may come last in text[:end]."""
        one = text[end - 1]
        if one not in self.pieces:
            raw = one.encode("utf-8", "surrogatepass")
            yield end - 1, tuple(self.byte_ids[b] for b in raw), self.byte_cost * len(raw)
        for start in range(max(0, end - self.longest), end):
            if (found := self.pieces.get(text[start:end])) is not None:
                yield start, (found[0],), found[1]

    def forward(self, text: str) -> tuple[list[int], list[int], list[tuple[int, tuple[int, ...]]]]:
        """Lowest cost to each place, second lowest (-1: none), and the last edge of the best way."""
        first, second, back = [0], [-1], [(0, ())]
        pieces, longest = self.pieces, self.longest
        for end in range(1, len(text) + 1):
            best = more = -1
            last: tuple[int, tuple[int, ...]] = (0, ())
            if text[end - 1] not in pieces:
                _, ids, add = next(self.edges(text, end))
                best, last = first[end - 1] + add, (end - 1, ids)
                if second[end - 1] >= 0:
                    more = second[end - 1] + add
            for start in range(end - longest if end > longest else 0, end):
                found = pieces.get(text[start:end])
                if found is None:
                    continue
                c = first[start] + found[1]
                if best < 0 or c < best:
                    best, more, last = c, best if more < 0 or 0 <= best < more else more, (start, found[:1])
                elif more < 0 or c < more:
                    more = c
                if (s := second[start]) >= 0 and (more < 0 or s + found[1] < more):
                    more = s + found[1]
            first.append(best)
            second.append(more)
            back.append(last)
        return first, second, back

    def best(self, part: str) -> tuple[bytes, int]:
        """The best ids of a part (as 32-bit words) and what the second-best segmentation costs more (-1: none)."""
        if not self.covered(part):
            first, second, back = self.forward(part)
            ids: list[int] = []
            end = len(part)
            while end:
                end, last = back[end]
                ids += last[::-1]
            return np.array(ids[::-1], np.int32).tobytes(), second[-1] - first[-1] if second[-1] >= 0 else -1
        n, none = len(part), 1 << 62
        first, second, came = [0] + [none] * n, [none] * (n + 1), [(0, 0)] * (n + 1)
        for end, (size, piece, cost) in self.matches.iter(part):
            end += 1
            start = end - size
            c, best = first[start] + cost, first[end]
            if c < best:
                first[end], came[end] = c, (size, piece)
                c = best
            s = second[start] + cost
            if s < c:
                c = s
            if c < second[end]:
                second[end] = c
        ids, end = [], n
        while end:
            size, piece = came[end]
            ids.append(piece)
            end -= size
        return array("i", ids[::-1]).tobytes(), second[n] - first[n] if second[n] < none else -1

    def n_best(self, text: str, n: int) -> list[Path]:
        """The ``n`` cheapest segmentations, by backward A-star search; of equal ones the first that was reached."""
        first = self.forward(text)[0]
        order = itertools.count()
        heap: list[tuple] = [(first[-1], next(order), len(text), 0, None)]
        out: list[Path] = []
        while heap and len(out) < n:
            total, _, end, cost, way = heapq.heappop(heap)
            if end == 0:
                ids: list[int] = []
                while way is not None:
                    ids += way[0]
                    way = way[1]
                out.append((total, tuple(ids)))
                continue
            for start, last, add in self.edges(text, end):
                heapq.heappush(heap, (cost + add + first[start], next(order), start, cost + add, (last, way)))
        return out

    def _chunk(self, chunk: str) -> tuple[bytes, int]:
        if len(self.known) >= REMEMBERED:
            self.known, self.before = {}, self.known
        out = self.known[chunk] = self.before.get(chunk) or self.best(chunk)
        return out

    def _search(self, part: str, n: int) -> list[Path]:
        key = (part, n)
        if (found := self.alternatives.get(key)) is None:
            if len(self.alternatives) >= REMEMBERED // 10:
                self.alternatives.clear()
            found = self.alternatives[key] = self.n_best(part, n)
        return found

    def encode(self, text: str, n: int = 1) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """The best ids, and for n > 1 the n best as (cost above the best, ids)."""
        chunks = self.chunk.findall(" " + text)
        remembered, new = self.known.get, self._chunk
        found = [remembered(c) or new(c) for c in chunks]
        ids = np.frombuffer(b"".join([f[0] for f in found]), np.int32)
        if n == 1:
            return ids, [(0, ids)]
        gaps = np.fromiter([f[1] for f in found], np.int64, len(found))
        some = np.nonzero(gaps >= 0)[0]
        if len(some) > n - 1:  # the smallest gaps, the earliest of equal ones
            most = np.partition(gaps[some], n - 2)[n - 2]
            some = np.concatenate((some[gaps[some] < most], some[gaps[some] == most]))[: n - 1]
        ends = np.cumsum(np.fromiter([len(f[0]) // 4 for f in found], np.int64, len(found)))
        options = [(int(gaps[k]), int(ends[k]) - len(found[k][0]) // 4, chunks[k], len(found[k][0]) // 4) for k in some.tolist()]
        options.sort()
        choices = []
        for _, at, part, size in options:
            paths = self._search(part, n)
            choices.append([(cost - paths[0][0], at, size, own) for cost, own in paths])
        ways: list[tuple[int, tuple[int, ...]]] = [(0, ())]
        for paths in choices:  # the n best sums so far; of equal ones the first
            ways = sorted((more + path[0], (*way, k)) for more, way in ways for k, path in enumerate(paths))[:n]
        out = []
        for more, way in ways:
            pieces, at = [], 0
            for _, start, size, own in sorted([paths[k] for paths, k in zip(choices, way, strict=True)], key=lambda c: c[1]):
                pieces += [ids[at:start], np.array(own, np.int32)]
                at = start + size
            out.append((more, np.concatenate([*pieces, ids[at:]])))
        return out[0][1], out

    def decode(self, ids: np.ndarray) -> bytes:
        """The text (UTF-8) whose segmentation ``ids`` is."""
        return b"".join(map(self.decoded.__getitem__, ids.tolist()))[1:]


_loaded: dict[str, Lattice] = {}


def _lattice(model_file: str) -> Lattice:
    if model_file not in _loaded:
        _loaded[model_file] = Lattice.load(model_file)
    return _loaded[model_file]


def encode(docs: DataFrame, model_file: str, n_best: int = 4, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, extra_costs, nbest_crc32, round_trip[, ids]) of each row.

    extra_costs: what each of the ``n_best`` segmentations costs more than the best, in micro-nats, ascending
    (fewer where the text has fewer).  nbest_crc32: a checksum of each one's ids (32-bit little endian).
    round_trip: the ids, decoded, are the text.  A null text is empty; an empty text has the segmentation of the
    leading space alone.  Repeated rows get a row each; other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(model_file)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                rows, flat = [], []
                for text in batch.column(1).to_pylist():
                    text = text or ""
                    ids, best = lattice.encode(text, n_best)
                    sums = [zlib.crc32(own.astype("<i4").tobytes()) for _, own in best]
                    rows.append((len(ids), sums[0], [more for more, _ in best], sums, lattice.decode(ids) == text.encode("utf-8", "surrogatepass")))
                    if with_ids:
                        flat.append(ids)
                n, crc, costs, crcs, same = zip(*rows, strict=True)
                lists = pa.list_(pa.int64())
                columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(costs, lists), pa.array(crcs, lists), pa.array(same)]
                names = ["doc_id", "n_pieces", "ids_crc32", "extra_costs", "nbest_crc32", "round_trip"]
                if with_ids:
                    offsets = pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(flat))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, n_pieces long, ids_crc32 long, extra_costs array<long>, nbest_crc32 array<long>, round_trip boolean"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema + ", ids array<int>" * with_ids)
