"""Best-fit packing of token pieces into sequences under several capacities at once.

Only documents longer than a sequence are cut. A piece of one length is like any other of that length, so the packing
is decided on the histogram of lengths (at most `capacity` entries, whatever the corpus) and laid out as intervals:
"of length L, the pieces with ranks r0..r0+k go to consecutive sequences from s, at offset o". Every piece has a rank
within its length, counted where it was made and completed by a prefix sum over tasks, and finds its interval by
binary search. So all pieces take part in one global packing, no piece is moved for it and nothing is capped.

A bin's residual is a vector: tokens, documents and attention cost (the sum of squared piece lengths). A piece goes
only where it fits in every dimension; among those bins the residual norm after placing it (each dimension as a share
of its capacity, weighted) is least, or the weighted dot product of piece and residual is greatest.

Null and empty texts have one token, the end. Repeated rows, and rows with one key, are packed each; among pieces of
one length any may go to any of their places. An empty table gives an empty result. Columns other than key and text
are ignored. A very long text is tokenized alone and cut: a task holds its words and ids at once, some twenty bytes for
each of its own.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gantry.llm.common import by_bytes, durable, give_back, key_and_text, shelf
from gantry.llm.words import index_words, joined

#: Words whose ids a worker keeps, and the longest word kept.
CACHED_WORDS, CACHED_BYTES = 500_000, 64
#: Bytes of text that are tokenized at once: more of them repeat more words, and take more memory.
TEXT_BYTES = 8 << 20


@dataclass(frozen=True)
class Capacity:
    """Limits of a sequence, and the weight of each in the score. The defaults bind on tokens alone."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.0, 0.001)
    score: str = "norm"

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], np.int64)


def need_of(length: int) -> np.ndarray:
    return np.array([length, 1, length * length], np.int64)


def plan(histogram: dict[int, int], cap: Capacity = Capacity()) -> dict[str, np.ndarray]:
    """Places every piece of the histogram, longest first; returns intervals sorted by (length, rank).

    Bins with equal residuals are one group. Pieces of one length fill the best group bin by bin, as a bin that has
    just taken one is at least as good for the next while it fits.
    """
    limits, weights = cap.limits(), np.array(cap.weights)
    residual = np.zeros((64, 3), np.int64)  # a row for each group of bins, grown by doubling
    first, bins = np.zeros(64, np.int64), np.zeros(64, np.int64)
    used = opened = 0
    out: list[tuple[int, int, int, int, int]] = []  # length, rank, bins, first bin, offset in tokens

    def add(left: np.ndarray, at: int, n: int) -> None:
        nonlocal residual, first, bins, used
        if n == 0 or left[0] == 0 or left[1] == 0:
            return
        if used == len(bins):
            residual, first, bins = np.vstack([residual, np.zeros_like(residual)]), np.append(first, np.zeros_like(first)), np.append(bins, np.zeros_like(bins))
        residual[used], first[used], bins[used] = left, at, n
        used += 1

    def fill(left: np.ndarray, at: int, n: int, length: int, rank: int, count: int) -> int:
        """Puts up to `count` pieces into n bins from `at` that have `left`; returns how many."""
        need = need_of(length)
        each = int((left // need).min())
        whole = min(n, count // each)
        for k in range(each if whole else 0):
            out.append((length, rank + k * whole, whole, at, int(limits[0] - left[0]) + k * length))
        add(left - each * need, at, whole)
        done = whole * each
        part = min(count - done, each) if whole < n else 0
        for k in range(part):
            out.append((length, rank + done + k, 1, at + whole, int(limits[0] - left[0]) + k * length))
        if part:
            add(left - part * need, at + whole, 1)
        add(left, at + whole + (part > 0), n - whole - (part > 0))
        return done + part

    for length in sorted(histogram, reverse=True):
        need, count, rank = need_of(length), histogram[length], 0
        while rank < count:
            fits = np.flatnonzero((bins[:used] > 0) & (residual[:used] >= need).all(axis=1))
            if len(fits):
                left = residual[fits]
                if cap.score == "dot":
                    merit = -(weights * (left / limits) * (need / limits)).sum(axis=1)
                else:
                    merit = (weights * ((left - need) / limits) ** 2).sum(axis=1)
                best = int(fits[np.lexsort((first[fits], merit))[0]])
                at, n, room = int(first[best]), int(bins[best]), residual[best].copy()
                bins[best] = 0
                rank += fill(room, at, n, length, rank, count - rank)
            else:
                each = int((limits // need).min())
                n = -(-(count - rank) // each)
                opened += n
                rank += fill(limits.copy(), opened - n, n, length, rank, count - rank)
        if used > 256 and (bins[:used] > 0).sum() < used // 2:
            live = np.flatnonzero(bins[:used] > 0)
            residual[: len(live)], first[: len(live)], bins[: len(live)] = residual[live], first[live], bins[live]
            bins[len(live) : used] = 0
            used = len(live)
    table = np.array(sorted(out), np.int64).reshape(-1, 5)
    return {"length": table[:, 0], "rank": table[:, 1], "bins": table[:, 2], "first": table[:, 3], "offset": table[:, 4], "sequences": np.array(opened)}


def place(layout: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of pieces by binary search in the intervals."""
    big = np.int64(1) << np.int64(48)
    at = np.searchsorted(layout["length"] * big + layout["rank"], length * big + rank, "right") - 1
    return layout["first"][at] + rank - layout["rank"][at], layout["offset"][at]


class WordTokenizer:
    """Ids of whole texts, word by word: the tokenizer splits on white space before anything else, so words are apart.

    Most words are letters with or without closing points and commas. Their letters are one unit to the tokenizer, in
    either case of A-Z, so distinct ones are encoded many to a string and cut where a piece ends a unit; all other
    words are encoded singly. Ids of words are kept for the worker's later tasks, in two generations of CACHED_WORDS.
    A special token's name in a text is that token, as the tokenizer takes it by itself; with `literal` it is mere text.
    """

    TAIL = b".,;:!?"

    def __init__(self, path: str, literal: bool = False) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.of = Tokenizer.from_file(path)
        self.of.encode_special_tokens = literal
        ends = {i for piece, i in self.of.get_vocab().items() if piece.endswith("</w>")}
        self.ends = np.zeros(self.of.get_vocab_size(), bool)
        self.ends[list(ends)] = True
        self.most = CACHED_WORDS
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    @staticmethod
    def kept(path: str, literal: bool = False) -> WordTokenizer:
        """That of this worker process, if an earlier task has made one."""
        found = shelf("word_tokenizers")
        if (path, literal) not in found:
            found[path, literal] = WordTokenizer(path, literal)
        return found[path, literal]

    def _singly(self, words: list[bytes]) -> dict[bytes, bytes]:
        out = {}
        for i in range(0, len(words), 4096):
            part = words[i : i + 4096]
            made = self.of.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            out.update((w, array("I", e.ids).tobytes()) for w, e in zip(part, made, strict=True))
        return out

    def _units(self, units: list[bytes]) -> dict[bytes, bytes]:
        """Ids of runs of letters, many to a string."""
        out = {}
        for i in range(0, len(units), 1 << 15):
            part = units[i : i + (1 << 15)]
            lines = [part[k : k + 256] for k in range(0, len(part), 256)]
            for line, e in zip(lines, self.of.encode_batch_fast([b" ".join(x).decode() for x in lines], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, "<u4")
                past = (np.flatnonzero(self.ends[ids]) + 1) * 4
                if len(past) != len(line):  # not one unit a word after all
                    out.update(self._singly(line))
                    continue
                raw, at = ids.tobytes(), 0
                for x, z in zip(line, past.tolist(), strict=True):
                    out[x] = raw[at:z]
                    at = z
        return out

    def learn(self, new: set[bytes]) -> dict[bytes, bytes]:
        split, other, units = [], [], set()
        for w in new:
            core = w.lower().rstrip(self.TAIL)
            if (core.isalpha() or core.decode().isalpha()) and len(w) <= CACHED_BYTES:
                split.append((w, core, w[len(core) :]))
                units.add(core)
            else:
                other.append(w)
        out = self._singly(other)
        # letters alone are a word too, and may be known as one
        ids = {c: (self.known.get(c) or self.older.get(c)) for c in units}
        ids |= self._units([c for c, x in ids.items() if x is None])
        tails = {b"": b""} | self._singly(list({tail for *_, tail in split} - {b""}))
        for w, core, tail in split:
            out[w] = ids[core] + tails[tail]
        return out

    def encode_all(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one behind the other, bounds of each row's) of a string column without nulls."""
        kinds, of, bounds = index_words(column)
        if len(self.known) > self.most:
            self.known, self.older = {}, self.known
        known = self.known
        new = set(kinds).difference(known)
        again = new.intersection(self.older)
        known.update((w, self.older[w]) for w in again)
        made = self.learn(new - again)
        known.update(made)
        ids, upto = joined([known[w] for w in kinds], of)
        for w in made:
            if len(w) > CACHED_BYTES:
                del known[w]
        return ids, upto[bounds]


def pieces(docs: DataFrame, tokenizer: str, capacity: int, key: str = "doc_id", text: str = "text", text_bytes: int = TEXT_BYTES, cached: int = CACHED_WORDS) -> DataFrame:
    """(key, piece, start, length, ids_crc32, part, rank): documents as ids, an end id 0, cut at every `capacity` tokens.

    rank counts the pieces of one length within the task `part`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        words, part, seen = WordTokenizer.kept(tokenizer), TaskContext.get().partitionId(), {}
        words.most = cached
        for b in (x for whole in batches for x in by_bytes([whole], "text", text_bytes)):
            at, rows = [], []
            ids, bounds = words.encode_all(b.column("text"))
            for k, (a, z) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                own = ids[a:z].tobytes() + b"\0\0\0\0"
                for n, i in enumerate(range(0, len(own), 4 * capacity)):
                    piece = own[i : i + 4 * capacity]
                    size = len(piece) // 4
                    seen[size] = rank = seen.get(size, -1) + 1
                    at.append(k)
                    rows.append((n, i // 4, size, zlib.crc32(piece), rank))
            if rows:
                made = np.array(rows, np.int64)
                columns = [b.column("key").take(pa.array(at)), pa.array(made[:, 0], pa.int32()), *[pa.array(made[:, k]) for k in (1, 2, 3)], pa.array(np.full(len(rows), part, np.int32)), pa.array(made[:, 4])]
                yield pa.record_batch(columns, ["key", "piece", "start", "length", "ids_crc32", "part", "rank"])

    kind = docs.schema[key].dataType.simpleString()
    return key_and_text(docs, key, text).mapInArrow(run, f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint")


def pack(docs: DataFrame, tokenizer: str, cap: Capacity = Capacity(), key: str = "doc_id", text: str = "text", text_bytes: int = TEXT_BYTES, cached: int = CACHED_WORDS) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each row."""
    made = durable(pieces(docs, tokenizer, cap.tokens, key, text, text_bytes, cached), "pieces")
    counts = made.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    layout = plan(histogram, cap)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = counts.select(F.col("part").alias("in_part"), F.col("length").alias("of_length"), before.alias("before"))
    ranked = made.join(base, (made["part"] == base["in_part"]) & (made["length"] == base["of_length"]))
    ranked = ranked.select("key", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = place(layout, b.column("length").to_numpy(), b.column("rank").to_numpy())
            yield pa.record_batch([*b.columns[:5], pa.array(sequence), pa.array(offset)], ["key", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = docs.schema[key].dataType.simpleString()
    out = ranked.mapInArrow(run, f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
    return out.withColumnRenamed("key", key)
