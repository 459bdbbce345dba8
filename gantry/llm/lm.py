"""LM scoring: counts of all training documents and a gated recurrent model over them, applied to whole documents.

1. Word counts of every training document, combined in each task before the shuffle.
2. The words of the highest counts (HEAD_WORDS of up to HEAD_BYTES and LONG_WORDS of up to LONG_BYTES at most, so a
   proven bound) go to the tasks with their counts. All other words are looked up by a join on the word; a word longer
   than that, or one common in held-out texts alone, may be hot there, and adaptive execution splits it.
3. Groups of rarer words: a mixture of byte-pair models over those words with their counts in all training documents; a
   Bayes rule over byte pairs then gives any word a group, seen or not.
4. Each text is turned once into the model's tokens, two bytes each; rounds and scores read those, not the texts.
5. The recurrent model: outputs begin at the counts, other weights at random. Every task goes over its training documents by
   truncated backpropagation, and the tasks' changes are averaged by their tokens, in two rounds: an eighth of the documents
   (by hash) in small steps of a high rate, then all others in large ones of a low rate. So each is learnt from once, and no
   document is left out. Tables of few tokens are gone over up to EXTRA_PASSES times before.
6. Scores: P(class | state) and, of frequent words, P(word | class, state) from the model with its state carried over the
   whole document; within a group (count + 1) / (count of the group + words in it + 1).

A text is words and one end, which is a token. Null and empty texts are an end alone. A null key counts as the text ''
in the split, and others go by their text in Spark's cast. Repeated rows, and rows with one key, are scored each, and
learnt from each; ties of counts go by the word. Without training documents all counts are 0. An empty table gives an
empty result. Columns other than key and text are ignored. A very long text is scored whole, beside others or alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gantry.llm import gru
from gantry.llm.common import by_bytes, durable, key_and_text
from gantry.llm.words import buffers, index_words

#: Most words, and bytes in one, that tasks get with their counts; most that the model has as outputs of their own.
HEAD_WORDS, HEAD_BYTES, MODEL_WORDS = 1 << 17, 48, 1024
LONG_WORDS, LONG_BYTES = 1 << 12, 1024
GROUPS, HIDDEN, FOLDS, HELD_OUT = 8, 16, 7, 2
#: The model's numbers of tokens, as written: MODEL_WORDS + GROUPS of them.
TOKEN = np.dtype("<u2")
#: Of so many training documents one is learnt from in the first round, the others in the second.
FIRST_OF = 8
#: Tables of fewer tokens than this are gone over as often as comes to it, but not more often than this, before the two rounds.
FEW_TOKENS, EXTRA_PASSES = 2_000_000, 4
#: Tokens after which the state begins anew while learning (never while scoring).
SPAN = 1024
#: Characters of one text that seed_texts() shows.
WARM_CHARS = 20_000
#: Bytes of tokens that a task scores or learns from side by side; one longer text stands alone.
SIDE_BY_SIDE = 3 << 20
#: Words that a task counts before it passes them on, and floats in one row of weights.
COUNTED_WORDS, WEIGHTS_IN_ROW = 300_000, 1 << 14
#: Changes of weights that are added in one group, and steps of such groups: more than any job has tasks.
TASKS_A_STEP, ADDING_STEPS = 256, 4


def held_out(key: Column) -> Column:
    """Whether a row is kept out of learning."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == HELD_OUT


def seed_texts(plain: DataFrame, rows: int, chars: int = WARM_CHARS) -> list[str]:
    """Texts, or spans of long ones, of the `rows` training documents with the least hashes: a look at a table; score() does not use it."""
    total = plain.count()
    at = plain.where("NOT held").select(F.xxhash64("key", "text").alias("at"), "text")
    if total > 4 * rows:
        at = at.where(F.col("at") <= -(1 << 63) + int((1 << 64) * (4 * rows / total)))
    span = F.substring("text", F.lit(1) + F.pmod("at", F.greatest(F.length("text") - chars + 1, F.lit(1))).cast("int"), F.lit(chars))
    return [r["text"] for r in at.select("at", span.alias("text")).orderBy("at", "text").limit(rows).collect()]


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over the training documents of (text, held); the end has the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, int] = {}

        def made() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

        for b in (x for whole in batches for x in by_bytes([whole], "text")):
            learnt = b.column("text").filter(pa.compute.invert(b.column("held")))
            kinds, of, _ = index_words(learnt, lower=True)
            for word, n in zip(kinds, np.bincount(of, minlength=len(kinds)).tolist(), strict=True):
                found[word] = found.get(word, 0) + n
            if len(learnt):
                found[b""] = found.get(b"", 0) + len(learnt)
            if len(found) > COUNTED_WORDS:
                yield made()
                found.clear()
        yield made()

    return docs.mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Words:
    """Frequent words with their counts, and the groups of others."""

    words: list[bytes]  # by count, then word; the end is no part of it
    counts: np.ndarray
    ends: int
    pairs: np.ndarray | None = None  # (65536, groups): log probability of a byte pair in a group
    prior: np.ndarray | None = None
    head_group: np.ndarray | None = None
    group_counts: np.ndarray | None = None  # of each group: its words in training documents
    norm: np.ndarray | None = None  # of each group: log10 of its count + words + 1

    @property
    def modelled(self) -> int:
        """Words of the model's own, the end among them."""
        return min(MODEL_WORDS, len(self.words) + 1)

    def group_of(self, words: list[bytes]) -> np.ndarray:
        """The likeliest group by byte pairs, the word between two spaces."""
        if not words:
            return np.zeros(0, np.int64)
        out = []
        for i in range(0, len(words), 1 << 16):
            part = words[i : i + (1 << 16)]
            line = np.frombuffer(b" " + b" ".join(part) + b" ", np.uint8).astype(np.int32)
            score = self.pairs[line[:-1] * 256 + line[1:]]
            sizes = np.fromiter(map(len, part), np.int64, len(part)) + 1
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            out.append((np.add.reduceat(score, starts, axis=0) + self.prior).argmax(axis=1))
        return np.concatenate(out)


def frequent(counts: DataFrame) -> Words:
    """The words above the least count at which there are at most HEAD_WORDS (LONG_WORDS of long ones), by histograms of counts."""
    bytes_, level = F.length("word"), F.floor(F.log2("n") * 16)
    near = counts.where((bytes_ > 0) & (bytes_ <= LONG_BYTES)).withColumns({"long": bytes_ > HEAD_BYTES, "level": level})
    rows = near.groupBy("long", "level").count().orderBy(F.desc("level")).collect()
    got: list[tuple[int, bytes]] = []
    for long, most in ((False, HEAD_WORDS), (True, LONG_WORDS)):
        least, total = None, 0
        for r in rows:
            total += r["count"] if r["long"] == long else 0
            if total > most:
                break
            least = r["level"]
        if least is not None:
            head = near.where((F.col("long") == long) & (F.col("level") >= least)).select("word", "n").toArrow()
            got += zip(head["n"].to_pylist(), head["word"].to_pylist(), strict=True)
    got.sort(key=lambda x: (-x[0], x[1]))
    ends = counts.where(F.length("word") == 0).agg(F.sum("n")).first()[0] or 0
    return Words([w for _, w in got], np.array([n for n, _ in got], np.int64), ends)


class Encoder:
    """Texts as ranks of frequent words, tokens of the model, and the words that are not frequent."""

    def __init__(self, w: Words) -> None:
        self.w = w
        self.rank = dict(zip(w.words, range(len(w.words)), strict=True))
        own = np.arange(1, len(w.words) + 1)
        self.token = np.where(own < w.modelled, own, w.modelled + w.head_group) if w.head_group is not None else own

    def __call__(self, column: pa.Array) -> Encoded:
        """Each text's words, then an end, of rank -2 and token 0."""
        kinds, of, bounds = index_words(column, lower=True)
        n = len(column)
        rank_of = np.fromiter(map(self.rank.get, kinds, repeat(-1)), np.int32, len(kinds))
        far = np.flatnonzero(rank_of < 0)
        token_of = np.zeros(len(kinds), np.int32)
        token_of[rank_of >= 0] = self.token[rank_of[rank_of >= 0]]
        words = [kinds[i] for i in far.tolist()]
        token_of[far] = self.w.modelled + self.w.group_of(words)
        row = np.repeat(np.arange(n), np.diff(bounds))
        rank, token = np.full(len(of) + n, -2, np.int32), np.zeros(len(of) + n, np.int32)
        at = np.arange(len(of)) + row
        rank[at], token[at] = rank_of[of], token_of[of]
        number = np.full(len(kinds), -1, np.int64)
        number[far] = np.arange(len(far))
        number = number[of]
        is_far = number >= 0
        pair, times = np.unique(row[is_far] * max(1, len(far)) + number[is_far], return_counts=True)
        return Encoded(token, rank, bounds[:-1] + np.arange(n), np.diff(bounds) + 1, words, pair // max(1, len(far)), pair % max(1, len(far)), times)


@dataclass
class Encoded:
    token: np.ndarray
    rank: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    far: list[bytes]  # words that are not frequent; then (row, number among them, times) of each in each text
    far_row: np.ndarray
    far_word: np.ndarray
    far_times: np.ndarray


def fit_groups(w: Words, groups: int = GROUPS, rounds: int = 12) -> np.ndarray:
    """Sets pairs, prior and head_group; returns the group of each of the model's own words.

    A mixture of byte-pair models over all words that tasks get, each with its count in all training documents, by
    expectation and maximisation; the first shares are drawn with a fixed seed.
    """
    w.pairs, w.prior = np.zeros((65536, groups), np.float32), np.zeros(groups, np.float32)
    if w.words:
        line = np.frombuffer(b" " + b" ".join(w.words) + b" ", np.uint8).astype(np.int32)
        pair = line[:-1] * 256 + line[1:]
        sizes = np.fromiter(map(len, w.words), np.int64, len(w.words)) + 1
        starts = np.cumsum(sizes) - sizes
        kinds, pair = np.unique(pair, return_inverse=True)
        weight = np.sqrt(w.counts).astype(np.float32)  # else a few words would be all there is to tell groups by
        share = np.random.default_rng(1).dirichlet(np.ones(groups), len(w.words)).astype(np.float32)
        for k in range(rounds):
            own = share * weight[:, None]
            prior = own.sum(axis=0) + 1
            table = np.stack([np.bincount(pair, weights=np.repeat(own[:, g], sizes), minlength=len(kinds)) for g in range(groups)], axis=1)
            total = table.sum(axis=0) + 0.05 * 65536
            known, other = np.log((table + 0.05) / total).astype(np.float32), np.log(0.05 / total).astype(np.float32)
            if k + 1 < rounds:
                score = np.add.reduceat(known[pair], starts, axis=0) + np.log(prior / prior.sum()).astype(np.float32)
                score -= score.max(axis=1, keepdims=True)
                share = np.exp(score)
                share /= share.sum(axis=1, keepdims=True)
        w.pairs[:] = other
        w.pairs[kinds] = known
        w.prior[:] = np.log(prior / prior.sum())
    w.head_group = w.group_of(w.words)
    return w.head_group[: w.modelled - 1]


def set_norms(w: Words, counts: DataFrame) -> None:
    """Of each group: its words' counts, and how many words it has, over the whole vocabulary."""
    own = set(w.words[: w.modelled - 1]) | {b""}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kinds = np.zeros(GROUPS, np.int64), np.zeros(GROUPS, np.int64)
        for b in batches:
            words, n = b.column("word").to_pylist(), b.column("n").to_numpy()
            rare = np.array([x not in own for x in words], bool)
            if rare.any():
                of = w.group_of([x for x, r in zip(words, rare.tolist(), strict=True) if r])
                total += np.bincount(of, weights=n[rare], minlength=GROUPS).astype(np.int64)
                kinds += np.bincount(of, minlength=GROUPS)
        yield pa.record_batch([pa.array(range(GROUPS), pa.int32()), pa.array(total), pa.array(kinds)], ["g", "n", "kinds"])

    rows = {r["g"]: r for r in counts.mapInArrow(run, "g int, n bigint, kinds bigint").groupBy("g").agg(F.sum("n").alias("n"), F.sum("kinds").alias("kinds")).collect()}
    w.group_counts = np.array([rows[g]["n"] if g in rows else 0 for g in range(GROUPS)], np.int64)
    w.norm = np.log10(np.array([rows[g]["n"] + rows[g]["kinds"] + 1 if g in rows else 1 for g in range(GROUPS)], np.float64))


def side_by_side(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, their tokens, where each text begins, its tokens' number) of about SIDE_BY_SIDE bytes of tokens, in the column text."""

    def made() -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
        rows = pa.Table.from_batches(held)
        found = [buffers(c) for c in rows.column("text").chunks]
        sizes = np.concatenate([np.diff(bounds) for _, bounds in found]) // TOKEN.itemsize
        return rows, np.concatenate([raw for raw, _ in found]).view(TOKEN).astype(np.int32), np.cumsum(sizes) - sizes, sizes

    held, size = [], 0
    for part in (x for b in batches for x in by_bytes([b], "text", SIDE_BY_SIDE)):
        if size and size + part.column("text").nbytes > SIDE_BY_SIDE:
            yield made()
            held, size = [], 0
        held.append(part)
        size += part.column("text").nbytes
    if held:
        yield made()


def encoded(plain: DataFrame, w: Words, all_norm: float) -> DataFrame:
    """(key, row, held, n_tokens, known, base, rare, far, text) of (key, text, held), written once: what scores need besides the model.

    The new text is the model's numbers of the tokens; base is the base score, and rare the log10 probability of words in
    their groups, both without the words in far (word, times), whose counts come from a join.
    """
    ends, modelled = w.ends, w.modelled

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, encoder = TaskContext.get().partitionId() << 40, Encoder(w)
        logc = np.append(np.log10(w.counts + 1.0), [np.log10(ends + 1.0), 0.0])  # by rank: -2 an end, -1 to come from the join
        known = np.append(np.ones(len(w.counts), np.int64), [int(ends > 0), 0])
        norm = np.append(np.zeros(modelled), w.norm)
        for part in (x for b in batches for x in by_bytes([b], "text")):
            if not part.num_rows:
                continue
            e = encoder(part.column("text"))
            base = logc[e.rank]
            rare = np.where(e.token >= modelled, base - norm[e.token], 0.0)
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(e.far_row, minlength=len(e.sizes)))]), pa.int32())
            inner = pa.StructArray.from_arrays([pa.array(e.far, pa.binary()).take(pa.array(e.far_word)), pa.array(e.far_times, pa.int32())], ["word", "times"])
            bounds = np.append(e.starts, len(e.token)).astype(np.int32) * TOKEN.itemsize
            columns = [
                part.column("key"), pa.array(np.arange(len(e.sizes)) + row), part.column("held"), pa.array(e.sizes), pa.array(np.add.reduceat(known[e.rank], e.starts)),
                pa.array(np.add.reduceat(base, e.starts) - e.sizes * all_norm), pa.array(np.add.reduceat(rare, e.starts)), pa.ListArray.from_arrays(offsets, inner),
                pa.Array.from_buffers(pa.binary(), len(e.sizes), [None, pa.py_buffer(bounds), pa.py_buffer(e.token.astype(TOKEN))]),
            ]
            row += len(e.sizes)
            names = ["key", "row", "held", "n_tokens", "known", "base", "rare", "far", "text"]
            yield from pa.Table.from_arrays(columns, names).to_batches(max_chunksize=5000)

    shape = "row bigint, held boolean, n_tokens bigint, known bigint, base double, rare double, far array<struct<word:binary,times:int>>, text binary"
    return durable(plain.mapInArrow(run, f"key {plain.schema['key'].dataType.simpleString()}, {shape}"), "tokens")


def first_model(w: Words, groups: np.ndarray) -> gru.Model:
    """Classes of words that share a group, in the order of their counts; outputs begin at the counts, other weights at random ones of a fixed seed."""
    m = gru.Model(w.modelled, GROUPS, HIDDEN)
    order = np.concatenate([[0], 1 + np.lexsort((np.arange(len(groups)), groups))])
    slot = np.empty(w.modelled, np.int64)
    slot[order] = np.arange(w.modelled)
    m.set_slots(slot)
    unigram = np.concatenate([[w.ends], w.counts[: w.modelled - 1], w.group_counts]) + 0.5
    p = m.views(m.flat)
    p["bw"][m.slot] = np.log(unigram[: m.words])
    p["bc"][...] = np.log(np.bincount(m.class_of(np.arange(len(unigram))), weights=unigram, minlength=len(p["bc"])))
    p["bc"] -= p["bc"].max()
    p["bw"][m.slot] -= p["bw"][m.slot].max()
    return m


def learn(docs: DataFrame, w: Words, m: gru.Model, small: bool) -> gru.Model:
    """One pass of every task over all its documents (text, as tokens), from m's weights, in small or large steps; changes averaged by tokens, in a tree of steps. Words are in the tokens already, so w is not read."""
    rate, lanes = (0.03, 128) if small else (0.008, 512)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = gru.Model(m.words, m.groups, m.hidden), 0
        own.flat[:] = m.flat
        own.set_slots(m.slot)
        optimizer = gru.Adam(len(own.flat), rate, 0.01 if small else 0.0)
        for _, tokens, starts, sizes in side_by_side(batches):
            seen += gru.train(own, tokens, starts, sizes, optimizer, most=lanes, steps=32 if small else 64, span=SPAN)[1]
        if seen:
            change = (own.flat - m.flat).astype(np.float64) * seen
            parts = [change[i : i + WEIGHTS_IN_ROW].astype(np.float32).tobytes() for i in range(0, len(change), WEIGHTS_IN_ROW)]
            step = TaskContext.get().partitionId() // TASKS_A_STEP
            yield pa.record_batch([pa.array(range(len(parts)), pa.int32()), pa.array([step] * len(parts), pa.int32()), pa.array([seen] * len(parts), pa.int64()), pa.array(parts, pa.binary())], ["part", "step", "seen", "change"])

    def add(t: pa.Table) -> pa.Table:
        step = t.column("step")[0].as_py() // TASKS_A_STEP
        total = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in t.column("change"))
        return pa.table({"part": t.column("part")[:1], "step": pa.array([step], pa.int32()), "seen": pa.array([sum(t.column("seen").to_pylist())], pa.int64()), "change": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    shape = "part int, step int, seen bigint, change binary"
    sums = docs.select("text").mapInArrow(run, shape)
    for _ in range(ADDING_STEPS):
        sums = sums.groupBy("part", "step").applyInArrow(add, shape)
    flat = m.flat.copy()
    for r in sums.collect():  # one row for each WEIGHTS_IN_ROW weights
        x = np.frombuffer(r["change"], np.float32) / np.float32(max(1, r["seen"]))
        flat[r["part"] * WEIGHTS_IN_ROW :][: len(x)] += x
    m.flat[:] = flat
    m.set_slots(m.slot)
    return m


def learnt(docs: DataFrame, w: Words, m: gru.Model, tokens: int) -> gru.Model:
    """The model after all rounds over the training documents of (key, text, held); there are so many tokens in them."""
    training = docs.where("NOT held")
    for _ in range(min(EXTRA_PASSES, FEW_TOKENS // max(1, tokens))):
        m = learn(training, w, m, small=True)
    first = F.pmod(F.xxhash64("key", "text"), F.lit(FIRST_OF)) == 0
    m = learn(training.where(first), w, m, small=True)
    return learn(training.where(~first), w, m, small=False)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row."""
    plain = key_and_text(docs, key, text).withColumn("held", held_out(F.col("key")))
    counts = durable(count_words(plain), "word-counts")
    tokens, vocabulary = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    w = frequent(counts)
    groups = fit_groups(w)
    set_norms(w, counts)
    texts = encoded(plain, w, float(np.log10(tokens + vocabulary + 1)))
    m = learnt(texts, w, first_model(w, groups), tokens)
    log10e = float(np.log10(np.e))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, token, starts, sizes in side_by_side(batches):
            model = np.add.reduceat((gru.score(m, token, starts, sizes) * log10e).astype(np.float64), starts)
            yield from rows.drop_columns(["text"]).append_column("model", pa.array(model)).to_batches()

    own = texts.drop("far")
    made = durable(own.mapInArrow(run, StructType([x for x in own.schema if x.name != "text"]).add("model", "double")), "scores")
    far = texts.select("row", F.explode("far").alias("f")).select(F.col("row").alias("far_row"), F.col("f.word").alias("far_word"), F.col("f.times").alias("times"))
    found = far.join(counts, far["far_word"] == counts["word"]).groupBy("far_row")
    found = found.agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"), F.sum("times").alias("more_known"))
    out = made.join(found, made["row"] == found["far_row"], "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select(
        F.col("key").alias(key), F.col("held").alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(tokens)).cast("bigint").alias("train_tokens"), (F.col("base") + more).alias("base_score"), (F.col("model") + F.col("rare") + more).alias("score"),
    )
