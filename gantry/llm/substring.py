"""Substring dedup by content-defined chunking with a gear rolling hash.

A text is cut before a word where the gear hash of the WINDOW bytes up to it falls under a threshold, so the cuts
depend on the bytes around them alone and an insertion moves no cut beyond its window; and before every word that has
no such cut at itself and the MOST_WORDS words before it, so that a text of one word over and over has cuts too. A chunk begins at every cut and
ends at the first cut from which it has `min_words` words or more, so chunks overlap: a passage is found from its first
cut to its last, and nothing shorter than `min_words` words in one piece counts as repeated. Chunks with equal digests of
96 bits are equal. Of equal chunks that of the least (document, position) is not removed, and the bytes of all others
are. Parts of the one that is not removed may still go with another chunk that overlaps it, which then has an equal at a
lesser place: so each piece between two cuts stands somewhere in the result, but a passage may stand in pieces only.

Chunks are not shuffled as rows. Documents are held in pages of a few MB (whole rows as one Arrow block). A page asks,
for each of its distinct digests, once, in one packed row a bucket of digests, whether a lesser document has it; the
answer lists the digests that one has. So a passage that a third of all documents share is asked for once a page, not
once a document. Beyond PAGES_A_HEAT pages the asking is a tournament: pages meet in heats of that many, and only the
least holder of a digest in a heat meets those of the others. So a digest that every page has is PAGES_A_HEAT entries
of one task and then one a heat, and a page's rows do not multiply with the buckets of the whole corpus. Each page then
cuts its own texts from the answers.

Null texts stay null, empty ones empty; neither has chunks. Repeated rows: of rows with equal key and text one keeps
its text. Ties on the key are settled by the page (its bytes, not chance) and the place in it. An empty table gives an
empty result. All other columns pass through in the page, whatever their names. Keys are whole numbers, and other types
raise TypeError; null keys count as the greatest. A very long text is a page of its own, held whole with some tens of
bytes for each of its words.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from gantry.llm.common import bound_batches, by_bytes, durable

#: Bytes that the rolling hash sees, mean words between cuts, and least words of a chunk.
WINDOW, MEAN_WORDS, MIN_WORDS = 16, 2, 15
#: Words without a cut after which every word is one.
MOST_WORDS = 8
#: Bytes of text in a page.
PAGE_BYTES = 4 << 20
#: Distinct digests that one bucket is sized for.
BUCKET_DIGESTS = 1 << 19
#: Pages that meet in one heat (some 16 GB of text).
PAGES_A_HEAT = 4096
#: Bytes of a compressed page for each of its cuts, about: it only sizes buckets.
_BYTES_A_CUT = 2.4
#: A page's name: 8 bytes of its content, 8 of chance.
_NAME = np.dtype([("content", "u8"), ("chance", "u8")])
#: A chunk's digest: 96 bits, for equal digests decide what is removed. Among 10^13 chunks (100 TB of text, a cut at every
#: second word) 6 in 10,000 corpora have two unlike chunks of one digest.
_DIGEST = np.dtype([("low", "u8"), ("high", "u4")])

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def gear_table(seed: int = 42) -> np.ndarray:
    """A pseudo-random 32-bit number for each byte."""
    return np.array([xxhash.xxh32_intdigest(bytes([b]), seed) for b in range(256)], np.uint32)


def gear_hash(data: np.ndarray, gear: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Sum of gear[data[i - k]] << k over the last `window` (a power of two) bytes, for every i, by doubling."""
    h = gear[data]
    step = 1
    while step < window:
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    return h


class Chunks:
    """Chunks of a text: the cuts, the chunk that begins at each (the last few cuts begin none), digests.

    Piece i is the bytes from cut i to the next, `start[i]` to `end[i]`, of `words[i]` words; chunk i is pieces i to `past[i]`.
    """

    def __init__(self, text: bytes, gear: np.ndarray, mean: int = MEAN_WORDS, least: int = MIN_WORDS) -> None:
        data = np.frombuffer(text, np.uint8)
        space = _SPACE[data]
        # a word starts where a byte that is no white space follows one, or at the start
        starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]])) if len(data) else np.zeros(0, np.int64)
        word_ends = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1 if len(data) else starts
        h = gear_hash(data, gear) if len(data) else np.zeros(0, np.uint32)
        # the hash is that of the bytes before the word, so that the cut belongs to both neighbours alike
        at = np.arange(len(starts))
        low = (starts >= WINDOW) & ((h[starts - 1] >> np.uint32(8)) < np.uint32((1 << 24) // mean)) if len(starts) else starts.astype(bool)
        since = at - np.maximum.accumulate(np.where(low, at, 0)) if len(starts) else at
        bounds = starts[low | (since > MOST_WORDS) | (at == 0)]
        self.start = bounds
        self.end = np.append(bounds[1:], len(data)) if len(bounds) else bounds
        upto = np.append(np.searchsorted(starts, bounds), len(starts))  # words before each cut, and all
        self.words = np.diff(upto)
        past = np.searchsorted(upto, upto[:-1] + least)
        self.past = past[past <= len(bounds)]
        n, of = len(self.past), xxhash.xxh3_128_digest
        last = word_ends[upto[self.past] - 1] if n else bounds[:0]  # white space behind a chunk is not part of it
        self.digest = np.frombuffer(b"".join(of(text[a:z])[: _DIGEST.itemsize] for a, z in zip(bounds[:n].tolist(), last.tolist(), strict=True)), _DIGEST)


def runs(repeated: np.ndarray, past: np.ndarray, pieces: int) -> np.ndarray:
    """(first, past) piece of each maximal run of pieces that lie in repeated chunks."""
    covers = np.zeros(pieces + 1, np.int64)
    first = np.flatnonzero(repeated)
    np.add.at(covers, first, 1)
    np.subtract.at(covers, past[first], 1)
    edge = np.diff(np.concatenate([[0], (np.cumsum(covers[:-1]) > 0).astype(np.int8), [0]]))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)


def ranks(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct pairs in order, the place of each one's first, the number of each among them); as np.unique, which is slow on pairs."""
    one, two = (pairs[f] for f in pairs.dtype.names)
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[: len(pairs)]
    of = np.empty(len(pairs), np.int64)
    of[order] = np.cumsum(new) - 1
    return pairs[order[new]], order[new], of


def contest(pages: np.ndarray, of: np.ndarray, digest: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, list[tuple[bytes, bytes]]]:
    """(places of the least (owner, page) of each digest, (page, digests) of all others); of is each entry's page."""
    order = np.lexsort((of, owner, digest["high"], digest["low"]))
    low, high = digest["low"][order], digest["high"][order]
    later = np.zeros(len(order), bool)
    later[1:] = (low[1:] == low[:-1]) & (high[1:] == high[:-1])
    beaten = order[later]
    beaten = beaten[np.argsort(of[beaten], kind="stable")]
    cuts = np.searchsorted(of[beaten], np.arange(len(pages) + 1))
    return order[~later], [(pages[i].tobytes(), digest[beaten[a:z]].tobytes()) for i, (a, z) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if z > a]


def _narrow(number: np.ndarray, kinds: int) -> bytes:
    """Numbers below `kinds`, in two bytes each where they fit, else in four."""
    return number.astype(np.uint16 if kinds <= 1 << 16 else np.uint32).tobytes()


def by_bucket(digest: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its digests), those with any."""
    digest = digest["low"]
    bucket = (digest % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else bucket
    for part in np.split(order, first[1:]) if len(first) else ():
        yield int(digest[part[0]] % np.uint64(buckets)), part


def _repeated(digests: list[np.ndarray], answers: list[bytes]) -> np.ndarray:
    """Of a page's chunks in order: whether a lesser document elsewhere has it, or an earlier chunk of the page."""
    lesser = np.frombuffer(b"".join(answers), _DIGEST)  # all of them are digests that the page asked for
    every = np.concatenate([*digests, np.zeros(0, _DIGEST)])
    kinds, first, of = ranks(np.concatenate([every, lesser]))
    elsewhere = np.zeros(len(kinds), bool)
    elsewhere[of[len(every) :]] = True
    back = of[: len(every)]
    out = np.ones(len(every), bool)
    out[first] = False
    return out | elsewhere[back]


def _pages(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(page, block): rows of about PAGE_BYTES of text as one compressed Arrow block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def made() -> pa.RecordBatch:
            out = io.BytesIO()
            table = pa.Table.from_batches(held).combine_chunks()
            with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(table)
            block = out.getvalue()
            page = xxhash.xxh3_64_digest(block) + uuid.uuid4().bytes[:8]  # pages with equal rows may change places
            return pa.record_batch([pa.array([page]), pa.array([block], pa.binary())], ["page", "block"])

        for b in batches:
            for part in by_bytes([b], text, PAGE_BYTES):
                n = sum(c.nbytes for c in part.columns)
                if held and size + n > PAGE_BYTES:
                    yield made()
                    held, size = [], 0
                held.append(part)
                size += n
        if held:
            yield made()

    return docs.mapInArrow(run, "page binary, block binary")


def _rows(block: bytes) -> pa.Table:
    return pa.ipc.open_stream(block).read_all()


def _order(table: pa.Table, key: str) -> list[int]:
    """Rows by key, nulls last, ties by place."""
    keys = table.column(key).to_pylist()
    return sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i] if keys[i] is not None else 0, i))


def dedupe(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, mean_words: int = MEAN_WORDS, report: bool = False) -> DataFrame:
    """docs with repeated passages cut from `text`; with report, (key, text, n_chunks, n_repeated_chunks, n_words, n_removed_words, n_removed_spans).

    The key is a long (a document's number); the order of documents is its order.
    """
    if not isinstance(docs.schema[key].dataType, IntegralType):
        raise TypeError(f"{key} is {docs.schema[key].dataType.simpleString()}; keys must be whole numbers")
    bound_batches(docs.sparkSession)
    gear = gear_table()
    pages = durable(_pages(docs.select(key, text) if report else docs, key, text), "pages")
    n_pages, total = pages.agg(F.count("page"), F.coalesce(F.sum(F.length("block")), F.lit(0))).first()
    heats = max(1, -(-n_pages // PAGES_A_HEAT))
    cuts = total / _BYTES_A_CUT / mean_words
    buckets, final = (max(8, int(n) // BUCKET_DIGESTS * 2) for n in (cuts / heats, cuts))
    none = np.iinfo(np.int64).max

    def chunked(block: bytes) -> Iterator[tuple[int, int | None, Chunks]]:
        table = _rows(block)
        keys, texts = table.column(key), table.column(text)
        for i in _order(table, key):
            yield i, keys[i].as_py(), Chunks((texts[i].as_py() or "").encode(), gear, mean_words, min_words)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each page and bucket: the page's distinct digests there and the least key that has each."""
        for b in batches:
            for page, block in zip(b.column("page").to_pylist(), b.column("block").to_pylist(), strict=True):
                digests, owners, keys = [], [], []
                for _, k, c in chunked(block):
                    digests.append(c.digest)
                    owners.append(np.full(len(c.digest), len(keys), np.uint32))
                    keys.append(none if k is None else k)
                if not digests:
                    continue
                digest, first, _ = ranks(np.concatenate(digests))
                owner = np.concatenate(owners)[first]
                own = int.from_bytes(page[8:12]) % heats
                rows = []
                for i, at in by_bucket(digest, buckets):
                    # the row's documents once, and for each digest the number of its own among them
                    held, number = np.unique(owner[at], return_inverse=True)
                    rows.append((page, own, i, digest[at].tobytes(), _narrow(number, len(held)), np.array(keys, np.int64)[held].tobytes()))
                yield pa.record_batch([pa.array([r[n] for r in rows], t) for n, t in enumerate((pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["names", "heat", "bucket", "digests", "owners", "keys"])

    def meet(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(pages, page of each, digest, owner) of the entries of a group; a row names one page for all its digests or one for each."""
        digests = [np.frombuffer(d.as_py(), _DIGEST) for d in t.column("digests")]
        names = [np.frombuffer(p.as_py(), _NAME) for p in t.column("names")]
        pages, _, of = ranks(np.concatenate(names))
        times = np.concatenate([np.full(len(p), len(d) // len(p)) for p, d in zip(names, digests, strict=True)])
        owners = [np.frombuffer(k.as_py(), np.int64)[np.frombuffer(o.as_py(), np.uint16 if len(o.as_py()) == 2 * len(d) else np.uint32)] for o, k, d in zip(t.column("owners"), t.column("keys"), digests, strict=True)]
        return pages, np.repeat(of, times), np.concatenate(digests), np.concatenate(owners)

    def heat(t: pa.Table) -> pa.Table:
        """One bucket of one heat: answers to all but the least holders, who go on (rows without a page) where there are other heats."""
        among, of, digest, owner = meet(t)
        least, answers = contest(among, of, digest, owner)
        rows = [(page, d, None, None, None, None) for page, d in answers]
        if heats > 1:
            names, digest, owner = among[of[least]], digest[least], owner[least]
            for i, at in by_bucket(digest, final):
                held, number = np.unique(owner[at], return_inverse=True)
                rows.append((None, digest[at].tobytes(), names[at].tobytes(), i, _narrow(number, len(held)), held.tobytes()))
        types = (pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array([r[n] for r in rows], x) for n, x in enumerate(types)], ["page", "digests", "names", "bucket", "owners", "keys"])

    def last(t: pa.Table) -> pa.Table:
        _, answers = contest(*meet(t))
        return pa.table([pa.array([r[n] for r in answers], pa.binary()) for n in (0, 1)], ["page", "digests"])

    asked = pages.mapInArrow(ask, "names binary, heat int, bucket int, digests binary, owners binary, keys binary")
    answers = asked.groupBy("heat", "bucket").applyInArrow(heat, "page binary, digests binary, names binary, bucket int, owners binary, keys binary")
    if heats > 1:
        answers = durable(answers, "heats")
        on = answers.where("page IS NULL").select("names", "bucket", "digests", "owners", "keys")
        answers = answers.where("page IS NOT NULL").select("page", "digests").union(on.groupBy("bucket").applyInArrow(last, "page binary, digests binary"))
    gathered = answers.groupBy("page").agg(F.collect_list("digests").alias("answers")).withColumnRenamed("page", "to_page")
    joined = pages.join(gathered, pages["page"] == gathered["to_page"], "left").select("block", "answers")
    schema = StructType([f for f in docs.schema if not report or f.name in (key, text)])
    extra = ", n_chunks bigint, n_repeated_chunks bigint, n_words bigint, n_removed_words bigint, n_removed_spans bigint" if report else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, answers in zip(b.column("block"), b.column("answers"), strict=True):
                table = _rows(block.as_py())
                texts, counts = table.column(text).to_pylist(), [None] * table.num_rows
                found = list(chunked(block.as_py()))
                repeated = _repeated([c.digest for *_, c in found], answers.as_py() or [])
                at = 0
                for i, _, c in found:
                    own = repeated[at : at + len(c.digest)]
                    at += len(own)
                    gone = runs(own, c.past, len(c.start))
                    if len(gone):
                        raw, past, kept = (texts[i] or "").encode(), 0, []
                        for first, end in gone.tolist():
                            kept.append(raw[past : c.start[first]])
                            past = int(c.end[end - 1])
                        texts[i] = b"".join([*kept, raw[past:]]).decode()
                    counts[i] = (len(own), int(own.sum()), int(c.words.sum()), int(sum(c.words[a:z].sum() for a, z in gone)), len(gone))
                columns = [pa.array(texts, table.schema.field(text).type) if f == text else table.column(f) for f in table.column_names]
                names = list(table.column_names)
                if report:
                    columns += [pa.array([x[n] for x in counts], pa.int64()) for n in range(5)]
                    names += ["n_chunks", "n_repeated_chunks", "n_words", "n_removed_words", "n_removed_spans"]
                yield from pa.table(columns, names=names).combine_chunks().to_batches(max_chunksize=2000)

    return joined.mapInArrow(cut, _ddl(schema) + extra)


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
