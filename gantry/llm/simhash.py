"""SimHash near-duplicates: fingerprints, a binary-trie self-join under a Hamming budget, components.

The self-join never compares all fingerprints. With a budget of b bits, two fingerprints that link agree on at least
one of b + 1 blocks of bits, so each fingerprint is routed to b + 1 tries, one for each block with the block's bits in
front. A trie is a sorted array: a node is a range that shares a prefix. Pairs of nodes are walked down together, the
differing bits accumulate, and a pair is dropped once they exceed the budget. A trie over MOST_IN_TRIE fingerprints is
split by its next bits into pairs of subtrees that are within the budget, so that no task holds a hot block alone.
Each task returns a spanning forest of the links it found (at most one row a fingerprint), not the pairs.

Null texts and texts without words have fingerprint 0 and link like any other. Repeated rows and equal texts share a
fingerprint and so a component. An empty table gives an empty result. Columns other than key and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantry.llm.common import durable, key_and_text, words_of

#: The contract's shingle width, hash seed and Hamming budget.
WIDTH, SEED, BUDGET = 4, 42, 4
#: Fingerprints in one trie before it is split, and node pairs or leaf pairs held at once.
MOST_IN_TRIE, MOST_PAIRS = 20_000, 1 << 20
#: Keys (of 8 bytes) that are broadcast at most.
MOST_BROADCAST = 400_000
#: Shingles known as frequent at most, and in how many of 512 texts of a task one is met to be counted.
MOST_FREQUENT, LEAST_MET = 1 << 17, 3
#: Texts that share a leading shingle and are paired in one group, and pairs for each text up to which all leave the task.
MOST_IN_GROUP, DENSE = 5_000, 2
#: Texts and shingles in one part of a dense component.
MOST_IN_BLOCK, MOST_SHINGLES = 2_000, 1 << 21
#: Bytes of parity bits that go with a text's leading shingles.
SHORT_BITS = 256


def shingle_hashes(words: list[bytes], width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of `width` words joined by single spaces; of the whole sequence if there are fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    k = min(width, len(words))
    a, z = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    of = xxhash.xxh64_intdigest
    return np.fromiter((of(line[i:j], seed) for i, j in zip(a, z, strict=True)), np.uint64, len(a))


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[i : i + (1 << 16)].astype(">u8"))
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(key, fp): fp is the fingerprint as a signed 64-bit integer. One pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [fingerprint(shingle_hashes(words_of(t.as_py()), width)) for t in b.column("text")]
            yield pa.record_batch([b.column("key"), pa.array(np.array(made, np.uint64).view(np.int64))], ["key", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return key_and_text(docs, key, text).mapInArrow(run, f"key {kind}, fp bigint")


# the trie self-join ----------------------------------------------------------------------------------------------


def blocks(budget: int) -> list[tuple[int, int]]:
    """(first bit, bits) of budget + 1 blocks over 64 bits, widths as even as can be."""
    n = budget + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, z - a) for a, z in zip(cuts, cuts[1:], strict=False)]


def rotated(fp: np.ndarray, by: int) -> np.ndarray:
    return fp if by == 0 else (fp << np.uint64(by)) | (fp >> np.uint64(64 - by))


def root_labels(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The least index reachable from each of 0..n-1 over the links a-b, going on from `label`."""
    label = np.arange(n) if label is None else label
    while True:
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(up := label[label], label):
            label = up
        if np.array_equal(label[a], label[b]):
            return label


def trie_links(fp: np.ndarray, first: np.ndarray, depth: int, budget: int) -> np.ndarray:
    """Labels (least index reachable) of sorted fingerprints over links within the budget, inside each group.

    `first` has the group bounds: group g is fp[first[g]:first[g + 1]], whose members share their first `depth` bits.
    """
    n = len(fp)
    label = np.arange(n)
    lo, hi = first[:-1], first[1:]
    big = hi - lo > 1
    stack = [(depth, lo[big], hi[big], lo[big], hi[big], np.zeros(int(big.sum()), np.int64))]
    zeros: dict[int, np.ndarray] = {}
    while stack:
        d, al, ah, bl, bh, diff = stack.pop()
        if len(al) > MOST_PAIRS:
            m = len(al) // 2
            stack += [(d, al[:m], ah[:m], bl[:m], bh[:m], diff[:m]), (d, al[m:], ah[m:], bl[m:], bh[m:], diff[m:])]
            continue
        own = al == bl
        sizes = (ah - al) * (bh - bl)
        leaf = (sizes <= 64) | (d >= 64)
        for i, j in _leaf_pairs(al[leaf], ah[leaf], bl[leaf], bh[leaf], own[leaf], sizes[leaf]):
            near = np.bitwise_count(fp[i] ^ fp[j]) <= budget
            i, j = i[near], j[near]
            new = label[i] != label[j]
            if new.any():
                label = root_labels(n, i[new], j[new], label)
        rest = ~leaf
        if not rest.any():
            continue
        if d not in zeros:
            zeros[d] = np.concatenate([[0], np.cumsum((fp >> np.uint64(63 - d)) & np.uint64(1) == 0)])
        al, ah, bl, bh, diff, own = al[rest], ah[rest], bl[rest], bh[rest], diff[rest], own[rest]
        z = zeros[d]
        am, bm = al + z[ah] - z[al], bl + z[bh] - z[bl]
        # both zero, both one, then the two ways to differ; a node with itself differs one way only
        al4, ah4 = np.concatenate([al, am, al, am]), np.concatenate([am, ah, am, ah])
        bl4, bh4 = np.concatenate([bl, bm, bm, bl]), np.concatenate([bm, bh, bh, bm])
        diff4 = np.concatenate([diff, diff, diff + 1, diff + 1])
        twice = np.concatenate([np.zeros(3 * len(own), bool), own])
        keep = (al4 < ah4) & (bl4 < bh4) & (diff4 <= budget) & ~twice & ~((al4 == bl4) & (ah4 - al4 < 2))
        stack.append((d + 1, al4[keep], ah4[keep], bl4[keep], bh4[keep], diff4[keep]))
    return label


def _leaf_pairs(al, ah, bl, bh, own, sizes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of the leaf node pairs, MOST_PAIRS at a time; of a node with itself each pair once."""
    if not len(al):
        return
    upto = np.cumsum(sizes)
    start = 0
    while start < len(al):
        stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + MOST_PAIRS, "right")))
        n = sizes[start:stop]
        at = np.repeat(np.arange(start, stop), n)
        k = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        wide = (bh - bl)[at]
        i, j = al[at] + k // wide, bl[at] + k % wide
        fine = ~own[at] | (i < j)
        yield i[fine], j[fine]
        start = stop


def links(fps: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(seed, a, b): forest edges over distinct fingerprints (columns seed, fp) whose components are those of all links within the budget.

    Fingerprints link under their own seed only; without that column there is one seed, 0.
    """
    cuts = blocks(budget)
    fps = fps if "seed" in fps.columns else fps.withColumn("seed", F.lit(0))
    turned = [(F.shiftleft("fp", at).bitwiseOR(F.shiftrightunsigned("fp", 64 - at)) if at else F.col("fp")) for at, _ in cuts]
    routes = fps.select("seed", F.posexplode(F.array(*turned)).alias("at", "turned"))
    value = F.expr("CASE at " + " ".join(f"WHEN {k} THEN shiftrightunsigned(turned, {64 - n})" for k, (_, n) in enumerate(cuts)) + " END")
    routes = routes.withColumns({"value": value, "block": F.col("seed") * len(cuts) + F.col("at")})
    over = routes.groupBy("block", "value").count().where(F.col("count") > MOST_IN_TRIE)
    bits = F.least(F.lit(16), F.ceil(F.log2(F.col("count") / MOST_IN_TRIE)).cast("int") + 1)
    routes = routes.join(over.select("block", "value", bits.alias("bits")), ["block", "value"], "left").select("block", "turned", F.coalesce("bits", F.lit(0)).alias("bits"))
    widths = np.array([n for _, n in cuts])
    masks = {p: np.array(sorted(sum(1 << i for i in c) for k in range(budget + 1) for c in combinations(range(p), k)), np.int64) for p in range(17)} if budget <= 6 else None

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each pair of subtrees that the fingerprint is in: (block, bits, lo, hi, turned)."""
        for b in batches:
            block, bits = b.column("block").to_numpy(), b.column("bits").to_numpy()
            turned = b.column("turned").to_numpy()
            for p in np.unique(bits).tolist():
                at = bits == p
                k, t = block[at], turned[at]
                width = widths[k % len(widths)].astype(np.uint64)
                head = (t.view(np.uint64) >> (np.uint64(64) - width)).astype(np.int64)
                sub = ((t.view(np.uint64) << width) >> np.uint64(64 - p)).astype(np.int64) if p else np.zeros(len(t), np.int64)
                for m in masks[p] if masks else _masks(p, budget):
                    other = sub ^ m
                    out = [k, np.full(len(t), p, np.int32), (head << p) | np.minimum(sub, other), (head << p) | np.maximum(sub, other), t]
                    yield pa.record_batch([pa.array(x) for x in out], ["block", "bits", "lo", "hi", "turned"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group and fingerprint; whole groups are walked together."""
        for t in whole_groups(batches, ["block", "bits", "lo", "hi"]):
            block = t["block"].to_numpy()
            fp = t["turned"].to_numpy().view(np.uint64)
            change = np.any([np.diff(t[c].to_numpy()) != 0 for c in ("block", "bits", "lo", "hi")], axis=0) if len(fp) > 1 else np.zeros(0, bool)
            first = np.concatenate([[0], np.flatnonzero(change) + 1, [len(fp)]])
            for k in np.unique(block).tolist():
                at, n = cuts[k % len(cuts)]
                rows = np.flatnonzero(block == k)  # one run, as rows are sorted by block
                bounds = first[(first >= rows[0]) & (first <= rows[-1] + 1)] - rows[0]
                own = fp[rows[0] : rows[-1] + 1]
                own = unsigned_order(own, bounds)
                label = trie_links(own, bounds, n, budget)
                plain = rotated(own, (64 - at) % 64).view(np.int64)
                head = plain.copy()  # of each component the least, so that other tries give the same edges
                np.minimum.at(head, label, plain)
                head = head[label]
                moved = np.flatnonzero(head != plain)
                yield pa.record_batch([pa.array(np.full(len(moved), k // len(cuts), np.int32)), pa.array(plain[moved]), pa.array(head[moved])], ["seed", "a", "b"])

    dealt = routes.mapInArrow(split, "block int, bits int, lo bigint, hi bigint, turned bigint")
    dealt = dealt.repartition("block", "bits", "lo", "hi").sortWithinPartitions("block", "bits", "lo", "hi", "turned")
    return dealt.mapInArrow(walk, "seed int, a bigint, b bigint").distinct()


def _masks(p: int, budget: int) -> Iterator[int]:
    for k in range(min(budget, p) + 1):
        for c in combinations(range(p), k):
            yield sum(1 << i for i in c)


def unsigned_order(fp: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sorts inside each group as unsigned numbers; Spark has sorted them as signed ones."""
    group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return fp[np.lexsort((fp, group))]


def whole_groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Tables that end where a group ends; the last group of a batch waits for the next batch."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        last = b.num_rows - 1
        cut = 0
        change = np.any([np.diff(b.column(c).to_numpy()) != 0 for c in by], axis=0) if last else np.zeros(0, bool)
        ends = np.flatnonzero(change)
        same = not held or all(held[-1].column(c)[held[-1].num_rows - 1] == b.column(c)[0] for c in by)
        if held and not same:
            yield pa.Table.from_batches(held)
            held = []
        if len(ends):
            cut = int(ends[-1]) + 1
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
            held = []
        held.append(b.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


# components ------------------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node reachable over the edges (a, b), for every node that has one.

    In each round every node goes to its least neighbour's own least neighbour, and edges are drawn between those
    instead; edges inside one go. So the edges shrink from round to round, and each round is written to the shared folder.
    """
    both = durable(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    label = None
    while True:
        star = durable(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "stars")
        up = star.select(F.col("node").alias("at"), F.col("root").alias("further"))
        star = durable(star.join(up, star["root"] == up["at"], "left").select("node", F.coalesce("further", "root").alias("root")), "stars")
        step = star.select(F.col("node").alias("was"), F.col("root").alias("now"))
        label = star if label is None else durable(label.join(step, label["root"] == step["was"], "left").select("node", F.coalesce("now", "root").alias("root")), "labels")
        near = both.join(step, both["a"] == step["was"]).select(F.col("now").alias("a"), "b")
        both = durable(near.join(star, near["b"] == star["node"]).select("a", F.col("root").alias("b")).where("a <> b").distinct(), "edges")
        if both.isEmpty():
            return label


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, budget: int = BUDGET) -> DataFrame:
    """(key, fp, component): component is the least key of all documents reachable over links, itself included."""
    made = durable(fingerprints(docs, key, text, width), "fingerprints")
    least = made.groupBy("fp").agg(F.min("key").alias("least"))
    least = durable(least, "distinct-fingerprints")
    roots = components(links(least.select("fp"), budget))
    linked = least.join(roots, least["fp"] == roots["node"]).select("fp", "least", "root")
    heads = linked.groupBy(F.col("root").alias("head")).agg(F.min("least").alias("component"))
    linked = linked.join(heads, linked["root"] == heads["head"]).select(F.col("fp").alias("linked_fp"), "component")
    known = durable(least.join(linked, F.col("fp") == F.col("linked_fp"), "left").select(F.col("fp").alias("known_fp"), F.coalesce("component", "least").alias("component")), "fingerprint-components")
    return made.join(known, made["fp"] == known["known_fp"], "left").select(F.col("key").alias(key), "fp", "component")


# near copies by shingle similarity -------------------------------------------------------------------------------


def word_set_prints(words: list[bytes], seeds: int) -> list[int]:
    """Fingerprints of the set of words, one for each seed: a changed word moves them less than it moves shingles."""
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in set(words)), np.uint64)
    out = []
    for k in range(seeds):
        h = own * np.uint64(2 * k + 1) + np.uint64((0x9E3779B97F4A7C15 * (k + 1)) & ((1 << 64) - 1))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out.append(fingerprint(h ^ (h >> np.uint64(31))))
    return out


def similar(a: str | None, b: str | None, width: int, least: float) -> bool:
    """Whether the Jaccard similarity of the texts' sets of shingles is at least `least`; two without words are alike."""
    x, y = set(shingle_hashes(words_of(a), width).tolist()), set(shingle_hashes(words_of(b), width).tolist())
    both = len(x & y)
    return both >= least * (len(x) + len(y) - both)


def text_digest(words: list[bytes]) -> bytes:
    """Texts with equal words are one: 128 bits."""
    return xxhash.xxh3_128_digest(b" ".join(words))


def text_id(digest: bytes, moved: dict[bytes, int], bits: int = 64) -> int:
    """A signed 64-bit integer for a digest: its last bits, or what moved has for it, where those of another text are the same."""
    found = moved.get(digest) if moved else None
    return found if found is not None else int.from_bytes(digest[-8:], "big", signed=True) >> (64 - bits)


def clashing(kinds: DataFrame, bits: int) -> dict[bytes, int]:
    """New ids for the digests among (id, digest) that share an id of `bits` bits with another: other hashes of them, until all differ.

    At 64 bits there are about n * n / 2^65 of them: some ten among 2 * 10^10 texts.
    """
    moved: dict[bytes, int] = {}
    spark, turn = kinds.sparkSession, 0
    clash = kinds.groupBy("id").count().where("count > 1").select("id")
    open_ = [bytes(r["digest"]) for r in kinds.join(clash, "id", "left_semi").select("digest").collect()]
    while open_:
        turn += 1
        tried = {d: int.from_bytes(hashlib.blake2b(d, digest_size=8, salt=turn.to_bytes(4, "big")).digest(), "big", signed=True) for d in open_}
        taken = {r["id"] for r in kinds.join(F.broadcast(spark.createDataFrame([(i,) for i in tried.values()], "id bigint")), "id", "left_semi").select("id").distinct().collect()}
        taken |= set(moved.values())
        counts = Counter(tried.values())
        good = {d: i for d, i in tried.items() if i not in taken and counts[i] == 1}
        moved |= good
        open_ = [d for d in open_ if d not in good]
    return moved


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of each run of `width` words, of all words if there are fewer; mixed from hashes of the words."""
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(width, len(words))
    h = np.zeros(len(words) - k + 1 if k else 0, np.uint64)
    for i in range(k):
        h = (h ^ own[i : i + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return np.unique(h)


def parity_bits(shingles: np.ndarray) -> bytes:
    """A bit for each shingle or more (256 or a greater power of two), each the parity of its share of them.

    Two sets differ in at least as many shingles as bits; the halves of a string, one upon the other, are that of half the bits.
    """
    n = max(8, int(len(shingles) - 1).bit_length()) if len(shingles) else 8
    odd = np.bincount((shingles & np.uint64((1 << n) - 1)).astype(np.int64), minlength=1 << n) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(bits: bytes, size: int) -> int:
    """The parity bits as a number of `size` bytes."""
    while len(bits) > size:
        half = len(bits) // 2
        bits = (int.from_bytes(bits[:half], "big") ^ int.from_bytes(bits[half:], "big")).to_bytes(half, "big")
    return int.from_bytes(bits, "big")


def may_differ_by(a: bytes, b: bytes) -> int:
    """The fewest shingles in which two sets with these parity bits differ."""
    size = min(len(a), len(b))
    return (folded(a, size) ^ folded(b, size)).bit_count()


def least_common(sizes: np.ndarray | int, similarity: float) -> np.ndarray:
    """Of two sets with `sizes` members together, the fewest they share at that Jaccard similarity."""
    return np.ceil(sizes * (similarity / (1 + similarity)) - 1e-9).astype(np.int64)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components as a-b, at most one a node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = root_labels(len(nodes), at[: len(a)], at[len(a) :])
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[moved]], nodes[moved]


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, similarity: float = 0.8, seeds: int = 4, budget: int = BUDGET, id_bits: int = 64) -> DataFrame:
    """(key, component): documents linked by a shingle similarity of `similarity` or more; component is the least key.

    First the trie self-join above, once a seed, over word-set fingerprints: what it links within `budget` bits and the
    shingles confirm is joined, so that large clusters are one before pairs are made. Then every other pair that can be
    so similar: two such sets of n shingles or more share one among the first n - ceil(similarity * n) + 1 of each in any
    order common to all (rare shingles first), so no link is missed. Pairs inside one cluster are left out, as are those
    whose sizes, places or parity bits prove them unlike; each pair left is held against the shingles of both texts.
    Where candidates are dense (a template's many versions), whole components of candidates are compared inside tasks
    and only a forest of the links found leaves them. Texts with equal words are one document here, told by 128 bits; tasks
name them by 64 (id_bits, for tests), and texts whose names would be the same get others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of texts, and among them rows of shingles that a task meets in several texts, with their counts."""
        held: list[np.ndarray] = []

        def counted(kind: pa.DataType) -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            found, n = found[n >= LEAST_MET].view(np.int64), n[n >= LEAST_MET]
            held.clear()
            none = [pa.nulls(len(n), t) for t in (kind, pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.binary())]
            return pa.record_batch([*none, pa.array(found), pa.array(n)], names)

        kind_of = None
        for b in batches:
            kind_of = b.column("key").type
            digests, prints, sizes, bits = [], [], [], []
            for t in b.column("text"):
                words = words_of(t.as_py())
                shingles = shingle_set(words, width)
                held.append(shingles)
                digests.append(text_digest(words))
                prints.append(np.array(word_set_prints(words, seeds), np.uint64).view(np.int64).tolist())
                sizes.append(len(shingles))
                bits.append(parity_bits(shingles))
                if len(held) == 512:
                    yield counted(kind_of)
            none = [pa.nulls(len(digests), pa.int64())] * 2
            ids = [text_id(d, {}, id_bits) for d in digests]
            yield pa.record_batch([b.column("key"), pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(prints, pa.list_(pa.int64())), pa.array(sizes, pa.int64()), pa.array(bits, pa.binary()), *none], names)
        if held:
            yield counted(kind_of)

    names = ["key", "id", "digest", "prints", "size", "bits", "shingle", "met"]
    kind = docs.schema[key].dataType.simpleString()
    plain = key_and_text(docs, key, text)
    seen = durable(plain.mapInArrow(run, f"key {kind}, id bigint, digest binary, prints array<bigint>, size bigint, bits binary, shingle bigint, met bigint"), "word-set-prints")
    made = seen.where("id IS NOT NULL").select("key", "id", "digest", "prints", "size", "bits")
    nodes = made.where("key IS NOT NULL").groupBy("id", "digest").agg(F.min("key").alias("node"), F.first("prints").alias("prints"), F.first("size").alias("size"), F.first("bits").alias("bits"))
    nodes = durable(nodes, "distinct-texts")
    moved = clashing(nodes.select("id", "digest"), id_bits)
    if moved:
        new = F.broadcast(nodes.sparkSession.createDataFrame([(bytearray(d), i) for d, i in moved.items()], "moved binary, new_id bigint"))
        renamed = lambda df: df.join(new, F.col("digest") == F.col("moved"), "left").withColumn("id", F.coalesce("new_id", "id")).drop("moved", "new_id")
        made, nodes = renamed(made), durable(renamed(nodes), "distinct-texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of text ids that are similar."""

        def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                sizes = b.column("size_a").to_numpy() + b.column("size_b").to_numpy()
                most = (sizes - 2 * least_common(sizes, similarity)).tolist()
                keep = [may_differ_by(x.as_py(), y.as_py()) <= m for x, y, m in zip(b.column("bits_a"), b.column("bits_b"), most, strict=True)]
                yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Of the links that hold, a spanning forest for each task: they are certain, so it has the same components."""
            a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for batch in batches:
                keep = np.array([similar(x.as_py(), y.as_py(), width, similarity) for x, y in zip(batch.column("text_a"), batch.column("text_b"), strict=True)], bool)
                a, b = forest(np.append(a, batch.column("a").to_numpy()[keep]), np.append(b, batch.column("b").to_numpy()[keep]))
                if len(a) > MOST_PAIRS:
                    yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])
                    a, b = a[:0], b[:0]
            yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

        side = nodes.select("id", "size", "bits")
        sized = pairs.join(side.withColumnsRenamed({"id": "a", "size": "size_a", "bits": "bits_a"}), "a").join(side.withColumnsRenamed({"id": "b", "size": "size_b", "bits": "bits_b"}), "b")
        pairs = durable(sized.mapInArrow(possible, "a bigint, b bigint"), "possible-pairs")
        texts = texts_of(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        left = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        whole = left.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")
        return durable(whole.mapInArrow(check, "a bigint, b bigint"), "near-copy-links")

    def texts_of(ids: DataFrame) -> DataFrame:
        """(id, text) for each of the ids."""

        def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.record_batch([pa.array([text_id(text_digest(words_of(t.as_py())), moved, id_bits) for t in b.column("text")], pa.int64()), b.column("text")], ["id", "text"])

        asked = ids.join(nodes.select("id", "node"), "id").select("node").distinct()
        found = among(plain, "key", asked, "left_semi").mapInArrow(named, "id bigint, text string")
        return durable(found.groupBy("id").agg(F.first("text").alias("text")), "candidate-texts")

    at = nodes.select("id", F.posexplode("prints").alias("seed", "fp"))
    heads = durable(at.groupBy("seed", "fp").agg(F.min("id").alias("head")), "fingerprint-heads")
    same = at.join(heads, ["seed", "fp"]).select(F.col("head").alias("a"), F.col("id").alias("b"))
    found = durable(links(heads.select("seed", "fp"), budget), "fingerprint-links")
    one, other = heads.select("seed", F.col("fp").alias("a"), F.col("head").alias("x")), heads.select("seed", F.col("fp").alias("b"), F.col("head").alias("y"))
    far = found.join(one, ["seed", "a"]).join(other, ["seed", "b"]).select(F.col("x").alias("a"), F.col("y").alias("b"))
    pairs = same.unionByName(far)
    pairs = durable(pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidate-pairs")
    # besides the forest's own edges: each document against the least of its candidates' component
    group = components(pairs)
    pairs = durable(pairs.union(group.where("node <> root").select("root", "node")).distinct(), "candidate-pairs")
    early = confirmed(pairs)

    known = components(early).withColumnRenamed("node", "linked")
    known = nodes.join(known, F.col("id") == F.col("linked"), "left").select("id", "size", "bits", F.coalesce("root", "id").alias("root"))
    met = seen.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("met").alias("met")).orderBy(F.desc("met"), "shingle").limit(MOST_FREQUENT)
    again = made.join(nodes.select("id", "node"), "id").where("key <> node").select("key").distinct()
    again = again.join(nodes.select(F.col("node").alias("key")), "key", "left_anti")
    shared = shared_shingles(among(plain.where("key IS NOT NULL"), "key", again, "left_anti"), met, width, similarity, moved, id_bits)

    def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = [x.as_py() for x in b.column("bits")]
            bits = [folded(x, SHORT_BITS).to_bytes(SHORT_BITS, "big") if len(x) > SHORT_BITS else x for x in bits]
            yield pa.record_batch([b.column("id"), b.column("size"), pa.array(bits, pa.binary()), b.column("root")], ["id", "size", "bits", "root"])

    known = durable(known.select("id", "size", "bits", "root").mapInArrow(shortened, "id bigint, size bigint, bits binary, root bigint"), "known-texts")
    late = durable(possible_pairs(shared, known, similarity), "candidate-pairs")
    tight = late.where("dense").select("a", "b")
    found = [early, confirmed(late.where("NOT dense").select("a", "b"))]
    if not tight.isEmpty():
        found.append(dense_links(tight, known, texts_of(tight.select(F.explode(F.array("a", "b")).alias("id")).distinct()), width, similarity))

    roots = components(reduce(DataFrame.unionByName, found))
    of = nodes.select("id", "node").join(roots.withColumnRenamed("node", "linked"), F.col("id") == F.col("linked"), "left").select("id", "node", F.coalesce("root", "id").alias("root"))
    least = of.groupBy("root").agg(F.min("node").alias("component"))
    of = durable(of.join(least, "root").select(F.col("id").alias("known_id"), "component"), "near-copy-components")
    return made.join(of, made["id"] == of["known_id"], "left").select(F.col("key").alias(key), "component")


def shared_shingles(texts: DataFrame, met: DataFrame, width: int, similarity: float, moved: dict[bytes, int], id_bits: int = 64) -> DataFrame:
    """(shingle, id, place): the leading shingles of each text that lead in another text too. Those of met come last, the rest go by hash."""
    often = met.toArrow()
    names, counts = often.column("shingle").to_numpy().view(np.uint64), often.column("met").to_numpy()
    names, counts = names[by := np.argsort(names)], np.append(counts[by], 0)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for t in b.column("text"):
                words = words_of(t.as_py())
                own = shingle_set(words, width)
                if not len(own):
                    continue
                if len(names):
                    at = np.searchsorted(names, own)
                    at[names[np.minimum(at, len(names) - 1)] != own] = len(names)
                    own = own[np.argsort(counts[at], kind="stable")]
                n = len(own) - int(np.ceil(similarity * len(own) - 1e-9)) + 1
                out.append((own[:n].view(np.int64), np.full(n, text_id(text_digest(words), moved, id_bits)), np.arange(n)))
            if out:
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["shingle", "id", "place"])

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["shingle"]):
            like = np.diff(t["shingle"].to_numpy()) == 0
            keep = np.concatenate([[False], like]) | np.concatenate([like, [False]])
            yield from t.filter(pa.array(keep)).combine_chunks().to_batches()

    form = "shingle bigint, id bigint, place bigint"
    leading = texts.mapInArrow(lead, form).repartition("shingle").sortWithinPartitions("shingle")
    return durable(leading.mapInArrow(common, form), "shared-shingles")


def possible_pairs(shared: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """(a, b, dense) of text ids under different roots of known (id, size, bits of SHORT_BITS bytes at most, root) that share a leading shingle and may be similar.

    A shingle with over MOST_IN_GROUP texts is split into blocks, and each pair of blocks is a group of its own. Groups
    with up to DENSE pairs a text give these (a < b, dense is false); of denser ones only a spanning forest leaves the
    task (dense is true), and its components are compared inside tasks by dense_links: pairs never multiply.
    """
    over = shared.groupBy("shingle").count().where(F.col("count") > MOST_IN_GROUP)
    rows = shared.join(over.select("shingle", F.ceil(F.col("count") / MOST_IN_GROUP).alias("parts")), "shingle", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("part", F.pmod("id", "parts")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    rows = rows.select("shingle", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "id", "place").join(known, "id")
    by = ["shingle", "lo", "hi"]

    def out(a: np.ndarray, b: np.ndarray, dense: bool) -> pa.RecordBatch:
        return pa.record_batch([pa.array(a), pa.array(b), pa.array(np.full(len(a), dense))], ["a", "b", "dense"])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        few, many = np.zeros((0, 2), np.int64), (np.zeros(0, np.int64), np.zeros(0, np.int64))
        held = 0
        for t in whole_groups(batches, by):
            change = np.any([np.diff(t[c].to_numpy()) != 0 for c in by], axis=0) if t.num_rows > 1 else np.zeros(0, bool)
            first = np.concatenate([[0], np.flatnonzero(change) + 1, [t.num_rows]])
            own, group = t["id"].to_numpy(), np.repeat(np.arange(len(first) - 1), np.diff(first))
            most = DENSE * np.diff(first)
            met, label, sparse = np.zeros(len(most), np.int64), None, []
            for i, j in steps(t, first, similarity):
                met += np.bincount(group[i], minlength=len(met))
                tight = (met > most)[group[i]]
                if tight.any() or label is not None:
                    # what a group has given before it proved dense goes into its forest too
                    early = [(x[(met > most)[group[x]]], y[(met > most)[group[x]]]) for x, y in sparse]
                    sparse = [(x[(met <= most)[group[x]]], y[(met <= most)[group[x]]]) for x, y in sparse]
                    x, y = (np.concatenate(c) for c in zip(*early, (i[tight], j[tight]), strict=True))
                    label = root_labels(len(own), x, y, label)
                sparse.append((i[~tight], j[~tight]))
            if sparse:
                i, j = (np.concatenate(c) for c in zip(*sparse, strict=True))
                few = np.concatenate([few, np.stack([np.minimum(own[i], own[j]), np.maximum(own[i], own[j])], axis=1)])
            if label is not None:
                moved = np.flatnonzero(label != np.arange(len(own)))
                many = np.append(many[0], own[label[moved]]), np.append(many[1], own[moved])
            if len(few) + len(many[0]) > max(1 << 16, 2 * held):
                few, many = np.unique(few, axis=0), forest(*many)
                held = len(few) + len(many[0])
                if held > MOST_PAIRS >> 2:
                    yield out(few[:, 0], few[:, 1], False)
                    yield out(*many, True)
                    few, many, held = few[:0], (many[0][:0], many[1][:0]), 0
        few = np.unique(few, axis=0)
        yield out(few[:, 0], few[:, 1], False)
        yield out(*forest(*many), True)

    rows = rows.repartition(*by).sortWithinPartitions(*by)
    return rows.mapInArrow(pair, "a bigint, b bigint, dense boolean").distinct()


def steps(t: pa.Table, first: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of rows of one group (bounds in first) that may be similar, made MOST_PAIRS / 8 at a time."""
    part, place, size, root = (t[c].to_numpy() for c in ("part", "place", "size", "root"))
    inside = t["lo"].to_numpy() == t["hi"].to_numpy()
    length, levels = parity_levels(t["bits"])
    after = np.repeat(first[1:], np.diff(first)) - np.arange(t.num_rows) - 1
    upto = np.cumsum(after)
    start = 0
    while start < t.num_rows:
        stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + (MOST_PAIRS >> 3), "right")))
        n = after[start:stop]
        i = np.repeat(np.arange(start, stop), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        start = stop
        fine = (root[i] != root[j]) & (inside[i] | (part[i] != part[j]))
        i, j = i[fine], j[fine]
        least = least_common(size[i] + size[j], similarity)
        # the first shared shingle and all after it are enough only if no set ends before
        fine = (np.minimum(size[i], size[j]) >= least) & (np.minimum(size[i] - place[i], size[j] - place[j]) >= least)
        i, j, least = i[fine], j[fine], least[fine]
        most = size[i] + size[j] - 2 * least
        for n, bits in levels.items():  # the shortest parity bits first, for few pairs need longer ones
            long = np.minimum(length[i], length[j]) >= n
            fine = ~long
            fine[long] = np.bitwise_count(bits[i[long]] ^ bits[j[long]]).sum(axis=1, dtype=np.int64) <= most[long]
            i, j, most = i[fine], j[fine], most[fine]
        yield i, j


def parity_levels(column: pa.ChunkedArray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """(bytes of each row's parity bits, for each power of two from 32 the rows folded to it; rows shorter than that are 0)."""
    raw = column.to_pylist()
    length = np.fromiter(map(len, raw), np.int64, len(raw))
    levels: dict[int, np.ndarray] = {}
    n, held, at = int(length.max(initial=32)), np.zeros((0, 0), np.uint8), np.zeros(0, np.int64)
    while n >= 32:
        own = np.flatnonzero(length == n)
        half = held.reshape(len(held), 2, n)[:, 0] ^ held.reshape(len(held), 2, n)[:, 1] if len(held) else np.zeros((0, n), np.uint8)
        held, at = np.concatenate([half, np.frombuffer(b"".join(raw[k] for k in own.tolist()), np.uint8).reshape(-1, n)]), np.append(at, own)
        levels[n] = np.zeros((len(raw), n // 8), np.uint64)
        levels[n][at] = held.view(np.uint64)
        n //= 2
    return length, dict(reversed(levels.items()))


def block_links(sets: list[np.ndarray], root: np.ndarray, part: np.ndarray, across: bool, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, row) that join rows of different roots whenever their sets are similar; a forest, not all of them.

    Each row is held against all later ones (of the other part, if across) at once: by size, by parity bits (four for
    each shingle, so few unlike pairs stay), and then, where the two are not yet joined, by the sets themselves.
    """
    size = np.array([len(x) for x in sets], np.int64)
    n = 1 << int(np.clip(int(max(1, 4 * np.median(size))).bit_length(), 8, 14))
    bits = np.zeros((len(sets), n // 64), np.uint64)
    for k, x in enumerate(sets):
        odd = np.bincount((x & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1
        bits[k] = np.packbits(odd.astype(np.uint8)).view(np.uint64)
    _, label = np.unique(root, return_inverse=True)
    a, b = [], []
    for k in range(len(sets) - 1):
        at = k + 1 + np.flatnonzero(label[k + 1 :] != label[k])
        if across:
            at = at[part[at] != part[k]]
        least = least_common(size[k] + size[at], similarity)
        fine = np.minimum(size[k], size[at]) >= least
        at, least = at[fine], least[fine]
        fine = np.bitwise_count(bits[at] ^ bits[k]).sum(axis=1, dtype=np.int64) <= size[k] + size[at] - 2 * least
        for x, m in zip(at[fine].tolist(), least[fine].tolist(), strict=True):
            if label[x] != label[k] and len(np.intersect1d(sets[k], sets[x], assume_unique=True)) >= m:
                a.append(k)
                b.append(x)
                label[label == label[x]] = label[k]
    return np.array(a, np.int64), np.array(b, np.int64)


def dense_links(edges: DataFrame, known: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """(a, b): links of a forest between all similar texts of one component of the edges that are under different roots.

    Components are dealt whole to tasks with their texts (id, text), each text once; over MOST_IN_BLOCK texts or
    MOST_SHINGLES shingles they are split into parts, and each pair of parts is a group of its own.
    """
    at = components(edges).withColumnsRenamed({"node": "id", "root": "whole"}).join(known.select("id", "size", F.col("root")), "id")
    parts = F.greatest(F.ceil(F.count("*") / MOST_IN_BLOCK), F.ceil(F.sum("size") / MOST_SHINGLES)).cast("bigint")
    at = at.join(at.groupBy("whole").agg(parts.alias("parts")), "whole").withColumn("part", F.pmod(F.xxhash64("id"), "parts"))
    at = at.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    rows = at.select("id", "root", "whole", "part", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi")).join(texts, "id")
    by = ["whole", "lo", "hi"]

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, by):
            change = np.any([np.diff(t[c].to_numpy()) != 0 for c in by], axis=0) if t.num_rows > 1 else np.zeros(0, bool)
            first = np.concatenate([[0], np.flatnonzero(change) + 1, [t.num_rows]]).tolist()
            for i, j in zip(first, first[1:], strict=False):
                g = t.slice(i, j - i)
                sets = [shingle_set(words_of(x.as_py()), width) for x in g["text"]]
                across = g["lo"][0].as_py() != g["hi"][0].as_py()
                a, b = block_links(sets, g["root"].to_numpy(), g["part"].to_numpy(), across, similarity)
                own = g["id"].to_numpy()
                yield pa.record_batch([pa.array(own[a]), pa.array(own[b])], ["a", "b"])

    dealt = rows.select(*by, "part", "id", "root", "text").repartition(*by).sortWithinPartitions(*by)
    return durable(dealt.mapInArrow(hold, "a bigint, b bigint"), "dense-links")


def among(df: DataFrame, key: str, keys: DataFrame, how: str) -> DataFrame:
    """Rows of df whose key is (left_semi) or is not (left_anti) in the one column of keys.

    The keys are counted: up to MOST_BROADCAST they are sent to all tasks and df stays where it is, beyond that both are shuffled.
    """
    keys = durable(keys.select(F.col(keys.columns[0]).alias("one_of_them")), "keys")
    if keys.count() <= MOST_BROADCAST:
        keys = F.broadcast(keys)
    return df.join(keys, df[key] == F.col("one_of_them"), how)


def keep_one(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The document with the least key of each component of found, with all its columns; of rows with one key, one. Null keys stay."""
    found = durable(found.select(F.col(key).alias("found_key"), "component"), "components")
    gone = found.where("found_key <> component").select("found_key").distinct()
    again = found.where("found_key IS NOT NULL").groupBy("found_key").agg(F.count("*").alias("n")).where("n > 1").select("found_key")
    packed = docs.select(docs[key].alias("row_key"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    stays = among(packed, "row_key", gone, "left_anti")
    once = among(stays, "row_key", again, "left_anti")
    more = among(stays, "row_key", again, "left_semi").groupBy("row_key").agg(F.first("row").alias("row"))
    return once.unionByName(more).select("row.*")
