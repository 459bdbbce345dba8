import numpy as np
import pytest
import xxhash

from gantry.llm import simhash
from gantry.llm.common import words_of
from tests.llm.conftest import ROWS


def plain_fingerprint(text, width=4):
    w = words_of(text)
    shingles = [b" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [b" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(n, pairs):
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def clustered(rng, n):
    fp = np.repeat(rng.integers(0, 2**63, size=max(1, n // 8), dtype=np.uint64), 8)[:n].copy()
    for i in range(len(fp)):
        for _ in range(int(rng.integers(0, 7))):
            fp[i] ^= np.uint64(1) << np.uint64(rng.integers(0, 64))
    return np.unique(fp)


@pytest.mark.parametrize("most", [64, 1 << 20])
def test_trie_equals_all_pairs(most, monkeypatch):
    monkeypatch.setattr(simhash, "MOST_PAIRS", most)
    rng = np.random.default_rng(5)
    for _ in range(20):
        fp = clustered(rng, int(rng.integers(2, 300)))
        near = np.argwhere(np.triu(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4, 1))
        assert simhash.trie_links(fp, np.array([0, len(fp)]), 0, 4).tolist() == roots(len(fp), near.tolist())


@pytest.mark.parametrize("most", [20_000, 30])
def test_links_equal_all_pairs(spark, most, monkeypatch):
    """Also with tries that are split into pairs of subtrees."""
    monkeypatch.setattr(simhash, "MOST_IN_TRIE", most)
    fp = np.sort(clustered(np.random.default_rng(6), 600).view(np.int64))
    df = spark.createDataFrame([(x,) for x in fp.tolist()], "fp bigint")
    got = {r["node"]: r["root"] for r in simhash.components(simhash.links(df)).collect()}
    near = np.argwhere(np.triu(np.bitwise_count((fp[:, None] ^ fp[None, :]).view(np.uint64)) <= 4, 1))
    want = roots(len(fp), near.tolist())
    assert [got.get(x, x) for x in fp.tolist()] == [fp[r] for r in want]


def test_odd_rows(odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add((r["fp"] & (2**64 - 1), r["component"]))
    for key, text, *_ in ROWS:
        assert {f for f, _ in by[key]} == {plain_fingerprint(text)}
    assert {c for _, c in by[2]} == {1} and {c for _, c in by[4]} == {3} and {c for _, c in by[5]} == {3}
    assert simhash.near_duplicates(none).collect() == []


def test_query(spark):
    from gantry.llm.queries import op2_simhash

    rows = op2_simhash(spark, "/root/testdata/sf0.001").collect()
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    keys = sorted(texts)
    fp = np.array([plain_fingerprint(texts[k]) for k in keys], np.uint64)
    near = np.argwhere(np.triu(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4, 1))
    want = roots(len(keys), near.tolist())
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {k: (f"{fp[i]:016x}", keys[want[i]]) for i, k in enumerate(keys)}


def test_near_copies(spark, odd, none):
    words = [f"w{i}" for i in range(300)]
    one = words.copy()
    one[150] = "changed"
    other = [f"v{i}" for i in range(300)]
    half = words[:150] + other[150:]
    docs = spark.createDataFrame([(i, " ".join(w), "k") for i, w in enumerate((words, one, other, half, words))], "doc_id bigint, text string, key string")
    assert dict(simhash.near_copies(docs).collect()) == {0: 0, 1: 0, 2: 2, 3: 3, 4: 0}
    kept = simhash.keep_one(docs, simhash.near_copies(docs))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3] and kept.columns == docs.columns
    left = [r["doc_id"] for r in simhash.keep_one(odd, simhash.near_copies(odd)).collect()]
    assert sorted(left, key=lambda x: x or 0) == [None, 1, 3, 6, 7, 9]
    assert simhash.keep_one(none, simhash.near_copies(none)).collect() == []


def jaccard(a, b, width=5):
    x, y = ({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} for w in (a, b))
    return len(x & y) / len(x | y)


def copies(rng, source):
    """Cut, appended and scattered copies of words, around a similarity of 0.8."""
    n = len(source)
    for share in (0.1, 0.14, 0.19, 0.21):
        at = int(rng.integers(0, n - int(share * n)))
        yield source[:at] + source[at + int(share * n) :]
        yield source + [f"new{rng.integers(1e9)}" for _ in range(int(share * n * 1.2))]
        other = source.copy()
        for k in rng.choice(n, max(1, int(share * n / 10)), replace=False):
            other[k] = f"new{rng.integers(1e9)}"
        yield other


@pytest.mark.parametrize("most", [5_000, 3])
def test_near_copies_equal_all_pairs(spark, most, monkeypatch):
    """Every pair of similarity 0.8 is found, also where shingles with many texts are split."""
    monkeypatch.setattr(simhash, "MOST_IN_GROUP", most)
    rng = np.random.default_rng(11)
    line = [f"license{i}" for i in range(60)]
    texts = []
    for n in (100, 300, 1000) * 3:
        source = [f"w{x}" for x in rng.zipf(1.3, n) % 50_000] + line
        texts += [source, *copies(rng, source)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id bigint, text string")
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(texts[i], texts[j]) >= 0.8]
    assert len(pairs) > 100
    assert [c for _, c in sorted(simhash.near_copies(docs).collect())] == roots(len(texts), pairs)


@pytest.mark.parametrize("bits", [5, 1])
def test_texts_whose_names_meet_stay_apart(spark, bits):
    """Names of a few bits: unlike texts share them, and still each is compared and kept by its own words."""
    rng = np.random.default_rng(2)
    source = [[f"w{x}" for x in rng.integers(0, 50_000, 120)] for _ in range(30)]
    texts = [t for s in source for t in (s, [*s[:60], "changed", *s[61:]])] + [[], [], source[3]]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id bigint, text string")
    want = {i: i - i % 2 for i in range(60)} | {60: 60, 61: 60, 62: 6}
    assert dict(simhash.near_copies(docs, id_bits=bits).collect()) == want


def test_copies_beside_an_unlike_text_are_found(spark, monkeypatch):
    """All fingerprints agree, so that the forest holds each text against one unlike text only."""
    monkeypatch.setattr(simhash, "word_set_prints", lambda words, seeds: [0] * seeds)
    unlike = [[f"u{k}-{i}" for i in range(90)] for k in range(6)]
    copy = [f"w{i}" for i in range(200)]
    texts = [*unlike, copy, copy[:180]]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id bigint, text string")
    assert dict(simhash.near_copies(docs).collect()) == {i: min(i, 6) for i in range(8)}


def test_forest_keeps_components():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 60, 50), rng.integers(0, 60, 50)
    x, y = simhash.forest(a, b)
    assert len(x) < 50 and roots(60, zip(a, b, strict=True)) == roots(60, zip(x, y, strict=True))
