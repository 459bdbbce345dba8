"""Fill-in-middle, importance resampling and vector near-duplicates against plain programmes."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gantry.llm import fim, importance, neighbours
from gantry.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import ROWS
from tests.llm.test_simhash import roots
from tests.oracle import compare

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# fill-in-middle


def plain_fim(key, text, transformed=50, first=80, seed=42):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= transformed:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < first:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


FIM_TEXTS = ["a b", " lead and trail ", "\n\n", "x", "one<S>two", "<P", "a <P b <S c <M", "<", "> <", "P>a S>b M>c", "é\U0001f600 漢字\t\x85\xa0 ß", "a  b\x0b\x0cc\r\nd", "<S <P> no", "word " * 400]


@pytest.mark.parametrize("rates", [fim.Rates(), fim.Rates(100, 50, 3), fim.Rates(0)])
def test_fill_in_middle(spark, rates):
    rows = [(k, FIM_TEXTS[k % len(FIM_TEXTS)]) for k in range(280)]
    made = fim.transform(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), rates=rates).withColumn("back", fim.restored())
    got = {r["doc_id"]: (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in made.collect()}
    assert got == {k: plain_fim(k, t, rates.transformed, rates.suffix_first, rates.seed) for k, t in rows}
    assert {r["doc_id"]: r["back"] for r in made.collect()} == dict(rows)


def test_fill_in_middle_odd_rows(spark, odd, none):
    """Nulls, empty and very long texts, repeated rows, one key with different texts, clashing columns, an empty table."""
    every = fim.Rates(100, 50)
    got = fim.transform(odd, rates=every).collect()
    want = [(k, *plain_fim(k, t, 100, 50)) for k, t, *_ in ROWS]
    assert Counter(map(tuple, got)) == Counter(want)
    one_key = spark.createDataFrame([(1, "a b c d", "x"), (1, "e f g h i", "y"), (1, "a b c d", "z"), (None, "q r", "z")], "doc_id bigint, text string, a string")
    got = fim.transform(one_key, rates=every)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert Counter(map(tuple, got.collect())) == Counter((k, *plain_fim(k, t, 100, 50)) for k, t in ((1, "a b c d"), (1, "e f g h i"), (1, "a b c d"), (None, "q r")))
    assert fim.transform(none).collect() == []


def test_fill_in_middle_shuffles_texts_once(spark):
    """One exchange, reused; no side is broadcast, and units are not dealt again."""
    made = fim.transform(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    made.write.format("noop").mode("overwrite").save()
    plan = made._jdf.queryExecution().executedPlan().toString()
    made.collect()
    plan = made._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "Broadcast" not in final and final.count("ReusedExchange") == 1 and len(re.findall(r"(?<!Reused)Exchange hashpartitioning", final)) == 1 + final.count("ReusedExchange")


def test_fill_in_middle_equals_duckdb(spark):
    compare(spark, QUERIES["op11_fill_in_middle"], ORACLES["op11_fill_in_middle"], "/root/testdata/sf0.01")


# importance resampling


def features(text, longest=2, buckets=10_000):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def plain_resample(docs, target, draw):
    made = [(k, *features(t, draw.longest, draw.buckets)) for k, t in docs]
    source, wanted = Counter(b for *_, f in made for b in f), Counter(b for t in target for b in features(t, draw.longest, draw.buckets)[1])
    s, t = sum(source.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + draw.buckets) / ((source[b] + 1) * (t + draw.buckets)))) for b in range(draw.buckets)]
    rows = []
    for k, words, f in made:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{draw.seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        rows.append([k, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((r for r in rows if r[5] >= draw.least_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, -r[2], -r[1]))
    for i, r in enumerate(able[: draw.percent * len(able) // 100]):
        r[4] = i + 1
    return Counter(tuple(r[:5]) for r in rows)


def test_importance_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = QUERIES["op12_importance"](spark, sf)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == plain_resample(docs, target, importance.Draw())


@pytest.mark.parametrize("size", [importance.PIECE_BYTES, 900])
def test_importance_odd_rows(spark, odd, none, monkeypatch, size):
    """Nulls, empty texts, repeated rows, a long text in many pieces, longer runs of words, an empty target and an empty table."""
    monkeypatch.setattr(importance, "PIECE_BYTES", size)
    monkeypatch.setattr(importance, "SQL_BYTES", 4 * size)
    draw = importance.Draw(longest=3, buckets=500, least_words=3, percent=60)
    target = spark.createDataFrame([("The quick brown fox", 1), (None, 2), ("Wörter, word1 of1 word2", 3)], "text string, key int")
    want = plain_resample([(k, t) for k, t, *_ in ROWS], [r["text"] for r in target.collect()], draw)
    assert Counter(map(tuple, importance.resample(odd, target, draw=draw).collect())) == want
    if size == 900:
        return
    want = plain_resample([(k, t) for k, t, *_ in ROWS], [], draw)
    assert Counter(map(tuple, importance.resample(odd, target.limit(0), draw=draw).collect())) == want
    assert importance.resample(none, target, draw=draw).collect() == []


def test_pieces_of_long_texts_keep_all_runs():
    rng = np.random.default_rng(0)
    text = "".join(rng.choice(["ab", "é", "1", "漢"]) * int(rng.integers(1, 4)) + str(rng.choice([" ", ", ", "\n", "\x00", "!"])) for _ in range(400)).encode()
    for longest in (1, 2, 4):
        made = list(importance.pieces(text, longest, 50))
        assert len(made) > 20 and "".join(own for own, _ in made).encode() == text
        runs = Counter()
        for own, following in made:
            w, n = WORD.findall(own) + WORD.findall(following), len(WORD.findall(own))
            runs.update(" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(min(n, len(w) - k + 1)))
        w = WORD.findall(text.decode())
        assert runs == Counter(" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))


def test_ranks_do_not_depend_on_partitions(spark):
    rows = spark.createDataFrame([(i, i % 7) for i in range(500)], "key bigint, score bigint").repartition(6)
    got = importance.ranked(rows, [F.desc("score"), F.asc("key")]).collect()
    want = sorted(range(500), key=lambda i: (-(i % 7), i))
    assert sorted((r["place"], r["key"]) for r in got) == [(n + 1, i) for n, i in enumerate(want)]


# vectors


def plain_links(keys, vectors, least=0.95):
    """(key, links, component, kept) by comparing all pairs."""
    def direction(v):
        if v is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        top = max(map(abs, v))
        x = np.array(v, float) / top
        return x / np.sqrt((x * x).sum())

    unit = [direction(v) for v in vectors]
    pairs = [(i, j) for i in range(len(keys)) for j in range(i) if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least]
    links = Counter(x for p in pairs for x in p)
    root = roots(len(keys), pairs)
    least_key = {}
    for k, r in zip(keys, root, strict=True):
        if k is not None:
            least_key[r] = min(k, least_key.get(r, k))
    return Counter((k, links[i], least_key.get(r), k == least_key.get(r)) for i, (k, r) in enumerate(zip(keys, root, strict=True)))


def near(rng, base, cosine):
    """A vector with this cosine to base."""
    base = base / np.linalg.norm(base)
    other = rng.normal(size=len(base))
    other -= other @ base * base
    return cosine * base + math.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def some_vectors(dim=32):
    """Background, pairs about the threshold, two clusters joined at their rims, exact copies, a chain."""
    rng = np.random.default_rng(5)
    out = [rng.normal(size=dim) for _ in range(150)]
    for c in (0.955, 0.96, 0.97, 0.945, 0.94, 0.99, 0.999):
        out.append(near(rng, out[int(rng.integers(0, 150))], c))
    middle = rng.normal(size=dim)
    far = near(rng, middle, 0.9)
    for centre in (middle, far):
        out += [near(rng, centre, c) for c in rng.uniform(0.97, 0.999, 60)]
    out += [near(rng, middle + far, 0.999) for _ in range(2)]
    out += [middle * 2.0] * 30 + [far] * 5
    link = rng.normal(size=dim)
    for _ in range(12):
        link = near(rng, link, 0.952)
        out.append(link)
    return [x.astype(np.float32).tolist() for x in out]


@pytest.mark.parametrize("block", [2000, 7])
def test_vectors_equal_all_pairs(spark, block):
    vectors = some_vectors()
    keys = [(7 * i) % len(vectors) + 100 for i in range(len(vectors))] if len(vectors) % 7 else list(range(len(vectors)))
    rows = spark.createDataFrame(list(zip(keys, vectors, strict=True)), "vec_id bigint, embedding array<float>").repartition(3)
    tell = []
    got = neighbours.near_duplicates(rows, search=neighbours.Search(size=6, leaf=32, block=block, part=10), tell=tell)
    assert Counter(map(tuple, got.collect())) == plain_links(keys, vectors)
    assert len(tell) > 1 and tell[-1][2] >= 0.99  # saturated lists were enlarged, and the audit passed


def test_vectors_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0], "a"), (2, [2.0, 0.0, 0.0], "a"), (3, None, "a"), (4, [], "a"), (5, [0.0, 0.0, 0.0], "a"), (6, [nan, 1.0, 0.0], "a"), (7, [inf, 1.0, 0.0], "a"), (8, [None, 1.0, 0.0], "a"),
        (9, [1.0, 0.0], "a"), (10, [1e300, 1e299, 0.0], "a"), (11, [1e-300, 1e-301, 0.0], "a"), (None, [0.0, 0.0, 5.0], "b"), (12, [0.0, -0.0, 7.0], "b"), (12, [0.0, 0.0, 7.0], "b"), (None, [0.0, 1.0, 0.0], "b"), (None, None, "c"), (3, [0.0, 0.3, -1.0], "c"),
    ]
    for kind in ("double", "float"):
        data = [r for r in rows if kind == "double" or r[0] not in (10, 11)]
        df = spark.createDataFrame(data, f"vec_id bigint, embedding array<{kind}>, node string")
        got = neighbours.near_duplicates(df)
        assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
        want = Counter()
        for (k, n, c, kept), times in plain_links([r[0] for r in data], [r[1] for r in data]).items():
            want[k, n, c, kept] += times
        assert Counter(map(tuple, got.collect())) == want
        assert neighbours.near_duplicates(df.limit(0)).collect() == []
        assert neighbours.near_duplicates(df.where("vec_id IN (3, 4)")).count() == 3


def test_vectors_whole_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    got = QUERIES["op13_embeddings"](spark, "/root/testdata/sf0.001").collect()
    x = np.array([r["embedding"] for r in d], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near_ = np.argwhere(np.tril(x @ x.T >= 0.95, -1))
    root, links = roots(len(d), near_.tolist()), Counter(near_.ravel().tolist())
    assert {tuple(r) for r in got} == {(r["vec_id"], links[i], d[root[i]]["vec_id"], root[i] == i) for i, r in enumerate(d)}


def test_audit_tells_and_adds_what_is_missed(spark):
    """Without tables that bring anything together the audit finds the links, tells the recall and adds what was missed."""
    x = np.zeros((40, 8), np.float16)
    x[:, 0] = 1
    codes = spark.createDataFrame([(i, 8, bytearray(v.tobytes())) for i, v in enumerate(x)], "node bigint, dim int, half binary")
    label = spark.createDataFrame([(i, 0) for i in range(10)], "node bigint, root bigint")
    recall, missed = neighbours.audited(codes, label, neighbours.Search(audited=40), 0)
    assert recall == pytest.approx((10 * 9 / 39) / 40)
    assert {r["a"] for r in missed.collect()} == set(range(40))


def test_best_of_each():
    u, v = np.array([1, 1, 1, 1, 2]), np.array([5, 6, 5, 7, 1])
    s, fresh = np.array([0.5, 0.9, 0.5, 0.5, 0.1], np.float32), np.array([True, True, False, True, True])
    got = neighbours.best(u, v, s, fresh, 2)
    assert [x.tolist() for x in got[:2]] == [[1, 1, 2], [6, 5, 1]] and got[3].tolist() == [True, False, True]
