"""Edge cases and plain second opinions for the operators of this package."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from gantry.llm import common, lm, media, packing, simhash, substring, token_files, url_filter, warc
from gantry.llm.queries import RULES

WORD = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def best_fit(lengths, room):
    """Bins that plain best-fit decreasing opens, piece by piece."""
    left = np.zeros(0, np.int64)
    for n in sorted(lengths, reverse=True):
        fits = np.flatnonzero(left >= n)
        if len(fits):
            left[fits[left[fits].argmin()]] -= n
        else:
            left = np.append(left, room - n)
    return len(left)


def test_packing_of_a_whole_table(spark):
    """Every piece once, sequences of 2,048 at most, no gaps, and no more of them than plain best-fit opens."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    t, want = Tokenizer.from_file(WORD), []
    for key, text in docs.select("doc_id", "text").collect():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(key, n, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())) for n, at in enumerate(range(0, len(ids), 2048))]
    got = packing.pack(docs, WORD).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *[n for _, n in own[:-1]]]).tolist() and sum(n for _, n in own) <= 2048
    assert len(bins) <= best_fit([w[3] for w in want], 2048)


def test_half_an_id_is_not_read(spark, tmp_path):
    (tmp_path / "odd").write_bytes(np.array([1, 2, 9, 3], "<u2").tobytes() + b"\x01")
    files = spark.createDataFrame([(f"file://{tmp_path}/odd", 9)] * 2, "path string, bytes bigint")
    for block in (1, 3, 5, 64):
        got = token_files.count_tokens(files, 9, block).collect()
        assert sorted((r["ordinal"], r["n_tokens"], r["closed"]) for r in got) == [(0, 2, True), (1, 1, False)]


def test_plain_warc_files_are_not_listed(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "x" * 2000), (2, "http://b/", "x" * 2000), (3, None, None)], "page_id bigint, url string, html string")
    files = warc.archive(pages, f"file://{tmp_path}/w")
    (tmp_path / "w" / "other.warc").write_bytes(b"WARC/1.1\r\n\r\n")
    warc.register(spark)
    got = spark.read.format("warc").load(f"file://{tmp_path}/w")
    assert got.count() == 3 and len(files) >= 1
    by_type = dict(got.groupBy("record_type").count().collect())
    assert by_type == {"response": 2, "revisit": 1}
    pushed = got.where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" not in pushed or "record_type" in pushed


def test_url_filter_with_clashing_columns(spark, none):
    pages = spark.createDataFrame([(1, "http://www.bad.io/p", 7, 8, "x"), (2, "http://good.io/", 7, 8, "y"), (3, None, None, None, None)], "page_id bigint, url string, block int, lane0 bigint, canon string")
    got = url_filter.filter_urls(pages, pages.where("page_id = 1"), RULES)
    assert sorted((r["page_id"], r["verdict"]) for r in got.collect()) == [(1, "block"), (2, "allow"), (3, "allow")]
    assert url_filter.filter_urls(pages.limit(0), pages, RULES).collect() == []
    assert url_filter.blocks_for(10) == 64 and url_filter.blocks_for(10**6) == 1 << 16 and url_filter.blocks_for(10**12) == url_filter.MOST_BLOCKS


def test_keys_of_substring_dedup_are_numbers(spark):
    docs = spark.createDataFrame([("a", "one two")], "doc_id string, text string")
    with pytest.raises(TypeError, match="whole numbers"):
        substring.dedupe(docs)


def plain_cuts(text):
    """Starts of pieces: the gear hash of the 16 bytes before a word, byte by byte."""
    gear, cuts, since = [xxhash.xxh32_intdigest(bytes([b]), 42) for b in range(256)], [], 0
    for i, b in enumerate(text):
        if b in b" \t\n\v\f\r" or i and text[i - 1] not in b" \t\n\v\f\r":
            continue
        h = 0
        for x in text[max(0, i - 16) : i]:
            h = (2 * h + gear[x]) % (1 << 32)
        low = i >= 16 and h >> 8 < (1 << 24) // substring.MEAN_WORDS
        since = 0 if low or not cuts else since + 1
        if not cuts or low or since > 8:
            cuts.append(i)
    return cuts


def test_chunks_byte_by_byte():
    rng = np.random.default_rng(8)
    words = [f"wörd{i}" for i in range(500)]
    for n, kinds in ((0, 500), (1, 500), (30, 500), (400, 500), (60, 1), (60, 2)):
        text = ("  " + " ".join(rng.choice(words[:kinds], n)) + "\n").encode()
        made = substring.Chunks(text, substring.gear_table())
        assert made.start.tolist() == plain_cuts(text)
        assert made.words.sum() == len(text.split())


def test_equal_payloads_have_one_address(spark):
    docs = spark.createDataFrame([(i, "same text" if i % 3 else f"text {i}") for i in range(60)], "doc_id bigint, text string").repartition(6)
    folder = common.new_dir(spark, "media-test")
    rows = common.durable(media.write_shards(docs, folder), "media-test-rows")
    assert rows.where("n_bytes = 9").select("shard").distinct().count() > 1
    got = media.features(media.addressed(rows), folder)
    assert got.where("n_bytes = 9").select("shard", "offset").distinct().count() == 1
    assert got.count() == 60 and got.where("payload_sha256 <> digest").count() == 0


def test_png_by_the_letter():
    """Signature, chunks with their CRCs, filter byte 0 before each row: read without the operator's own reader."""
    payload, n = media.padded("Ünïcödé " * 90)
    stored = media.to_png(payload)
    assert stored[:8] == b"\x89PNG\r\n\x1a\n" and n == len(("Ünïcödé " * 90).encode())
    at, seen, data = 8, [], b""
    while at < len(stored):
        size, kind = int.from_bytes(stored[at : at + 4], "big"), stored[at + 4 : at + 8]
        body = stored[at + 8 : at + 8 + size]
        assert int.from_bytes(stored[at + 8 + size : at + 12 + size], "big") == zlib.crc32(kind + body)
        seen.append(kind)
        data += body if kind == b"IDAT" else b""
        at += 12 + size
    raw = zlib.decompress(data)
    assert seen == [b"IHDR", b"IDAT", b"IEND"] and len(raw) == len(payload) // 192 * 193
    assert b"".join(raw[i + 1 : i + 193] for i in range(0, len(raw), 193)) == payload


def test_seed_of_the_model_does_not_follow_row_order(spark):
    docs = spark.createDataFrame([(i, f"text {i} " + "x " * (50_000 if i == 7 else 5)) for i in range(300)], "key bigint, text string")
    docs = docs.withColumn("held", lm.held_out(F.col("key")))
    a = lm.seed_texts(docs, 20)
    assert a == lm.seed_texts(docs.orderBy(F.desc("key")), 20) and len(a) == 20
    assert max(map(len, lm.seed_texts(docs, 1000))) == lm.WARM_CHARS


def test_split_is_one_for_all_types(spark):
    docs = spark.createDataFrame([(1.5, "a b"), (2.0, "a c"), (None, "d")], "doc_id double, text string")
    got = {r["doc_id"]: r["held_out"] for r in lm.score(docs).collect()}
    assert got == {1.5: zlib.crc32(b"1.5") % 7 == 2, 2.0: zlib.crc32(b"2.0") % 7 == 2, None: False}


def test_common_long_words_go_to_the_tasks(spark):
    long, odd = b"u" * 60, b"v" * 2000
    counts = spark.createDataFrame([(bytearray(long), 50), (bytearray(odd), 60), (bytearray(b"a"), 5), (bytearray(b""), 9)], "word binary, n bigint")
    w = lm.frequent(counts)
    assert (w.words, w.counts.tolist(), w.ends) == ([long, b"a"], [50, 5], 9)


def plain_components(sets, least):
    """Labels by comparing all pairs."""
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= least * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_dense_candidates_equal_all_pairs(spark, monkeypatch):
    """Many versions of one template, their similarities about the threshold: components as if every pair were compared."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(3000)]
    base, rows = rng.choice(words, 150), []
    for i in range(90):
        own = base.copy()
        at = rng.integers(0, 150, int(rng.integers(1, 5)))
        own[at] = rng.choice(words, len(at))
        rows.append((i, " ".join(own)))
    rows += [(100 + i, " ".join(rng.choice(words, 150))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for _, t in rows]
    label = plain_components(sets, 0.8)
    want = {rows[i][0]: rows[x][0] for i, x in enumerate(label)}
    assert 1 < len(set(label)) < len(rows)
    for dense, block in ((2, 2000), (0, 16)):
        monkeypatch.setattr(simhash, "DENSE", dense)
        monkeypatch.setattr(simhash, "MOST_IN_BLOCK", block)
        assert dict(simhash.near_copies(docs).collect()) == want


def test_links_of_a_block_join_what_is_alike():
    rng = np.random.default_rng(6)
    sets = []
    for _ in range(60):
        base = sets[-1] if sets and rng.random() < 0.7 else rng.integers(1, 1 << 62, int(rng.integers(0, 80))).astype(np.uint64)
        gone = rng.random(len(base)) < 0.1
        sets.append(np.unique(np.append(base[~gone], rng.integers(1, 1 << 62, int(gone.sum())).astype(np.uint64))))
    n = len(sets)
    for across in (False, True):
        part = np.arange(n) % 2 if across else np.zeros(n, np.int64)
        a, b = simhash.block_links(sets, np.arange(n), part, across, 0.8)
        got = simhash.root_labels(n, a, b)
        pairs = [(i, j) for i in range(n) for j in range(i) if not across or part[i] != part[j]]
        alike = [(i, j) for i, j in pairs if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j])) - 1e-9]
        want = simhash.root_labels(n, *np.array(alike).T)
        assert np.array_equal(got, want)


def test_stages_on_empty_and_odd_tables(spark):
    import corpus_pipeline as p

    text = " ".join(f"word{i} of{i % 97}" for i in range(200))
    rows = [(1, text, "en", "a", 9, 1), (2, text, "en", "a", 9, 2), (2, text, "en", "a", 9, 2), (3, None, None, None, None, 3), (4, "", "en", "a", 0, 4), (None, text + " end", "en", "b", 9, 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, component bigint")
    for name, stage in p.STAGES:
        assert stage(spark, docs.limit(0), SF).collect() == []
        if name != "packed":
            assert stage(spark, docs, SF).columns == docs.columns
    ids = lambda df: sorted(str(r["doc_id"]) for r in df.collect())
    assert ids(p.quality_rules(spark, docs, SF)) == ["1", "2", "2", "None"]
    assert ids(p.near_duplicates(spark, docs, SF)) == ["1", "3", "None"]
    assert ids(p.repeated_passages(spark, docs, SF)) == ["1", "None"]  # the last one keeps its own closing words
    assert ids(p.packed(spark, docs, SF)) == ["1", "2", "2", "3", "4", "None"]


def test_a_shared_folder_is_asked_for_on_clusters():
    class Far:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "spark://somewhere:7077"

            class _jsc:
                @staticmethod
                def sc():
                    class Unset:
                        @staticmethod
                        def getCheckpointDir():
                            class No:
                                isDefined = staticmethod(lambda: False)

                            return No

                    return Unset

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Far)


def test_shelf_outlives_the_package():
    common.shelf("test")["x"] = pa
    assert common.shelf("test")["x"] is pa


@pytest.mark.parametrize("part", ["low", "high"])
def test_half_a_digest_removes_nothing(spark, monkeypatch, part):
    """Chunks whose digests agree in one half only are different chunks, and no text is cut."""
    of = xxhash.xxh3_128_digest

    def half(data):
        made = of(data)
        return bytes(8) + made[8:] if part == "low" else made[:8] + bytes(8)

    monkeypatch.setattr(substring.xxhash, "xxh3_128_digest", half)
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10_000, 200)) for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate([*texts, texts[3]])), "doc_id bigint, text string")
    left = dict(substring.dedupe(docs).select("doc_id", "text").collect())
    assert [left[i] for i in range(12)] == texts and len(left[12].split()) < 20
