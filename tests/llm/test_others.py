import hashlib
import itertools
import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gantry.llm import media, packing, pieces, quality, substring, token_files, url_filter, warc
from gantry.llm.common import new_dir
from gantry.llm.queries import ORACLES, QUERIES, RULES
from tests.llm.conftest import ROWS
from tests.llm.test_edges import plain_cuts
from tests.oracle import compare

WORD, PIECE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_duckdb(spark, name):
    compare(spark, QUERIES[name], ORACLES[name], "/root/testdata/sf0.001")


# quality


def test_quality_odd_rows(spark, odd, none):
    got = quality.measure(odd).collect()
    assert len(got) == len(ROWS)
    by = {r["doc_id"]: r for r in got}
    assert (by[3]["n_words"], by[3]["kept"], by[4]["n_words"], by[5]["word_chars"], by[6]["n_symbols"]) == (0, False, 0, 0, 3)
    assert by[7]["n_words"] == 120_000 and by[7]["n_repeat_words"] == 0 and by[7]["kept"]
    assert by[1]["n_repeat_words"] == by[1]["n_words"] and by[1]["base_failed"]
    kept = quality.keep(odd)
    assert kept.columns == odd.columns and [r["doc_id"] for r in kept.collect()] == [7, 7]
    assert quality.measure(none).collect() == [] and quality.keep(none).collect() == []


@pytest.mark.parametrize("window", [quality.WINDOW_HASH, "shiftleft(xxhash64(q_words[i]), 62)"])
def test_repeated_words(spark, window, monkeypatch):
    """Also where the hashes of unlike windows meet."""
    monkeypatch.setattr(quality, "WINDOW_HASH", window)
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(list("abcd"), n)) for n in (1, 2, 3, 5, 12, 40, 90)]
    got = dict(quality.measure(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).select("doc_id", "n_repeat_words").collect())
    for i, t in enumerate(texts):
        w = t.split()
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        assert got[i] == len({k + j for k, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)})


def test_cascade_skips_what_later_rules_need(spark):
    """A row that the first rule rejects has null for all statistics that only later rules read."""
    texts = spark.createDataFrame([("too short !!",), ("a b c " * 40,), (" ".join(f"w{i}" for i in range(80)),)], "q_text string")
    rules = {r.name: r for r in quality.RULES}
    order = tuple(rules[n] for n in ("few_words", "repeated_words", "exclamations", "repeated_lines"))
    got = [r.asDict() for r in quality.cascade(texts, order).collect()]
    assert [r["q_rejected"] for r in got] == ["few_words", "repeated_words", None]
    late = ("n_repeat_words", "n_exclamations", "n_lines", "n_dup_lines")
    assert [[r[c] is None for c in late] for r in got] == [[True] * 4, [False, True, True, True], [False] * 4]
    plan = quality.keep(texts.withColumnRenamed("q_text", "text"), rules=order)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rules_in_order_of_rejection_per_cost(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    first = [r.name for r in quality.order_rules(docs, "text")]
    again = [r.name for r in quality.order_rules(docs.repartition(7), "text")]
    assert first == again and sorted(first) == sorted(r.name for r in quality.RULES)
    # dear and cheap rules that both reject, and rules that never do
    always = quality.QualityRule("always", "true", ("n_words",))
    never = quality.QualityRule("never", "false", ("n_words",))
    assert [r.name for r in quality.order_rules(docs, "text", (never, always))] == ["always", "never"]
    assert first.index("few_words") < first.index("repeated_words")


# url filters


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://A.COM/en/x?q=/en/"), (4, "https://example.com/en/77"), (5, "http://notcom/en/"), (6, "http://www.bad.io/p.html/"), (7, "http://bad.io/p?x#y"), (8, "http://bad.io/other"), (8, "http://bad.io/other")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, host string")
    listed = spark.createDataFrame([("https://bad.io/p",), (None,), ("https://bad.io/p",)], "url string")
    for blocks in (1, 64):
        got = url_filter.filter_urls(pages, listed, RULES, blocks=blocks).collect()
        assert sorted((r["page_id"], r["host"], r["rule"], r["verdict"]) for r in got if r["page_id"] != 8) == [(1, "", None, "allow"), (2, "", None, "allow"), (3, "a.com", "com/en/", "block"), (4, "example.com", "example.com/en/7", "allow"), (5, "notcom", None, "allow"), (6, "www.bad.io", None, "block"), (7, "bad.io", None, "block")]
        assert [r["verdict"] for r in got if r["page_id"] == 8] == ["allow", "allow"]
    assert url_filter.filter_urls(pages.limit(0), listed.limit(0), RULES).collect() == []


# warc


def test_warc(spark, tmp_path):
    big = "b" * 1500
    rows = [(1, "http://x/1\r\nX: y", big), (5, None, big), (3, "http://x/3", "small"), (4, "http://x/%0D", "small"), (6, "u", None), (None, "u", big), (5, None, big)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, html string, digest string").repartition(2)
    got = sorted(warc.round_trip(pages).collect(), key=str)
    digest = hashlib.sha1(big.encode()).hexdigest()
    kinds = {(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got}
    assert len(got) == 7 and kinds == {(1, "revisit", 5, 1500), (5, "response", None, 1500), (3, "response", None, 5), (4, "response", None, 5), (6, "response", None, 0), (None, "revisit", 5, 1500)}
    assert {r["payload_digest"] for r in got if r["payload_bytes"] == 1500} == {digest}
    paths = warc.archive(pages, new_dir(spark, "warc-test"))
    every = warc.read(spark, paths)
    assert {r["target_uri"] for r in every.collect()} == {"http://x/1\r\nX: y", None, "http://x/3", "http://x/%0D", "u"}
    some = warc.read(spark, paths, payload=True).where("record_type = 'response' AND target_uri LIKE 'http://x/3%'")
    assert [bytes(r["payload"]) for r in some.collect()] == [b"small"]
    reader = warc.WarcReader({"paths": json.dumps(paths), "payload": "true"})
    assert list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit")])) == []
    read = [x for p in reader.partitions() for b in reader.read(p) for x in b.to_pylist()]
    assert len(read) == 2 and all(x["payload"] is None for x in read)
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_warc_members_without_lengths(tmp_path):
    import gzip
    import io

    records = [warc.record("response", f"urn:page:{i}", "http://x", "d", bytes([65 + i]) * (i * 5000), i * 5000, None) for i in range(6)]
    m = warc.Members(io.BytesIO(b"".join(gzip.compress(r) for r in records)))
    seen = []
    while m.open():
        seen.append(warc.headers(m.upto(b"\r\n\r\n"))["warc-record-id"])
        m.close()
    assert seen == [f"<urn:page:{i}>" for i in range(6)]


# media


def test_media(odd, none):
    got = media.media_columns(odd).collect()
    assert len(got) == len(ROWS)
    texts = {r[0]: r[1] for r in ROWS}
    for r in got:
        payload, n = media.padded(texts[r["doc_id"]])
        stored = media.to_png(payload)
        want = (n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), media.feature(payload), "png", 192, len(payload) // 192)
        assert tuple(r[c] for c in ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "format", "width", "height")) == want
        assert media.from_png(stored) == payload
    assert media.media_columns(none).collect() == []


def test_media_shards_are_tar(spark, odd, tmp_path):
    import tarfile

    rows = media.write_shards(odd, f"file://{tmp_path}/m").collect()
    for shard in {r["shard"] for r in rows}:
        with tarfile.open(tmp_path / "m" / shard) as t:
            names = t.getnames()
            assert len(names) == len(set(names)) and set(names) == {f"{r['digest']}.png" for r in rows if r["shard"] == shard}


# packing


def test_plan_is_sound_and_close():
    rng = np.random.default_rng(3)
    for cap, close in ((packing.Capacity(), 1.01), (packing.Capacity(documents=5), 1.4), (packing.Capacity(attention=2_200_000, score="dot", weights=(1.0, 1.0, 1.0)), 1.4)):
        lengths = np.concatenate([rng.integers(1, 1400, 900), np.full(400, 300), rng.integers(1, 60, 700)])
        size, n = np.unique(lengths, return_counts=True)
        layout = packing.plan(dict(zip(size.tolist(), n.tolist(), strict=True)), cap)
        bins = {}
        for length, count in zip(size.tolist(), n.tolist(), strict=True):
            s, o = packing.place(layout, np.full(count, length), np.arange(count))
            for a, b in zip(s.tolist(), o.tolist(), strict=True):
                bins.setdefault(a, []).append((b, length))
        for own in bins.values():
            own.sort()
            assert [o for o, _ in own] == np.cumsum([0, *[x for _, x in own[:-1]]]).tolist()
            need = sum(packing.need_of(x) for _, x in own)
            assert (need <= cap.limits()).all()
        bound = max(-(-int(lengths.sum()) // cap.tokens), -(-len(lengths) // cap.documents), -(-int((lengths**2).sum()) // cap.attention))
        assert layout["sequences"] == len(bins) and len(bins) <= close * bound + 2


def test_pack_odd_rows(spark, odd, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD)
    got = packing.pack(odd, WORD).collect()
    want = []
    for key, text, *_ in ROWS:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(key, n, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())) for n, at in enumerate(range(0, len(ids), 2048))]
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, want))
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)
    assert packing.pack(none, WORD).collect() == []


@pytest.mark.parametrize("literal", [False, True])
def test_word_tokenizer(literal):
    """As the tokenizer itself; with `literal`, the names of its special tokens are mere text."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD)
    t.encode_special_tokens = literal
    texts = ["ΣΑΣ foo's 12ab3 a.b, x!! don't… İstanbul é́ <|endoftext|> ﬁ naïve nbsp \x1c y \x85z '.' ...", "", "́a ² ½ 漢字,", "ABC.,; abc ABC", "x" * 300]
    texts += ["a <|endoftext|> b", "a<|startoftext|>b<|endoftext|>", "<|ENDOFTEXT|>. <|endoftext|>."]
    ids, bounds = packing.WordTokenizer(WORD, literal).encode_all(pa.array(texts))
    assert [ids[a:z].tolist() for a, z in zip(bounds[:-1], bounds[1:], strict=True)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_packed_special_tokens(spark):
    from tokenizers import Tokenizer

    t, text = Tokenizer.from_file(WORD), "a <|endoftext|> b <|startoftext|>"
    ids = np.array([*t.encode(text, add_special_tokens=False).ids, 0], "<u4")
    [r] = packing.pack(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), WORD).collect()
    assert (r["length"], r["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))


# token files


@pytest.mark.parametrize("block", [4 << 20, 514])
def test_token_counts(odd, none, block):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD)
    want = sorted((str(k), len(t.encode(x or "", add_special_tokens=False).ids)) for k, x, *_ in ROWS)
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in token_files.counted(odd, WORD, block_bytes=block).collect()) == want
    assert token_files.counted(none, WORD).collect() == []


def test_open_document_is_told(spark, tmp_path):
    (tmp_path / "a").write_bytes(np.array([1, 2, 9, 9, 3], "<u2").tobytes())
    files = spark.createDataFrame([(f"file://{tmp_path}/a", 10), (f"file://{tmp_path}/none", 0)], "path string, bytes bigint")
    for block in (2, 4, 64):
        assert sorted((r["ordinal"], r["n_tokens"], r["closed"]) for r in token_files.count_tokens(files, 9, block).collect()) == [(0, 2, True), (1, 0, True), (2, 1, False)]


# pieces


def best(word, scores, unknown):
    """Plain dynamic programme over characters."""
    table = [(0.0, [])] + [None] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(end):
            if word[start:end] in scores or end - start == 1:
                s = table[start][0] + scores.get(word[start:end], unknown)
                if table[end] is None or s > table[end][0]:
                    table[end] = (s, [*table[start][1], word[start:end]])
    return table[-1]


def best_of_long(word, scores, unknown, deepest):
    """As best, for long words: back pointers, and no piece longer than the longest."""
    total, came = [0.0] + [-np.inf] * len(word), [0] * (len(word) + 1)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - deepest), end):
            if word[start:end] in scores or end - start == 1:
                s = total[start] + scores.get(word[start:end], unknown)
                if s > total[end]:
                    total[end], came[end] = s, start
    path, end = [], len(word)
    while end:
        path.append(word[came[end] : end])
        end = came[end]
    return path[::-1]


def test_viterbi_is_best():
    names, stored, types = pieces.read_model(PIECE)
    m = pieces.Unigram(names, pieces.rank_scores(stored), types)
    scores = {p: float(s) for p, s, t in zip(names, m.scores, types, strict=True) if t == pieces.NORMAL}
    words = ["hello", "Ungeheuerlichkeit", "ción.\nnueva", "a", "漢字x", "\U0001f600", "zzzzqqqq", "the!!"]
    for w, ids in zip(words, m.segment([(pieces.MARK + w).encode() for w in words]), strict=True):
        got = [names[i] for i in np.frombuffer(ids, "<u4")]
        want = best(pieces.MARK + w, scores, float(m.unknown))
        plain = [x if x in scores else [f"<0x{b:02X}>" for b in x.encode()] for x in want[1]]
        assert got == [y for x in plain for y in ([x] if isinstance(x, str) else x)]


def test_whole_documents_and_unspaced_text_are_segmented_best(spark):
    """Every document of a table, and long text without spaces, both ways of walking against the plain programme."""
    names, stored, types = pieces.read_model(PIECE)
    m = pieces.Unigram(names, pieces.rank_scores(stored), types)
    scores = {p: float(s) for p, s, t in zip(names, m.scores, types, strict=True) if t == pieces.NORMAL}
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    rng = np.random.default_rng(8)
    texts += ["".join(rng.choice(list("abcdeghilnorstu漢字語ßé😀"), 3000)), "漢字" * 500, "a" * 4000]
    deepest, seen = max(map(len, scores)), {}
    for text, ids in zip(texts, m.encode_all(texts), strict=True):
        if not text:
            assert ids == b""
            continue
        got, at = [names[i] for i in np.frombuffer(ids, "<u4")], 0
        for unit in pieces._units(text):
            unit = pieces.MARK + unit.replace(" ", pieces.MARK)
            if unit not in seen:
                path = best_of_long(unit, scores, float(m.unknown), deepest)
                seen[unit] = [y for x in path for y in ([x] if x in scores else [f"<0x{b:02X}>" for b in x.encode()])]
            want = seen[unit]
            own = got[at : at + len(want)]
            at += len(want)
            if own != want:  # another path of the same score
                assert sum(scores.get(x, 0.0) for x in own) == pytest.approx(sum(scores.get(x, 0.0) for x in want)) and "".join(own) == "".join(want)
        assert at == len(got)
    units = [(pieces.MARK + w).encode() for t in texts[-3:] for w in (t, t[:700])]
    assert [m._alone(u) for u in units] == m._viterbi(units)


def test_pieces_round_trip(odd, none):
    got = pieces.encode(odd, PIECE).collect()
    assert len(got) == len(ROWS) and all(r["round_trip"] for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[3]["n_pieces"] == by[4]["n_pieces"] == 0 and by[6]["n_bytes"] > 0 and len(by[7]["ids"]) == by[7]["n_pieces"]
    assert pieces.encode(none, PIECE).collect() == []
    names, stored, types = pieces.read_model(PIECE)
    m = pieces.Unigram(names, pieces.rank_scores(stored), types)
    for t in (" a  b ", "   ", "x\ty\n", "▁ is a marker"):
        assert m.decode(next(m.encode_all([t]))) == t.replace("▁", " ")


# substring dedup


def plain_dedupe(rows, least=15):
    """One text after the other, chunk by chunk, from the cuts alone."""
    seen, out = set(), {}
    for key, text in rows:
        raw = (text or "").encode()
        cuts = [*plain_cuts(raw), len(raw)]
        pieces = [raw[a:z] for a, z in itertools.pairwise(cuts)]
        gone = set()
        for i in range(len(pieces)):
            for z in range(i + 1, len(pieces) + 1):
                chunk = b"".join(pieces[i:z])
                if len(chunk.split()) >= least:
                    if chunk.rstrip() in seen:
                        gone.update(range(i, z))
                    seen.add(chunk.rstrip())
                    break
        kept = raw[: cuts[0]]
        for i, piece in enumerate(pieces):
            if i not in gone:
                kept += piece
        out[key] = kept.decode()
    return out


@pytest.mark.parametrize("heat", [1, 3, substring.PAGES_A_HEAT])
def test_substring(spark, odd, none, monkeypatch, heat):
    monkeypatch.setattr(substring, "PAGE_BYTES", 3000)
    monkeypatch.setattr(substring, "PAGES_A_HEAT", heat)
    rng = np.random.default_rng(4)
    vocabulary = [f"wörd{i}" for i in range(5000)]
    passage = " ".join(rng.choice(vocabulary, 60))
    rows = []
    for i in range(40):
        words = list(rng.choice(vocabulary, 120))
        if i % 3 == 0:
            words.insert(int(rng.integers(0, 120)), passage)
        rows.append((i, " ".join(words), i))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, digests bigint").repartition(4)
    got = substring.dedupe(docs)
    assert got.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert texts == plain_dedupe([r[:2] for r in rows])
    for i, text, _ in rows:
        if i % 3 or i == 0:
            assert texts[i] == text
        else:
            assert len(text.split()) - len(texts[i].split()) > 40
    out = substring.dedupe(odd)
    assert out.columns == odd.columns and out.count() == len(ROWS)
    by = {}
    for r in out.collect():
        by.setdefault(r["doc_id"], []).append(r["text"])
    assert by[3] == [None] and by[4] == [""] and sorted(map(len, by[7]))[1] == len(ROWS[6][1]) and min(map(len, by[7])) < 100
    assert substring.dedupe(none).collect() == [] and substring.dedupe(none, report=True).collect() == []


def test_passages_of_51_words_go(spark):
    """At any place, of texts with many and with few distinct words; texts that share shorter pieces only stay as they are."""
    rng = np.random.default_rng(9)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").where("text IS NOT NULL").orderBy("doc_id")
    words = " ".join(r[0] for r in docs.collect()).split()
    rows, planted, clean = [], [], []
    for i in range(400):
        size = 51 if i % 2 else 90
        at = int(rng.integers(0, len(words) - size))
        passage = words[at : at + size]
        for key in (3 * i, 3 * i + 1):
            own = [f"{x:x}" for x in rng.integers(0, 1 << 40, 60)]
            cut = int(rng.integers(0, 61))
            rows.append((key, " ".join([*own[:cut], *passage, *own[cut:]])))
        planted.append((3 * i, 3 * i + 1, size))
        short = int(rng.integers(0, len(words) - 14))
        rows.append((3 * i + 2, " ".join([*[f"{x:x}" for x in rng.integers(0, 1 << 40, 40)], *words[short : short + 14]])))
        clean.append(3 * i + 2)
    got = {r["doc_id"]: r["n_removed_words"] for r in substring.dedupe(spark.createDataFrame(rows, "doc_id bigint, text string"), report=True).collect()}
    shares = np.array([(got[b]) / size for a, b, size in planted])
    assert (shares >= 0.5).mean() >= 0.99 and shares.mean() >= 0.85
    assert all(got[k] == 0 for k in clean)


def test_cuts_resist_insertions():
    words = [f"w{i * 7919 % 1000}" for i in range(400)]
    gear = substring.gear_table()

    def made(words):
        text = " ".join(words).encode()
        c = substring.Chunks(text, gear)
        return {text[a:z].rstrip() for a, z in zip(c.start.tolist(), c.end.tolist(), strict=True)}, set(c.digest.tolist())

    a, b = made(words), made([*words[:200], "inserted", *words[200:]])
    assert len(a[0] - b[0]) <= 3  # pieces between cuts
    assert len(a[1] - b[1]) <= substring.MIN_WORDS  # chunks that lie over the place


# the pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = p.quality_rules(spark, docs, "")
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {r["doc_id"] for r in quality.measure(docs).where("kept").select("doc_id").collect()}
    out = p.run(spark, "/root/testdata/sf0.001")
    assert 0 < out.select("doc_id").distinct().count() <= kept.count()
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()
