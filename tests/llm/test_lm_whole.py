import numpy as np
import pyarrow as pa

from gantry.llm import gru, lm


def test_first_weights_are_the_counts():
    """Groups and first weights come from the counts of all training documents; no document is drawn for them."""
    w = lm.Words([b"the", b"of", b"der", b"die", b"xyzzy"], np.array([50, 40, 30, 20, 10]), 7)
    groups = lm.fit_groups(w)
    w.group_counts = np.zeros(lm.GROUPS, np.int64)
    m = lm.first_model(w, groups)
    shares = np.exp(m.views(m.flat)["bw"][m.slot])
    assert np.allclose(shares / shares[1], np.array([7.5, 50.5, 40.5, 30.5, 20.5, 10.5]) / 50.5, rtol=1e-5)


def test_spans_hold_every_token_once():
    starts, sizes = np.array([3, 10, 40]), np.array([7, 25, 1])
    a, n = gru.spans(starts, sizes, 8)
    assert n.max() <= 8
    assert np.concatenate([np.arange(x, x + k) for x, k in zip(a, n, strict=True)]).tolist() == [*range(3, 10), *range(10, 35), 40]


def test_every_training_document_is_learnt_from(spark, monkeypatch):
    """The two rounds take every training document just once between them, and no held-out one."""
    met = []
    monkeypatch.setattr(lm, "learn", lambda docs, w, m, small: met.append((small, [r["key"] for r in docs.select("key").collect()])) or m)
    docs = spark.range(3000).selectExpr("id AS key", "concat('text ', id) AS text", "id % 7 = 2 AS held")
    lm.learnt(docs, None, None, tokens=lm.FEW_TOKENS + 1)
    assert [small for small, _ in met] == [True, False] and 0 < len(met[0][1]) < len(met[1][1])
    assert sorted(met[0][1] + met[1][1]) == [k for k in range(3000) if k % 7 != 2]


def test_rounds_and_scores_read_tokens_made_once(odd, monkeypatch):
    """No round turns texts into tokens anew: all read the one table of tokens, which holds every row's, in turn."""
    met = []
    monkeypatch.setattr(lm, "learn", lambda docs, w, m, small: met.append((docs, w)) or m)
    rows = {(r["doc_id"], r["n_tokens"]) for r in lm.score(odd).collect()}
    files = {f for docs, _ in met for f in docs.inputFiles()}
    assert len(met) > 1 and files and all("/tokens-" in f for f in files)
    made = met[0][0].sparkSession.read.parquet(next(iter(files)).rsplit("/", 1)[0]).collect()
    assert {(r["key"], r["n_tokens"]) for r in made} == rows and all(len(r["text"]) == r["n_tokens"] * lm.TOKEN.itemsize for r in made)
    encoder = lm.Encoder(met[0][1])
    of_key = {r["doc_id"]: r["text"] or "" for r in odd.select("doc_id", "text").collect()}
    for r in made:
        if r["key"] is not None and made.count(r) == 1 and sum(x["key"] == r["key"] for x in made) == 1:
            assert np.frombuffer(r["text"], lm.TOKEN).tolist() == encoder(pa.array([of_key[r["key"]]])).token.tolist()


def test_tokens_lie_side_by_side():
    """Batches of tokens are brought together up to a bound; rows, places and numbers stay right, in slices too."""
    texts = [np.arange(n, dtype=lm.TOKEN) for n in (3, 1, 700, 2)]
    batch = pa.record_batch([pa.array(range(4)), pa.array([x.tobytes() for x in texts], pa.binary())], ["row", "text"])
    (rows, token, starts, sizes), = lm.side_by_side(iter([batch.slice(1), batch.slice(0, 1)]))
    assert rows["row"].to_pylist() == [1, 2, 3, 0] and sizes.tolist() == [1, 700, 2, 3] and starts.tolist() == [0, 1, 701, 703]
    assert token.tolist() == np.concatenate([texts[i] for i in (1, 2, 3, 0)]).tolist()


def test_class_scores_hold_to_a_plain_softmax():
    """Products of all classes with one class's words, in blocks of rows, give what the definition gives."""
    rng = np.random.default_rng(2)
    m = gru.Model(100, 4)
    m.set_slots(rng.permutation(100))
    p = m.views(m.flat)
    states, target = rng.normal(size=(5000, m.hidden)).astype(np.float32), np.minimum(rng.integers(0, 208, 5000), 103)
    got, _ = gru.class_scores(m, p, states, target)
    classes = states @ p["wc"] + p["bc"]
    words = (states @ p["ww"].T + p["bw"]).reshape(len(states), -1, gru.IN_CLASS)
    of, rows = m.class_of(target), np.arange(len(target))
    want = classes[rows, of] - np.log(np.exp(classes).sum(axis=1))
    own = np.flatnonzero(target < m.words)
    inner = words[own, of[own]]
    want[own] += inner[np.arange(len(own)), m.slot[target[own]] % gru.IN_CLASS] - np.log(np.exp(inner).sum(axis=1))
    assert np.allclose(got, want, atol=1e-4)
