import math
import zlib
from collections import Counter

import numpy as np
import pytest

from gantry.llm import gru, lm
from gantry.llm.common import words_of
from tests.llm.conftest import ROWS


def test_gradients():
    rng = np.random.default_rng(0)
    m = gru.Model(70, 3, hidden=5)
    m.flat = m.flat.astype(np.float64)
    m.set_slots(rng.permutation(70))
    sizes = np.array([7, 4, 3, 9, 2])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    tokens = rng.integers(0, 73, size=sizes.sum())

    class Grab:
        def step(self, flat, grad):
            self.grad = grad.copy()

    grab = Grab()
    gru.train(m, tokens, starts, sizes, grab, 2, 100)
    for i in rng.choice(np.flatnonzero(m.flat > -1e3), 80, replace=False):
        was, e = m.flat[i], 1e-3
        m.flat[i] = was + e
        up = -gru.score(m, tokens, starts, sizes, 2, 100).astype(np.float64).mean()
        m.flat[i] = was - e
        down = -gru.score(m, tokens, starts, sizes, 2, 100).astype(np.float64).mean()
        m.flat[i] = was
        assert grab.grad[i] == pytest.approx((up - down) / (2 * e), abs=3e-4, rel=0.02)


def test_score_does_not_depend_on_windows():
    rng = np.random.default_rng(1)
    m = gru.Model(100, 4)
    sizes = rng.integers(1, 200, 30)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    tokens = rng.integers(0, 104, sizes.sum())
    a, b = gru.score(m, tokens, starts, sizes, 7, 13), gru.score(m, tokens, starts, sizes, 512, 64)
    assert np.allclose(a, b, atol=1e-4)


def test_probabilities_sum_to_one():
    m = gru.Model(100, 4)
    starts, sizes = np.array([0]), np.array([3])
    total = sum(math.exp(gru.score(m, np.array([5, 9, t]), starts, sizes)[2]) for t in range(104))
    assert total == pytest.approx(1, abs=1e-3)


def held_out(key):
    return zlib.crc32(b"" if key is None else str(key).encode()) % 7 == 2


def base(rows):
    tokens = {i: words_of(r[1]) + [b""] for i, r in enumerate(rows)}
    counts = Counter()
    for i, r in enumerate(rows):
        if not held_out(r[0]):
            counts.update(tokens[i])
    n, v = sum(counts.values()), len(counts)
    return [(r[0], held_out(r[0]), len(tokens[i]), sum(counts[w] > 0 for w in tokens[i]), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens[i])) for i, r in enumerate(rows)]


@pytest.mark.parametrize("head", [1 << 17, 40])
def test_base_scores(odd, head, monkeypatch):
    monkeypatch.setattr(lm, "HEAD_WORDS", head)
    got = sorted(lm.score(odd).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"]))
    want = sorted(base(ROWS), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    for g, w in zip(got, want, strict=True):
        assert (g["doc_id"], g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == w[:5]
        assert g["base_score"] == pytest.approx(w[5], rel=1e-9)
        assert math.isfinite(g["score"]) and g["score"] < 0


def test_no_training_rows(spark):
    """All rows held out: N and V are 0, so every token's base probability is (0 + 1) / (0 + 1 * (0 + 1))."""
    keys = [k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2][:3]
    rows = spark.createDataFrame([(k, "some words here") for k in keys[:2]] + [(keys[2], None)], "doc_id bigint, text string")
    got = lm.score(rows).collect()
    assert sorted((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got) == [(k, True, 4 if k != keys[2] else 1, 0, 0, 0.0) for k in keys]
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)


def test_empty(none):
    assert lm.score(none).collect() == []


def test_beats_counts_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = [r for r in lm.score(docs).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.97 * sum(r["base_score"] for r in held)
