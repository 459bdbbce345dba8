"""Words of a whole Arrow column at once: where they are, and which are equal, without a Python object for each."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Keeps the first n of 8 bytes, for n = 0..8 (little-endian).
_FIRST = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls; offsets from 0."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def index_words(column: pa.Array, lower: bool = False) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, the number of each word in turn among them, bounds of each row's words).

    Words are runs of bytes other than the six white-space bytes; with `lower`, A-Z are lowered first. Words are
    brought together by a 64-bit hash and then compared in full: up to 16 bytes as two numbers, longer ones as bytes.
    """
    raw, offsets = buffers(column)
    n = len(raw)
    data = np.zeros(n + 16, np.uint8)
    data[:n] = _LOWER[raw] if lower else raw
    space = np.ones(n + 1, bool)
    space[:n] = _SPACE[raw]
    inner = offsets[(offsets > 0) & (offsets < n)]
    first, last = ~space[:n], ~space[:n]
    before, after = np.concatenate([[True], space[: n - 1]]) if n else space[:0], space[1 : n + 1].copy()
    before[inner] = True
    after[inner - 1] = True
    starts, ends = np.flatnonzero(first & before), np.flatnonzero(last & after) + 1
    del space, first, last, before, after
    bounds = np.searchsorted(starts, offsets)
    size = ends - starts
    eight = np.ndarray((n + 9,), "<u8", data, strides=(1,))
    a = eight[starts] & _FIRST[np.minimum(size, 8)]
    b = eight[starts + 8] & _FIRST[np.clip(size - 8, 0, 8)] if len(starts) else a
    h = a * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += b ^ size.astype(np.uint64)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    text = data.tobytes()
    long = np.flatnonzero(size > 16).tolist()
    for i in long:
        h[i] = xxhash.xxh3_64_intdigest(text[starts[i] : ends[i]])
    # as np.unique does, but any of equal hashes may stand for them, so the sort need not be stable
    order = np.argsort(h)
    turn = h[order]
    new = np.concatenate([[True], turn[1:] != turn[:-1]]) if len(h) else np.zeros(0, bool)
    rep = order[new]
    of = np.empty(len(h), np.int64)
    of[order] = np.cumsum(new) - 1
    a, b, like = a[order], b[order], size[order]
    # sorted by hash, equal words stand side by side: each is held against the one before it
    same = new[1:] | ((a[1:] == a[:-1]) & (b[1:] == b[:-1]) & (like[1:] == like[:-1]))
    if not same.all() or any(text[starts[i] : ends[i]] != text[starts[j] : ends[j]] for i in long if (j := rep[of[i]]) != i):
        every = [text[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        number: dict[bytes, int] = {}
        of = np.array([number.setdefault(w, len(number)) for w in every], np.int64)
        return list(number), of, bounds
    return [text[s:e] for s, e in zip(starts[rep].tolist(), ends[rep].tolist(), strict=True)], of, bounds


def joined(parts: list[bytes], of: np.ndarray, item: str = "<u4") -> tuple[np.ndarray, np.ndarray]:
    """The parts as numbers, one behind the other in the order `of`, and where each begins (with the end)."""
    flat = np.frombuffer(b"".join(parts), item)
    size = np.fromiter(map(len, parts), np.int64, len(parts)) // np.dtype(item).itemsize
    at = np.cumsum(size) - size
    n = size[of]
    upto = np.concatenate([[0], np.cumsum(n)])
    place = np.repeat(at[of] - upto[:-1], n) + np.arange(upto[-1])
    return flat[place], upto
