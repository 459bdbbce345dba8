"""SentencePiece encoding by unigram Viterbi over a double-array trie, and decoding.

Spaces become the marker U+2581 and one marker goes before the text. The best segmentation is the path of greatest
summed log score over the pieces found in the trie; a character that no piece covers alone may stand as unknown, at
UNKNOWN_PENALTY under the least ordinary score, and is written as its bytes' pieces. As no piece has a marker behind another
character (checked when the model is read), paths never cross into the next word: each word is segmented once, many
words side by side, and kept for the worker's later tasks. Few long words (text without spaces) are walked byte by byte,
in a time that grows with their bytes: about a second and a half a megabyte.

Decoding joins pieces and bytes, turns markers into spaces and drops the first. It gives back every text that has no
U+2581 of its own. Of segmentations with equal scores the one found first stays: shorter pieces at the left, then at the
right. Null and empty texts have no pieces. Repeated rows are encoded each. An empty table gives an empty
result. Columns other than key and text are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gantry.llm.common import by_bytes, key_and_text, shelf

MARK = "▁"
#: Fixed values of the model format: types of pieces.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
#: Scores at or under this mark pieces that are as good as never taken; they are no measure for unknown characters.
NEVER = -1e8
#: Words kept by a worker (in two generations), and the longest one kept.
CACHED_WORDS, CACHED_CHARS = 500_000, 48
#: Units of like length that are walked byte by byte, one after the other; more are walked together.
ALONE = 64


# the model file ----------------------------------------------------------------------------------------------------


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protobuf message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, data[at : at + n]
            at += n
        else:
            n = 4 if kind == 5 else 8
            yield tag >> 3, struct.unpack("<f" if n == 4 else "<d", data[at : at + n])[0]
            at += n


def read_model(path: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(pieces, scores, types) of a SentencePiece model file."""
    pieces, scores, types = [], [], []
    with open(path, "rb") as f:
        for number, value in _fields(f.read()):
            if number == 1:
                x = dict(_fields(value))
                pieces.append(x.get(1, b"").decode())
                scores.append(x.get(2, 0.0))
                types.append(x.get(3, NORMAL))
    return pieces, np.array(scores, np.float32), np.array(types)


def rank_scores(scores: np.ndarray) -> np.ndarray:
    """Log probabilities for a model that stores merge ranks (0, -1, -2, ...): the r-th piece has a share of 1 / (r + 1)."""
    ranked = scores > NEVER
    norm = np.log(np.sum(1 / (1 - scores[ranked].astype(np.float64))))
    return np.where(ranked, -np.log(1 - np.where(ranked, scores, 0).astype(np.float64)) - norm, scores).astype(np.float32)


# the double array --------------------------------------------------------------------------------------------------


@dataclass
class Trie:
    """State s goes by byte b to base[s] + b + 1 if check of that is s; value is the piece that ends there or -1."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray


def build_trie(keys: list[bytes], values: list[int]) -> Trie:
    """Places the children of each state, breadth first, at a base where all their cells are free.

    The search goes on from where the last family of like size was put.
    """
    order = sorted(range(len(keys)), key=keys.__getitem__)
    keys, values = [keys[i] for i in order], [values[i] for i in order]
    size = 1 << 12
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    check[0] = 0
    queue: list[tuple[int, int, int, int]] = [(0, 0, len(keys), 0)]  # state, keys from, to, depth
    hint = [0] * 9
    for state, lo, hi, depth in queue:
        if lo < hi and len(keys[lo]) == depth:
            value[state] = values[lo]
            lo += 1
        groups: list[tuple[int, int, int]] = []
        i = lo
        while i < hi:
            b, j = keys[i][depth], i
            while j < hi and keys[j][depth] == b:
                j += 1
            groups.append((b, i, j))
            i = j
        if not groups:
            continue
        codes = np.array([b + 1 for b, _, _ in groups])
        kind = min(len(codes), 8)
        at = hint[kind]
        while True:
            if at + 4096 + 257 >= len(check):
                grow = len(check)
                base, check, value = np.append(base, np.zeros(grow, np.int32)), np.append(check, np.full(grow, -1, np.int32)), np.append(value, np.full(grow, -1, np.int32))
            free = check[at : at + 4096 + 257] < 0
            fits = free[codes[0] : codes[0] + 4096].copy()
            for c in codes[1:].tolist():
                fits &= free[c : c + 4096]
            if fits.any():
                at += int(fits.argmax())
                break
            at += 4096
        base[state] = hint[kind] = at
        for (_, i, j), to in zip(groups, (at + codes).tolist(), strict=True):
            check[to] = state
            queue.append((to, i, j, depth + 1))
    # room behind the last state, so that no look-up needs a bound
    pad = np.full(258, -1, np.int32)
    return Trie(np.append(base, np.zeros(258, np.int32)), np.append(check, pad), np.append(value, pad))


class Unigram:
    """Encodes and decodes with (pieces, scores, types)."""

    def __init__(self, pieces: list[str], scores: np.ndarray, types: np.ndarray) -> None:
        found = np.flatnonzero((types == NORMAL) | (types == USER_DEFINED))
        if any(MARK in p.lstrip(MARK) for p in (pieces[i] for i in found)):
            raise ValueError("a piece goes on past a space")
        self.trie = build_trie([pieces[i].encode() for i in found], found.tolist())
        self.deepest = max((len(pieces[i].encode()) for i in found), default=0)
        normal = scores[(types == NORMAL) & (scores > NEVER)].astype(np.float64)
        self.scores = scores.astype(np.float64)
        own = types == USER_DEFINED
        self.scores[own] = np.array([len(p.encode()) for p in pieces])[own] * normal.max() - 0.1
        self.unknown = float(normal.min()) - UNKNOWN_PENALTY
        self.byte_id = np.zeros(256, np.int64)
        self.text_of: list[bytes] = [p.replace(MARK, " ").encode() for p in pieces]
        for i in np.flatnonzero(types == BYTE).tolist():
            b = int(pieces[i][1:-1], 16)
            self.byte_id[b] = i
            self.text_of[i] = bytes([b])
        for i in np.flatnonzero((types == CONTROL) | (types == UNKNOWN)).tolist():
            self.text_of[i] = b""
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.lists: list[list] | None = None

    def segment(self, units: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each unit; units of like length are walked together."""
        order = sorted(range(len(units)), key=lambda i: len(units[i]))
        out: list[bytes] = [b""] * len(units)
        at = 0
        while at < len(order):
            n = 1
            while at + n < len(order) and n < 8192 and (n + 1) * len(units[order[at + n]]) <= max(1 << 20, len(units[order[at]])) and len(units[order[at + n]]) <= 2 * len(units[order[at]]) + 8:
                n += 1
            own = [units[i] for i in order[at : at + n]]
            for i, ids in zip(order[at : at + n], self._viterbi(own) if n > ALONE else map(self._alone, own), strict=True):
                out[i] = ids
            at += n
        return out

    def _alone(self, unit: bytes) -> bytes:
        """As _viterbi, byte by byte: for long units, of which there are too few to be walked together."""
        if self.lists is None:
            self.lists = [x.tolist() for x in (self.trie.base, self.trie.check, self.trie.value, self.scores)]
        base, check, value, scores = self.lists
        n = len(unit)
        best, came, piece = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for s in range(n):
            lead = unit[s]
            if lead & 0xC0 == 0x80:
                continue
            char = s + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            here, state, bare = best[s], 0, True
            for e in range(s, n):
                to = base[state] + unit[e] + 1
                if check[to] != state:
                    break
                state = to
                v = value[to]
                if v >= 0:
                    if e + 1 == char:
                        bare = False
                    score = here + scores[v]
                    if score > best[e + 1]:
                        best[e + 1], came[e + 1], piece[e + 1] = score, s, v
            if bare and (score := here + self.unknown) > best[char]:
                best[char], came[char], piece[char] = score, s, -1
        ids, e = [], n
        while e:
            s = came[e]
            ids += [piece[e]] if piece[e] >= 0 else self.byte_id[np.frombuffer(unit[s:e], np.uint8)][::-1].tolist()
            e = s
        return np.array(ids[::-1], "<u4").tobytes()

    def _viterbi(self, units: list[bytes]) -> list[bytes]:
        n = len(units)
        size = np.fromiter(map(len, units), np.int64, n)
        width = int(size.max()) if n else 0
        flat = np.frombuffer(b"".join(u.ljust(width + 1, b"\0") for u in units), np.uint8).reshape(n, width + 1)
        head = (flat & 0xC0) != 0x80  # a character begins
        lead = flat
        chars = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        came, piece = np.full((n, width + 1), -1, np.int32), np.full((n, width + 1), -1, np.int32)
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        for s in range(width):
            rows = np.flatnonzero((size > s) & head[:, s])
            if not len(rows):
                continue
            here, state, alone = best[rows, s], np.zeros(len(rows), np.int32), np.zeros(len(rows), bool)
            live = np.arange(len(rows))
            for e in range(s, min(width, s + self.deepest)):
                to = base[state] + flat[rows[live], e] + 1
                good = (check[to] == state) & (size[rows[live]] > e)
                if not good.any():
                    break
                live, state = live[good], to[good]
                v = value[state]
                end = np.flatnonzero(v >= 0)
                if len(end):
                    k = live[end]
                    r = rows[k]
                    alone[k] |= chars[r, s] == e + 1 - s
                    score = here[k] + self.scores[v[end]]
                    better = score > best[r, e + 1]
                    r, k2 = r[better], end[better]
                    best[r, e + 1], came[r, e + 1], piece[r, e + 1] = score[better], s, v[k2]
            lone = np.flatnonzero(~alone)
            if len(lone):
                r = rows[lone]
                e = s + chars[r, s]
                score = here[lone] + self.unknown
                better = score > best[r, e]
                r, e = r[better], e[better]
                best[r, e], came[r, e], piece[r, e] = score[better], s, -1
        # back from the ends, all units at once
        at, live = size.copy(), np.flatnonzero(size > 0)
        steps: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        while len(live):
            e = at[live]
            s = came[live, e]
            steps.append((live, s, e, piece[live, e]))
            at[live] = s
            live = live[s > 0]
        if not steps:
            return [b""] * n
        unit, s, e, p = (np.concatenate(x) for x in zip(*steps, strict=True))
        order = np.lexsort((s, unit))
        unit, s, e, p = unit[order], s[order], e[order], p[order]
        times = np.where(p < 0, e - s, 1)
        back = np.repeat(np.arange(len(p)), times)
        within = np.arange(len(back)) - np.repeat(np.cumsum(times) - times, times)
        ids = np.where(p[back] < 0, self.byte_id[flat[unit[back], s[back] + within]], p[back]).astype("<u4")
        cuts = np.searchsorted(unit[back], np.arange(n + 1)).tolist()
        return [ids[a:z].tobytes() for a, z in zip(cuts[:-1], cuts[1:], strict=True)]

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = [_units(t) for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.known, self.older = {}, self.known
        known = self.known
        new = set().union(*split).difference(known)
        again = new.intersection(self.older)
        known.update((w, self.older[w]) for w in again)
        made = list(new - again)
        known.update(zip(made, self.segment([(MARK + w.replace(" ", MARK)).encode() for w in made]), strict=True))
        for words in split:
            yield b"".join(map(known.__getitem__, words))
        for w in made:
            if len(w) > CACHED_CHARS:
                del known[w]

    def decode(self, ids: bytes) -> str:
        made = b"".join(map(self.text_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return made.decode("utf-8", "replace").removeprefix(" ")


_RUNS = re.compile(" +[^ ]*")


def _units(text: str | None) -> list[str]:
    """Words without the marker before them; markers behind the first of a run stand as spaces in front."""
    if not text:
        return []
    text = text.replace(MARK, " ")
    if "  " not in text and text[0] != " ":
        return text.split(" ")
    return [u[1:] for u in _RUNS.findall(" " + text)]


def kept_model(path: str, scores: str) -> Unigram:
    """That of this worker process, if an earlier task has made one."""
    found = shelf("unigram_models")
    if (path, scores) not in found:
        pieces, stored, types = read_model(path)
        found[path, scores] = Unigram(pieces, rank_scores(stored) if scores == "ranks" else stored, types)
    return found[path, scores]


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", scores: str = "ranks", ids: bool = True) -> DataFrame:
    """(key, ids, n_pieces, n_bytes, ids_crc32, decoded, round_trip) for each row.

    n_bytes counts the byte pieces, decoded is the CRC-32 of the decoded text, round_trip whether it is the text again.
    Without `ids` that column is left out. scores: "ranks" turns stored merge ranks into log scores, "stored" takes them as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = kept_model(model, scores)
        is_byte = np.zeros(len(m.text_of), bool)
        is_byte[m.byte_id] = True
        for b in (x for whole in batches for x in by_bytes([whole], "text", 4 << 20)):
            texts = b.column("text").to_pylist()
            made = list(m.encode_all(texts))
            back = [m.decode(x) for x in made]
            n = np.array([len(x) // 4 for x in made], np.int64)
            out = [
                b.column("key"), pa.array(n), pa.array([int(is_byte[np.frombuffer(x, "<u4")].sum()) for x in made], pa.int64()), pa.array([zlib.crc32(x) for x in made], pa.int64()),
                pa.array([zlib.crc32(x.encode()) for x in back], pa.int64()), pa.array([x == t for x, t in zip(back, texts, strict=True)], pa.bool_()),
            ]
            names = ["key", "n_pieces", "n_bytes", "ids_crc32", "decoded", "round_trip"]
            if ids:
                flat = pa.array(np.frombuffer(b"".join(made), "<u4").astype(np.int32))
                out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), flat))
                names.append("ids")
            yield pa.record_batch(out, names)

    kind = docs.schema[key].dataType.simpleString()
    shape = f"key {kind}, n_pieces bigint, n_bytes bigint, ids_crc32 bigint, decoded bigint, round_trip boolean" + (", ids array<int>" if ids else "")
    return key_and_text(docs, key, text).mapInArrow(run, shape).withColumnRenamed("key", key)
