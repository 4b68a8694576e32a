"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Texts are cut where a white-space marker follows another character; no piece crosses such
a cut, so each word is segmented once and remembered. The words of a batch that are new go
through one Viterbi pass together, as arrays. Characters that no piece covers fall back to
byte pieces. Decoding turns markers into blanks and runs of byte pieces into text.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MARK = "▁"
# Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
#: Words up to this many bytes are segmented together; longer ones one by one.
SHORT = 48
#: Words of up to ``SHORT`` bytes that a task remembers at most; beyond it starts afresh.
REMEMBERED = 400_000


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol buffer's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            size = varint()
            yield tag >> 3, data[at : at + size]
            at += size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            yield tag >> 3, data[at : at + size]
            at += size
        else:
            raise ValueError(f"wire type {kind}")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces of a model file with log scores, and its white-space rules."""

    pieces: list[str]
    kinds: list[int]
    scores: np.ndarray
    unknown: int
    dummy_prefix: bool


def read_vocabulary(path: str) -> Vocabulary:
    """Read a model file.

    A unigram model's scores are log probabilities and are taken as they are. Other models
    only rank their pieces; there a piece of rank r gets Zipf's log(1 / (r + 1)), in steps
    of 1/256, so that sums are exact. Models that rewrite characters or drop blanks before
    encoding are refused.
    """
    pieces, kinds, scores, unigram, prefix = [], [], [], True, True
    for number, value in fields(Path(path).read_bytes()):
        if number == 1:
            piece = dict(fields(value))
            pieces.append(piece.get(1, b"").decode())
            scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            kinds.append(piece.get(3, NORMAL))
        elif number == 2:
            unigram = dict(fields(value)).get(3, 1) == 1
        elif number == 3:
            rules = dict(fields(value))
            prefix = bool(rules.get(3, 1))
            if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
                raise ValueError("the model normalises its input")
    if not unigram:
        order = sorted((i for i, k in enumerate(kinds) if k in (NORMAL, USER)), key=lambda i: (-scores[i], i))
        for rank, i in enumerate(order):
            scores[i] = -round(256 * math.log(rank + 1)) / 256
    return Vocabulary(pieces, kinds, np.array(scores), kinds.index(UNKNOWN), prefix)


class DoubleArray:
    """Trie in two arrays: the child of s by byte b is at base[s] + b + 1, if check says s.

    ``value`` has the number of the piece that ends at a state, or -1.
    """

    def __init__(self, keys: list[tuple[bytes, int]]):
        keys = sorted(keys)
        size = 1024
        base, check, value = [0] * size, [-1] * size, [-1] * size
        check[0] = 0
        hint = 1
        todo = [(0, 0, len(keys), 0)]
        while todo:
            state, low, high, depth = todo.pop()
            if len(keys[low][0]) == depth:
                value[state] = keys[low][1]
                low += 1
            if low == high:
                continue
            spans = []
            start = low
            for k in range(low + 1, high + 1):
                if k == high or keys[k][0][depth] != keys[start][0][depth]:
                    spans.append((keys[start][0][depth] + 1, start, k))
                    start = k
            place, passed = max(hint, spans[0][0]), 0
            while True:
                at = place - spans[0][0]
                if at + 300 > size:
                    base += [0] * size
                    check += [-1] * size
                    value += [-1] * size
                    size *= 2
                if check[place] < 0 and all(check[at + c] < 0 for c, _, _ in spans):
                    break
                passed += check[place] >= 0
                place += 1
            if passed > 0.9 * (place - hint):  # what lies before is nearly full
                hint = place
            base[state] = at
            for c, a, b in spans:
                check[at + c] = state
                todo.append((at + c, a, b, depth + 1))
        used = max(i for i, c in enumerate(check) if c >= 0) + 300
        self.base, self.check, self.value = (
            np.array((x + [-1 if x is not base else 0] * used)[:used], np.int32) for x in (base, check, value)
        )


class Encoder:
    """Segments texts; built once on the driver and sent to the tasks with its arrays.

    As in the public library, unused pieces are never given. A user's own piece competes by
    its score, where the library always prefers it.
    """

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        keys = [(p.encode(), i) for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k in (NORMAL, USER) and p]
        self.trie = DoubleArray(keys)
        self.dummy_prefix = v.dummy_prefix
        normal = [s for s, k in zip(v.scores, v.kinds) if k == NORMAL]
        self.scores = v.scores
        self.unknown_score = (min(normal) if normal else 0.0) - 10.0
        self.unknown = v.unknown
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k == BYTE}
        self.cuttable = all(MARK not in p.lstrip(MARK) for p, k in zip(v.pieces, v.kinds) if k in (NORMAL, USER))
        raw = {i: bytes([b]) for b, i in self.bytes.items()}
        self.raw = [
            raw.get(i, b"" if k == CONTROL else p.replace(MARK, " ").encode()) for i, (p, k) in enumerate(zip(v.pieces, v.kinds))
        ]
        self.known: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """The text with its markers, cut before each marker that follows another character."""
        if not text:
            return []
        marked = (MARK if self.dummy_prefix else "") + text.replace(" ", MARK)
        return re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", marked) if self.cuttable else [marked]

    def _fallback(self, char: bytes) -> list[int]:
        if all(b in self.bytes for b in char):
            return [self.bytes[b] for b in char]
        return [self.unknown]

    def _one(self, word: bytes) -> list[int]:
        """Viterbi over one word of any length."""
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        n = len(word)
        best, back = [-math.inf] * (n + 1), [(0, 0)] * (n + 1)
        best[0] = 0.0
        at = 0
        while at < n:
            first = word[at]
            width = 1 if first < 128 else 2 if first < 224 else 3 if first < 240 else 4
            here, state, single = best[at], 0, False
            for end in range(at + 1, n + 1):
                state_next = base[state] + word[end - 1] + 1
                if check[state_next] != state:
                    break
                state = state_next
                piece = value[state]
                if piece >= 0:
                    single |= end - at == width
                    if here + scores[piece] > best[end]:
                        best[end], back[end] = here + scores[piece], (at, piece)
            if not single and here + self.unknown_score > best[at + width]:
                best[at + width], back[at + width] = here + self.unknown_score, (at, -1)
            at += width
        return self._path(word, [back[i][0] for i in range(n + 1)], [back[i][1] for i in range(n + 1)])

    def _path(self, word: bytes, starts, pieces) -> list[int]:
        at, parts = len(word), []
        while at:
            start, piece = starts[at], pieces[at]
            parts.append([piece] if piece >= 0 else self._fallback(word[start:at]))
            at = start
        return [int(i) for part in reversed(parts) for i in part]

    def _many(self, words: list[bytes]) -> list[list[int]]:
        """Viterbi over many short words at once; the same rules and ties as ``_one``."""
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        sizes = np.array([len(w) for w in words])
        n, most = len(words), int(sizes.max())
        chars = np.zeros((n, most + 5), np.int32)
        flat = np.frombuffer(b"".join(words), np.uint8)
        rows = np.repeat(np.arange(n), sizes)
        chars[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        best = np.full((n, most + 5), -np.inf)
        best[:, 0] = 0.0
        starts, pieces = np.zeros((n, most + 5), np.int16), np.zeros((n, most + 5), np.int32)
        for at in range(most):
            first = chars[:, at]
            live = np.flatnonzero((sizes > at) & ((first & 0xC0) != 0x80))
            if not len(live):
                continue
            first = first[live]
            width = np.where(first < 128, 1, np.where(first < 224, 2, np.where(first < 240, 3, 4)))
            here = best[live, at]
            covered = np.zeros(len(live), bool)
            inside = np.arange(len(live))
            state = np.zeros(len(live), np.int32)
            for end in range(at + 1, most + 1):
                step = base[state] + chars[live[inside], end - 1] + 1
                ok = (check[step] == state) & (sizes[live[inside]] >= end)
                inside, state = inside[ok], step[ok]
                if not len(inside):
                    break
                piece = value[state]
                whole = piece >= 0
                at_piece = inside[whole]
                if len(at_piece):
                    piece = piece[whole]
                    covered[at_piece] |= width[at_piece] == end - at
                    score = here[at_piece] + self.scores[piece]
                    row = live[at_piece]
                    better = score > best[row, end]
                    row = row[better]
                    best[row, end], starts[row, end], pieces[row, end] = score[better], at, piece[better]
            left = ~covered
            row, end = live[left], at + width[left]
            score = here[left] + self.unknown_score
            better = score > best[row, end]
            row, end = row[better], end[better]
            best[row, end], starts[row, end], pieces[row, end] = score[better], at, -1
        starts, pieces = starts.tolist(), pieces.tolist()
        return [self._path(w, s, p) for w, s, p in zip(words, starts, pieces)]

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Remember short words; the longer ones are given back."""
        if len(self.known) + len(words) > REMEMBERED:
            self.known.clear()
        raw = [(w, w.encode("utf-8", "replace")) for w in words]
        short = [x for x in raw if len(x[1]) <= SHORT]
        for start in range(0, len(short), 8192):
            part = short[start : start + 8192]
            for (word, _), ids in zip(part, self._many([r for _, r in part])):
                self.known[word] = np.array(ids, "<i4").tobytes()
        return {w: np.array(self._one(data), "<i4").tobytes() for w, data in raw if len(data) > SHORT}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        cut = [self.words(t) for t in texts]
        new = {w for words in cut for w in words if w not in self.known}
        if len(self.known) + len(new) > REMEMBERED:
            new = {w for words in cut for w in words}
        long = self._learn(new) if new else {}
        known = self.known
        return [b"".join([known[w] if w in known else long[w] for w in words]) for words in cut]

    def decode(self, ids) -> str:
        """Text of ids: markers as blanks, byte pieces as UTF-8, the added first blank removed."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ids array<int>, n_tokens, n_bytes and restored.

    ``n_bytes`` counts byte pieces; ``restored`` says whether decoding gives the text back
    (a marker character in a text comes back as a blank, so there it does not). A null or
    empty text has no ids. The vocabulary file is read once, by the driver; its arrays, a
    few MB whatever the data, go with the tasks.
    """
    encoder = Encoder(read_vocabulary(vocabulary))
    chosen = docs.select(key, text)
    schema = T.StructType(
        [
            chosen.schema[0],
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("restored", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_byte = np.zeros(len(encoder.raw), bool)
        is_byte[list(encoder.bytes.values())] = True
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                data = encoder.encode(texts)
                sizes = np.array([len(d) // 4 for d in data], np.int64)
                ids = np.frombuffer(b"".join(data), "<i4")
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                counts = np.concatenate([[0], np.cumsum(is_byte[ids])])
                listed = ids.tolist()
                back = [encoder.decode(listed[a:b]) == t for a, b, t in zip(offsets, offsets[1:], texts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())),
                        pa.array(sizes),
                        pa.array(counts[offsets[1:]] - counts[offsets[:-1]]),
                        pa.array(back, pa.bool_()),
                    ],
                    names=schema.names,
                )

    return chosen.mapInArrow(run, schema)


def decode(rows: DataFrame, vocabulary: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """(key, text) from (key, ids); null ids give an empty text."""
    encoder = Encoder(read_vocabulary(vocabulary))
    chosen = rows.select(key, ids)
    schema = T.StructType([chosen.schema[0], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [encoder.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=schema.names)

    return chosen.mapInArrow(run, schema)
