"""Spelling variants: words that differ by one letter, found in a trie of letter counts.

All letters are dealt to ``letter_groups`` groups. A word's vector counts its letters in
each group; one inserted, deleted or replaced letter changes it by one surplus and one
deficit at most. Words are arranged in a trie by successive counts. A search goes down it
depth-first with all words that ask at once, each with a budget of one surplus and one
deficit; what reaches a leaf is verified letter by letter.

The trie is distributed by its first ``levels`` counts, those that vary most over the
vocabulary: every subtree is a task's work, and a word asks in its own subtree and in those
that its budget reaches. Subtrees with many letters are cut into chunks, of held and of
asking words apart, whose sizes are measured first, so no task holds more than
``held_bytes`` and ``asking_bytes`` (unless one word alone is longer). A word asks only for
words that come after it in the trie's order, so each pair is met once.

Texts: null and empty ones have no words; long texts are read whole, and a text without any
break is one word. Rows with a null key count like others (a dropped letter then takes the
key as empty). Repeated rows count again. Ties between forms go to the smallest word in
code-point order. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changetables.llm.common import broadcast_if_small
from changetables.session import materialise


@dataclass(frozen=True)
class Variants:
    """What counts as a word and as a form, and sizes of the work.

    A word's form has ``ratio`` times its occurrences at least. ``drop_one_in`` takes a
    letter out of one run in so many, by a checksum of key and run: planted misspellings,
    for tests and measurements; None leaves the texts alone.
    """

    least_letters: int = 5
    least_count: int = 3
    ratio: int = 2
    drop_one_in: int | None = None
    letter_groups: int = 16
    levels: int = 3
    held_bytes: int = 2 << 20
    asking_bytes: int = 4 << 20
    table_bytes: int = 32 << 20


#: Letters of a word: A to Z and the Latin-1 range from U+00C0 on, one byte each in Latin-1.
LETTERS = rb"A-Za-z\xC0-\xFF"


def count_words(docs: DataFrame, how: Variants = Variants(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words with enough letters and occurrences, A to Z in lower case."""
    runs = re.compile(rb"[%b]{%d,}" % (LETTERS, how.least_letters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        held = 0

        def out() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for name, value in zip(batch.column(0), batch.column(1)):
                # a letter outside Latin-1 becomes a question mark, which parts words like it
                raw = (value.as_py() or "").encode("latin-1", "replace").lower()
                if how.drop_one_in is None:
                    total.update(runs.findall(raw))
                else:
                    number = name.as_py()
                    start = zlib.crc32(f"{'' if number is None else number}:".encode())
                    for word, n in Counter(runs.findall(raw)).items():
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                        if h % how.drop_one_in == 0:
                            h %= len(word)
                            word = word[:h] + word[h + 1 :]
                            if len(word) < how.least_letters:
                                continue
                        total[word] += n
                held += len(raw)
                if len(total) > 200_000 or held > how.table_bytes:
                    yield out()
                    total.clear()
                    held = 0
        if total:
            yield out()

    chosen = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    counted = chosen.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= how.least_count)


class Codes:
    """Words as arrays of code points, end to end."""

    def __init__(self, words: list[str]):
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.end = np.cumsum(self.length)
        self.start = self.end - self.length
        self.code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)

    def rows(self, which: np.ndarray, width: int) -> np.ndarray:
        """A row of code points for each chosen word, zero beyond its end."""
        place = self.start[which, None] + np.arange(width)
        inside = place < self.end[which, None]
        return np.where(inside, self.code[np.minimum(place, max(len(self.code) - 1, 0))], 0)

    def vectors(self, groups: int) -> np.ndarray:
        """Letter counts of each word by group; a letter's group is its code's remainder."""
        flat = np.repeat(np.arange(len(self.length)), self.length) * groups + self.code % groups
        return np.bincount(flat, minlength=len(self.length) * groups).reshape(-1, groups).astype(np.int32)


def one_edit(a: Codes, i: np.ndarray, b: Codes, j: np.ndarray) -> np.ndarray:
    """Which pairs of words differ by exactly one inserted, deleted or replaced letter."""
    longer = np.maximum(a.length[i], b.length[j])
    near = np.abs(a.length[i] - b.length[j]) <= 1
    order = np.flatnonzero(near)[np.argsort(longer[near], kind="stable")]
    out = np.zeros(len(i), bool)
    start = 0
    while start < len(order):
        # rows of about equal width, four million letters at a time
        end = min(len(order), start + max(1, 4_000_000 // int(longer[order[start]] + 1)))
        while end > start + 1 and (end - start) * int(longer[order[end - 1]]) > 8_000_000:
            end = start + (end - start) // 2
        these = order[start:end]
        start = end
        width = int(longer[these[-1]]) + 1
        x, y = a.rows(i[these], width), b.rows(j[these], width)
        swap = a.length[i[these]] > b.length[j[these]]
        x[swap], y[swap] = y[swap], x[swap]  # x is the shorter one
        same = a.length[i[these]] == b.length[j[these]]
        equal = x == y
        differ = width - equal.sum(axis=1)
        lead = np.where(equal.all(axis=1), width, equal.argmin(axis=1))
        shifted = x[:, :-1] == y[:, 1:]
        tail = (shifted | (np.arange(width - 1) < lead[:, None])).all(axis=1)
        out[these] = np.where(same, differ == 1, tail)
    return out


class Trie:
    """Held words, sorted by their vectors; a node is a range of rows at a level."""

    LEAF = 4096  # pairs that are compared at once, without further nodes

    def __init__(self, vectors: np.ndarray, asking: np.ndarray, first: int):
        self.rows = np.lexsort(vectors.T[::-1])
        self.vectors = vectors[self.rows]
        self.asking = asking
        self.first = first
        self.met: list[tuple[np.ndarray, np.ndarray]] = []

    def search(self, surplus: np.ndarray, deficit: np.ndarray, tied: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (asking, held) whose counts stay within the budgets, some at a time."""
        stack = [(self.first, 0, len(self.rows), np.arange(len(self.asking)), surplus, deficit, tied)]
        depth = self.vectors.shape[1]
        while stack:
            level, low, high, who, surplus, deficit, tied = stack.pop()
            if level == depth or len(who) * (high - low) <= self.LEAF:
                step = max(1, 65_536 // max(1, high - low))
                for k in range(0, len(who), step):
                    part = slice(k, k + step)
                    more = self.vectors[None, low:high, level:] - self.asking[who[part], None, level:]
                    ok = np.maximum(more, 0).sum(axis=2) <= surplus[part, None]
                    ok &= np.maximum(-more, 0).sum(axis=2) <= deficit[part, None]
                    if level < depth and tied[part].any():
                        changed = more != 0
                        at = changed.argmax(axis=2)
                        sign = np.take_along_axis(more, at[:, :, None], axis=2)[:, :, 0]
                        ok &= ~(tied[part, None] & (sign < 0))
                    one, two = np.nonzero(ok)
                    if len(one):
                        yield who[part][one], self.rows[low + two]
                continue
            counts = self.vectors[low:high, level]
            edges = np.flatnonzero(np.diff(counts)) + 1
            wanted = self.asking[who, level]
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), high - low]):
                more = counts[a] - wanted
                go = np.flatnonzero((more == 0) | ((more == 1) & (surplus > 0)) | ((more == -1) & (deficit > 0) & ~tied))
                if len(go):
                    m = more[go]
                    stack.append(
                        (level + 1, low + a, low + b, who[go], surplus[go] - (m == 1), deficit[go] - (m == -1), tied[go] & (m == 0))
                    )


def _level_order(words: DataFrame, how: Variants) -> list[int]:
    """Letter groups, those whose counts vary most first."""
    groups = how.letter_groups

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, groups))
        for batch in batches:
            v = np.minimum(Codes(batch.column(0).to_pylist()).vectors(groups), 1000)
            total += [np.full(groups, len(v)), v.sum(axis=0), (v.astype(np.int64) ** 2).sum(axis=0)]
        columns = [np.arange(groups), *total]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.float64)) for c in columns], names=["g", "n", "s", "q"])

    sums = words.select("word").mapInArrow(run, "g double, n double, s double, q double")
    sums = sums.groupBy("g").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    spread = {int(r["g"]): r["q"] / r["n"] - (r["s"] / r["n"]) ** 2 if r["n"] else 0.0 for r in sums.collect()}
    return sorted(range(groups), key=lambda g: (-spread.get(g, 0.0), g))


#: Bits of a count in a subtree's number; larger counts are taken as the largest, which
#: keeps counts that differ by one within one of each other.
COUNT_BITS = 20


def _subtree(heads: np.ndarray) -> np.ndarray:
    number = np.zeros(len(heads), np.int64)
    for level in range(heads.shape[1]):
        number = (number << COUNT_BITS) | np.minimum(heads[:, level], (1 << COUNT_BITS) - 1)
    return number


def _asked_subtrees(words: DataFrame, how: Variants, order: list[int]) -> DataFrame:
    """(word, n, letters, own, subtree): a row for each subtree that a word's budget reaches."""
    levels = how.levels
    steps = [np.zeros(levels, np.int64)]
    for up in range(levels):
        for down in [None, *range(levels)]:
            if down != up:
                step = np.zeros(levels, np.int64)
                step[up] += 1
                if down is not None:
                    step[down] -= 1
                steps.append(step)
    steps += [-np.eye(levels, dtype=np.int64)[k] for k in range(levels)]
    # only subtrees that come after the word's own: the first change is a surplus
    steps = [s for s in steps if not s.any() or s[np.flatnonzero(s)[0]] > 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = Codes(batch.column(0).to_pylist())
            heads = codes.vectors(how.letter_groups)[:, order[:levels]].astype(np.int64)
            for step in steps:
                head = heads + step
                keep = np.flatnonzero((head >= 0).all(axis=1))
                columns = [pa.array(codes.length), pa.array(np.full(len(heads), not step.any())), pa.array(_subtree(head))]
                taken = [c.take(pa.array(keep)) for c in (batch.column(0), batch.column(1), *columns)]
                yield pa.RecordBatch.from_arrays(taken, names=["word", "n", "letters", "own", "subtree"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, letters long, own boolean, subtree long")


def near_words(words: DataFrame, how: Variants = Variants()) -> DataFrame:
    """(a, n_a, b, n_b): all pairs of different words (word, n) that are one edit apart, each once."""
    order = _level_order(words, how)
    asked = materialise(_asked_subtrees(words, how, order), "asked-subtrees")
    size = asked.groupBy("subtree").agg(
        F.sum(F.when(F.col("own"), F.col("letters"))).alias("held"), F.sum("letters").alias("asking")
    )
    size = size.where("held is not null").select(
        "subtree",
        F.ceil(F.greatest("held", F.lit(1)) / how.held_bytes).cast("int").alias("h"),
        F.ceil(F.greatest("asking", F.lit(1)) / how.asking_bytes).cast("int").alias("q"),
    )
    size = broadcast_if_small(materialise(size, "subtrees"), 24, how.table_bytes)
    met = asked.join(size, "subtree")
    deal = lambda n: F.pmod(F.xxhash64("word"), n).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    held = met.where("own").select(
        "word", "n", F.lit(True).alias("held"), "subtree", deal(F.col("h")).alias("c"), F.explode(every(F.col("q"))).alias("d")
    )
    asking = met.select(
        "word", "n", F.lit(False).alias("held"), "subtree", F.explode(every(F.col("h"))).alias("c"), deal(F.col("q")).alias("d")
    )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        holds = rows["held"].to_numpy(bool)
        sides = [rows["word"].to_numpy(object)[m] for m in (holds, ~holds)]
        counts = [rows["n"].to_numpy()[m] for m in (holds, ~holds)]
        inside, asks = (Codes(list(s)) for s in sides)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        if len(sides[0]) and len(sides[1]):
            vectors, asking = (c.vectors(how.letter_groups)[:, order] for c in (inside, asks))
            head = vectors[0, : how.levels] - asking[:, : how.levels]
            surplus = 1 - np.maximum(head, 0).sum(axis=1)
            deficit = 1 - np.maximum(-head, 0).sum(axis=1)
            trie = Trie(vectors, asking, how.levels)
            some: list[tuple[np.ndarray, np.ndarray]] = []
            size = 0

            def verify() -> None:
                i, j = (np.concatenate(x) for x in zip(*some))
                some.clear()
                # words with one vector come in the order of their letters
                alike = np.flatnonzero((asking[i] == vectors[j]).all(axis=1))
                after = np.ones(len(i), bool)
                after[alike] = sides[1][i[alike]] < sides[0][j[alike]]
                i, j = i[after], j[after]
                ok = one_edit(asks, i, inside, j)
                found.append((i[ok], j[ok]))

            for i, j in trie.search(surplus, deficit, ~head.any(axis=1)):
                some.append((i, j))
                size += len(i)
                if size > 200_000:
                    verify()
                    size = 0
            if some:
                verify()
        i, j = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        return pd.DataFrame({"a": sides[1][i], "n_a": counts[1][i], "b": sides[0][j], "n_b": counts[0][j]})

    groups = held.unionByName(asking).groupBy("subtree", "c", "d")
    return groups.applyInPandas(run, "a string, n_a long, b string, n_b long")


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last word that the forms lead to.

    Pointers double each round, so a chain of n forms takes log2(n) rounds.
    """
    roots = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = materialise(roots.join(ahead, "root", "left").select("word", "root", "next"), "roots")
        if not stepped.where("next is not null").take(1):
            return stepped.select("word", "root")
        roots = stepped.select("word", F.coalesce("next", "root").alias("root"))


def group(words: DataFrame, how: Variants = Variants()) -> DataFrame:
    """One row per word (word, n): word, form, root, n, n_near, form_n.

    The form is the near word with most occurrences, if it has ``ratio`` times the word's
    own; the root is the last word that forms lead to, the word itself if it has none.
    """
    words = materialise(words.select("word", "n"), "words")
    pairs = materialise(near_words(words, how), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near"))).alias("best")
    )
    enough = -F.col("best.m") >= how.ratio * F.col("n")
    formed = words.join(best, "word", "left").select(
        "word",
        F.when(enough, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, -F.col("best.m")).alias("form_n"),
    )
    formed = materialise(formed, "formed")
    roots = follow(formed.where("form is not null"))
    out = formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return out.select("word", "form", "root", "n", "n_near", "form_n")
